"""Whitening against a dense eigensolver, and the eigensolver on hard spectra."""

import duckdb
import numpy as np
import pytest

from cartulary.llm import common, queries, whitening

SF = "/root/testdata/sf0.001"


def plain(x):
    """x whole numbers: deviations, leading eigenpairs and the trace, densely."""
    n, sums = len(x), x.sum(axis=0)
    away = [[n * int(v) - int(s) for v, s in zip(row, sums, strict=True)] for row in x]
    c = np.array(away, float) / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    return [sum(a * a for a in row) for row in away], c, e[::-1], u[:, ::-1], np.trace(v)


def check(rows, ids, x, k):
    deviation, c, e, u, trace = plain(x)
    k = min(k, len(e))
    assert len(rows) == len(ids) * k
    got = {(r["vec_id"], r["component"]): r for r in rows}
    w = np.array([[got[i, j + 1]["whitened"] for j in range(k)] for i in ids])
    want = c @ u[:, :k] / np.sqrt(e[:k])
    assert np.abs(w * np.sign((w * want).sum(axis=0)) - want).max() < 1e-9
    for at, i in enumerate(ids):
        for j in range(k):
            r = got[i, j + 1]
            assert r["n"] == len(ids) and int(r["deviation"]) == deviation[at] and r["explained"] == pytest.approx(e[j] / trace, rel=1e-9)


def test_query_against_a_dense_solver(spark):
    ids, vectors = zip(*duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall(), strict=True)
    rows = queries.QUERIES["op12_whitening"](spark, SF).collect()
    check(rows, ids, np.floor(1024 * np.array(vectors, float)).astype(int) + 100000, 8)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def whitened(spark, rows, wanted=8):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int, whitened string")
    found, error, model = whitening.whiten(df, wanted=wanted)
    return [r.asDict() | {"vec_id": r["id"]} for r in found.collect()], error, model


def test_edges(spark):
    common.ship(spark)
    rng = np.random.default_rng(3)
    good = rng.standard_normal((60, 3)).astype(np.float32).tolist()
    bad = [(100, None, 1, "x"), (101, [], 1, "x"), (102, [1.0, None, 2.0], 1, "x"), (103, [1.0, float("nan"), 2.0], 1, "x"),
           (104, [float("inf"), 0.0, 0.0], 1, "x"), (105, [1.0, 2.0], 1, "x")]
    rows, error, model = whitened(spark, [(i, v, 1, "x") for i, v in enumerate(good)] + bad)
    check(rows, list(range(60)), np.floor(1024 * np.array(good, float)).astype(int) + 100000, 8)
    assert error < 1e-9 and model.n == 60
    again, _, model = whitened(spark, [(None, good[0], 1, "x"), (7, good[0], 1, "x"), (7, good[0], 1, "x"), (8, good[1], 1, "x")])
    assert model.n == 4 and len(model.values) == 1 and len(again) == 4  # one direction only
    for rows in ([], [(1, good[0], 1, "x")], [(1, good[0], 1, "x"), (2, good[0], 1, "x")], bad[:5]):
        assert whitened(spark, rows)[0] == []


def test_deviations_beyond_64_bits():
    x = np.array([[1, 1 << 40], [3, 5]], np.int64)
    sums = [10**15, 3]
    assert whitening._deviations(10**9, sums)(x) == [sum((10**9 * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]


@pytest.mark.parametrize("d, spectrum", [(300, np.linspace(4, 1, 300)), (300, np.r_[10, 10, 10, np.linspace(5, 0, 297)]), (200, 1 / np.arange(1, 201.0) ** 2), (9, np.ones(9)), (1, np.ones(1))])
def test_leading_pairs(d, spectrum):
    q = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0]
    v = (q * spectrum) @ q.T
    values, vectors, passes = whitening.leading(lambda w: v @ w, d, min(8, d), spectrum.sum())
    want = np.sort(spectrum)[::-1][:len(values)]
    assert np.abs(values - want).max() < 1e-12 * want[0] and np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() < 1e-12 * want[0] and passes < 200
