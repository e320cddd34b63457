"""Counts against a plain version, the trees' signs and held-out accuracy, and the edge cases."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from cartulary.llm import common, quality, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    inside = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)]


TEXTS = [None, "", " \n\t", "a b c a b c", "a a a a", "a b a b", "\n".join(["one line|", "", "one line|", "two é x", " ", "one line|"]),
         "x\x0by\x0cz\rw \x1c", "words go on and on " * 3000, " ".join(map(str, range(70000)))]


@pytest.mark.parametrize("at", range(len(TEXTS)))
def test_counts(at):
    assert quality.statistics(TEXTS[at])[0] == plain(TEXTS[at])


def test_query_against_a_plain_version(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows = queries.QUERIES["op11_quality"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts = plain(texts[r["doc_id"]])
        assert [r[c] for c in quality.COUNTS] == counts
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0]) and not (r["base_failed"] and r["kept"])


def test_held_out_accuracy_and_signs():
    rows = duckdb.sql(f"SELECT doc_id, text, quality FROM '{SF.replace('0.001', '0.01')}/documents.parquet' JOIN '{SF.replace('0.001', '0.01')}/labels.parquet' USING (doc_id)").fetchall()
    x, y = np.array([quality.statistics(t)[1] for _, t, _ in rows]), np.array([float(q) for _, _, q in rows])
    held = np.array([zlib.crc32(str(d).encode()) % 5 == 0 for d, _, _ in rows])
    signs = np.array(list(quality.SIGNS.values()))
    model = quality.grow(x[~held], y[~held], signs)
    told = model.score(x[held]) >= 0.5
    assert (told == (y[held] > 0)).mean() >= 0.95
    for j in np.flatnonzero(signs):
        moved, before = x.copy(), None
        for v in np.linspace(0, 1, 40):
            moved[:, j] = v
            now = signs[j] * model.score(moved)
            assert before is None or (now >= before - 1e-12).all()
            before = now


def test_flattened_trees_follow_their_nodes():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 3))
    model = quality.grow(x, (x[:, 0] * x[:, 1] > 0).astype(float), np.zeros(3, int), trees=5)
    for row, score in zip(x[:50], model.score(x[:50]), strict=True):
        total = model.start
        for at in model.roots:
            while model.low[at] != at:
                at = model.low[at] if row[model.feature[at]] <= model.limit[at] else model.high[at]
            total += model.value[at]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_edges(spark):
    common.ship(spark)
    rows = [(None, None, 1.0, "q")] + [(i % 12, t, 0.5, "q") for i, t in enumerate(TEXTS * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, quality string")
    labels = spark.createDataFrame([(8, 1), (9, 0), (3, None), (None, 1), (8, 0)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        got = quality.judge(docs, quality.fit(docs, known)).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, *[r[c] for c in quality.COUNTS]) for r in got) == sorted((i is None, i or 0, *plain(t)) for i, t, _, _ in rows)
    assert all(r["kept"] != r["base_failed"] for r in got)  # without labels the base rule alone decides
    none = docs.limit(0)
    assert quality.judge(none, quality.fit(none, labels)).count() == 0
