"""Each registered corpus query over the small tables, against a plain version of its contract."""

import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartulary.llm import mixing, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return {r[0]: r[1:] for r in duck.execute("SELECT doc_id, coalesce(text, ''), source, lang FROM documents ORDER BY doc_id").fetchall()}


def ids_of(name, texts):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return [np.array(e.ids + [1], "<u4") for e in t.encode_batch(texts, add_special_tokens=False)]


def result(spark, name):
    return [r.asDict() for r in queries.QUERIES[name](spark, SF).collect()]


def test_packing(spark, docs):
    want = dict(zip(docs, ids_of("byte_bpe_50k.json", [d[0] for d in docs.values()]), strict=True))
    rows = result(spark, "op1_packing")
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        part = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(want[r["doc_id"]])
        of_doc[r["doc_id"]].append((r["start"], r["length"]))
        of_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, ids in want.items():
        at = 0
        for start, length in sorted(of_doc[doc]):
            assert start == at
            at += length
        assert at == len(ids)
    assert set(of_sequence) == set(range(len(of_sequence)))
    for parts in of_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(len(w) for w in want.values()) > 0.98 * 2048 * len(of_sequence)


def test_sharding(spark, docs):
    rows = result(spark, "op2_sharding")
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        d: (len(v[0].encode()) + 16, zlib.crc32(v[0].encode())) for d, v in docs.items()}
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(40))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_token_codes(spark, docs):
    at, want = 0, {}
    for doc, ids in zip(docs, ids_of("word_bpe_49k.json", [d[0] for d in docs.values()]), strict=True):
        want[doc] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in result(spark, "op3_token_codes")} == want


def test_mixing(spark, docs):
    sizes = {d: len(v[0].encode().split()) for d, v in docs.items()}
    names = sorted({v[1] for v in docs.values()}, key=lambda s: (s is None, s or ""))
    totals = [sum(sizes[d] for d, v in docs.items() if v[1] == s) for s in names]
    goal = dict(zip(names, mixing.targets(totals, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * sum(totals)), strict=True))
    assert sum(goal.values()) == pytest.approx(1.5 * sum(totals))
    taken = defaultdict(int)
    rows = result(spark, "op10_mixing")
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        source = docs[r["doc_id"]][1]
        assert r["size"] == sizes[r["doc_id"]] and r["target"] == pytest.approx(goal[source]) and 0 <= r["taken"] <= 2 * r["size"]
        assert r["source_size"] == totals[names.index(source)]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 1 for s in names)
    assert sorted(map(str, rows)) == sorted(map(str, result(spark, "op10_mixing")))


def value(v):
    return repr(float(v)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    rows = result(spark, name)
    out = duck.execute(queries.ORACLES[name])
    cols = [d[0] for d in out.description]
    assert sorted(tuple(value(r[c]) for c in cols) for r in rows) == sorted(tuple(value(v) for v in r) for r in out.fetchall())
