"""NULLs, empty and long texts, repeated rows, empty tables and clashing columns, operator by operator."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartulary.llm import ann, common, dac, iblt, langid, mixing, neardup, packing, queries, sharding, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"
LONG = "some words that go on and on " * 20000
ROWS = [(None, None, None, None, None, 1.0), (1, None, "en", "a", 0, None), (2, "", "en", None, 0, 0.5), (3, "one two three four five six.", "en", "a", 27, 0.1),
        (3, "one two three four five six.", "en", "a", 27, 0.1), (4, "One two\tthree four five  six.", "fr", "b", 27, 0.1), (5, LONG, "fr", "b", len(LONG), 0.2),
        (6, "...", None, "b", 3, 0.3)]
BYTE, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    common.ship(spark)
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    common.ship(spark)
    return spark.createDataFrame([], DOCS)


def test_packing(docs, nothing):
    rows = packing.pack(docs, BYTE).rows("doc_id", "start", "length").collect()
    assert sorted((r["doc_id"] or -1, r["start"]) for r in rows if r["length"] == 1) == [(-1, 0), (1, 0), (2, 0)]
    assert sum(r["length"] == 2048 for r in rows) > 50 and packing.pack(nothing, BYTE).rows().count() == 0


def test_sharding(docs, nothing):
    placed = sharding.shard(docs.select("doc_id"), 3, ["doc_id"])
    assert sorted((r["shard"], r["slot"]) for r in placed.collect()) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 0), (2, 1)]
    assert sharding.shard(nothing.select("doc_id"), 3, ["doc_id"]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 100, 12345])
def test_permutation(n):
    assert sorted(sharding.permuted(np.arange(n), n, 3)) == list(range(n))


def test_token_files(spark, docs, nothing):
    rows = dac.round_trip(spark, docs, WORDS, file_tokens=1000).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 3, 4, 5, 6] and dac.round_trip(spark, nothing, WORDS).count() == 0
    tokens = np.random.default_rng(1).integers(0, 1 << 32, 3000, dtype=np.uint32) >> np.random.default_rng(2).integers(0, 31, 3000).astype(np.uint32)
    f = dac.TokenFile(dac.pack_file([None, 7], [tokens[:1000].tobytes(), tokens[1000:].tobytes()]))
    assert (f.document(1) == tokens[1000:]).all() and [f.token(i) for i in range(0, 3000, 97)] == tokens[::97].tolist()


def test_toxicity(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 0), (3, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    for d, known in ((docs, labels), (nothing, labels), (docs, labels.limit(0))):
        assert toxicity.score(d, toxicity.fit(d, known)).where("score is null or score < 0 or score > 1").count() == 0


def test_neighbours(spark):
    common.ship(spark)
    rows = [(i, [float(i), 1.0]) for i in range(30)] + [(100, [5.0, 1.0]), (200, None), (300, [0.0, 0.0]), (400, [float("nan"), 1.0]), (500, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ann.search(df, F.col("id") % 100 == 0, ranges=2)
    assert [(r["vec_id"], r["score"]) for r in found.where("query_id = 100").orderBy("rank").limit(3).collect()] == [(5, 0.0), (4, 1.0), (6, 1.0)]
    assert {r["query_id"] for r in found.collect()} == {0, 100} and ann.search(df.limit(0), F.lit(True)).count() == 0


def test_archive(spark):
    common.ship(spark)
    big = "x" * 1500
    rows = [(None, "u", big), (1, None, None), (2, "a b", big), (3, "u", big), (3, "u", big), (4, "u", "short"), (5, "u", "short")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.archive(spark, df, shard_bytes=2000, roll_bytes=500).collect())
    assert got == [(-1, "response", None, 1500), (1, "response", None, 0), (2, "revisit", 3, 1500), (3, "response", None, 1500), (3, "response", None, 1500),
                   (4, "response", None, 5), (5, "response", None, 5)]
    assert warc.archive(spark, df.limit(0)).count() == 0


def test_language(docs, nothing):
    told = {r["doc_id"]: r for r in langid.predict(docs, langid.dictionaries(docs)).collect()}
    assert told[1]["lang_pred"] == told[2]["lang_pred"] == told[6]["lang_pred"] == "und" and told[5]["lang_pred"] == "fr"
    assert langid.predict(nothing, {}).count() == 0 and langid.predict(docs, {}).where("lang_pred = 'und'").count() == len(ROWS)


def test_sketches(docs, nothing):
    rows = iblt.with_next(docs)
    assert rows.count() == len(ROWS) and iblt.with_next(nothing).count() == 0
    keys = rows.select(iblt.digests(F.col("text")).alias("a"), iblt.digests(F.col("next_text")).alias("b"))
    assert iblt.with_difference(keys, "a", "b", "d").where(F.size("d") != F.size(F.array_except("a", "b")) + F.size(F.array_except("b", "a"))).count() == 0


def test_near_duplicates(docs, nothing):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs, words=4).collect()}
    assert {(None, 0, None), (1, 0, 1), (2, 0, 2), (3, 3, 3), (4, 3, 3), (6, 1, 6)} <= got and neardup.near_duplicates(nothing).count() == 0


def test_mixing(docs, nothing):
    mixed = mixing.mix(docs, block_words=5)
    assert mixed.documents.count() == len(ROWS) and mixed.taken.agg(F.sum("words")).first()[0] == sum(s["words"] for s in mixed.sources)
    assert mixing.mix(nothing).taken.count() == 0


def test_pipeline_stages(spark, docs, nothing):
    for d in (docs, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, "/root/testdata/sf0.001")
            assert out.count() >= 0 and (name == "packing" or out.columns == d.columns)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
