"""Counts of words and of their contexts are exact, and a text scores alike whether its words are hot or joined."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartulary.llm import common, toxicity

SF = "/root/testdata/sf0.001"


def code(word):
    return int(toxicity.hashed(word)[0])


def test_contexts_beyond_64(spark, monkeypatch):
    common.ship(spark)
    texts = [(0, " ".join(f"left{i} common" for i in range(500)))] * 2 + [(1, " ".join(f"left{i} common odd" for i in range(250, 700)))]
    for flush in (1 << 20, 100):
        monkeypatch.setattr(toxicity, "FLUSH_WORDS", flush)
        got = {r["word"]: (r["ordinary"], r["toxic"], r["contexts"]) for r in toxicity.counts(spark.createDataFrame(texts, "toxic int, text string")).collect()}
        assert got[code("common")] == (2, 1, 700) and got[code("odd")] == (0, 1, 1) and len(got) == 702


def test_words_of_one_bucket_are_apart(spark):
    common.ship(spark)
    rows = [(0, f"word{i}") for i in range(20000)]
    got = toxicity.counts(spark.createDataFrame(rows, "toxic int, text string").repartition(4))
    assert got.count() == 20000 and got.where("ordinary != 1 or toxic != 0 or contexts != 0").count() == 0


@pytest.mark.parametrize("hot", [0, 50])
def test_joined_words_score_like_hot_ones(spark, monkeypatch, hot):
    docs = common.table(spark, SF, "documents").select("doc_id", "text")
    docs = docs.unionByName(docs.limit(5)).unionByName(spark.createDataFrame([(None, None), (-1, ""), (-2, "zzqx unheard")], docs.schema))
    labels = common.table(spark, SF, "labels").select("doc_id", "toxic")
    labels = labels.unionByName(docs.where("doc_id >= 0").select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic")))
    plain = toxicity.fit(docs, labels)
    monkeypatch.setattr(toxicity, "HOT", hot)
    joined = toxicity.fit(docs, labels)
    assert plain.rest is None and plain.curve is not None and joined.rest is not None and len(joined.hot) <= hot
    assert joined.curve == pytest.approx(plain.curve)
    a, b = (Counter((r["doc_id"], round(r["score"], 9)) for r in toxicity.score(docs, m).collect()) for m in (plain, joined))
    assert a == b and sum(a.values()) == docs.count()
