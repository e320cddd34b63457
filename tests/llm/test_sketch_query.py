"""The registered sketch query over a whole small table, against sets of digests compared one by one."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cartulary.llm import iblt, queries

SF = "/root/testdata/sf0.001"


def shared(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_likeness_is_that_of_the_digest_sets(spark):
    got = {r["doc_id"]: r for r in queries.op8_paragraph_sketch(spark, SF).collect()}
    texts = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    rows = []
    for i, (doc, text) in enumerate(texts):
        following, half = texts[(i + 1) % len(texts)][1], len(text) // 2
        rows.append((doc, text, text[:len(text) - half] + following[:half], following))
    sets = spark.createDataFrame(rows, "doc_id long, text string, edited string, following string").select(
        "doc_id", "text", "edited", *[iblt.digests(F.col(c)).alias(f"of_{c}") for c in ("text", "edited", "following")]).collect()
    assert set(got) == {doc for doc, _ in texts} and len(got) == len(texts)
    for r in sets:
        g = got[r["doc_id"]]
        assert g["n_chars"] == len(r["text"]) and g["edited_sha256"] == hashlib.sha256(r["edited"].encode()).hexdigest()
        assert g["near_edited"] == pytest.approx(shared(r["of_text"], r["of_edited"]))
        assert g["near_next"] == pytest.approx(shared(r["of_text"], r["of_following"]))
    by_text = {}
    for r in sets:
        assert by_text.setdefault(r["text"], got[r["doc_id"]]["fingerprint"]) == got[r["doc_id"]]["fingerprint"]
