"""Texts on one line keep digests in common with their edited form."""

import pytest
from pyspark.sql import functions as F

from cartulary.llm import common, iblt

SENTENCES = " ".join(f"the {w} was seen here." for w in "dog cat cow hen fox elk owl rat bat ape".split())
ADDRESS = " ".join(f"word{i * 7919 % 1000}" for i in range(200))
SIGNS = "".join(chr(0x4E00 + i * 37 % 5000) for i in range(400))


@pytest.mark.parametrize("text, least", [(SENTENCES, 5), (ADDRESS, 5), (SIGNS, 5), ("Short.", 0), ("", 0)])
def test_an_edit_of_the_second_half_leaves_the_first(spark, text, least):
    common.ship(spark)
    df = spark.createDataFrame([(text, "~" * len(text))], "a string, b string").withColumn("b", iblt.edited(F.col("a"), F.col("b")))
    both = df.select(*[iblt.digests(F.col(c)).alias(c) for c in "ab"])
    told = iblt.with_difference(both, "a", "b", "d").select("a", "b", "d", iblt.likeness("a", "b", "d").alias("near")).first()
    shared = set(told["a"]) & set(told["b"])
    assert len(shared) >= least and set(told["d"]) == set(told["a"]) ^ set(told["b"])
    assert told["near"] == (len(shared) / len(set(told["a"]) | set(told["b"])) if told["a"] else 1.0)
