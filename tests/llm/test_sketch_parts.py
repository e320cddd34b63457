"""Cells take some fifty times the text of a part, so parts stay small enough that a task's cells need no disk."""

from pyspark.sql import functions as F

from cartulary.llm import iblt


def test_a_part_holds_a_few_megabytes(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 1 << 20).alias("text"))
    parts = iblt.parts_of(docs)
    assert (200 << 20) / parts <= 5 << 20 and iblt.BUCKET_BYTES * 4 <= iblt.PART_BYTES
