"""Digests of all rows are dealt once: new tries are made where the rows lie, and only sizes of the next text go on."""

import pytest
from pyspark.sql import functions as F

from cartulary.llm import common, iblt, queries

SF = "/root/testdata/sf0.001"


def shuffled(df):
    """Columns of each shuffle in the plan of a frame."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return [line for line in plan if "Exchange hashpartitioning" in line]


@pytest.mark.parametrize("whole", [True, False])
def test_new_tries_do_not_shuffle_the_rows(spark, monkeypatch, whole):
    common.ship(spark)
    monkeypatch.setattr(iblt, "BLOCK_CELLS", 4)  # most blocks fail at first
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    kept, keep = [], iblt.keep
    monkeypatch.setattr(iblt, "keep", lambda df: kept.append(shuffled(df)) or keep(df))
    try:
        digest = lambda side: F.transform(F.sequence(F.lit(1), 40 + F.col("id")), lambda i: F.xxhash64(F.when(i % 3 == 0, F.lit(0)).otherwise(side), i, "id"))
        rows = spark.range(12).select((F.col("id") % 3).alias("bucket"), F.col("id").alias("row"), *[F.array_sort(digest(k)).alias(f"of_{k}") for k in (1, 2)])
        got = iblt.with_differences(rows, {"d": ("of_1", "of_2")}, 5, whole).select("of_1", "of_2", "d").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(got) == 12
    for r in got:
        differing = set(r["of_1"]) ^ set(r["of_2"])
        assert differing and (set(r["d"]) == differing if whole else r["d"] == len(differing))
    assert len(kept) > 1 and not kept[0]
    for plan in kept[1:]:
        assert len(plan) == 1 and "hashpartitioning(bucket#" in plan[0] and "REPARTITION_BY_NUM" in plan[0], plan  # the failing ones alone
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_the_next_digests_are_not_shuffled_with_the_result(spark):
    got = queries.op8_paragraph_sketch(spark, SF)
    scans = [line for line in got._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line and "n_next" in line]
    assert scans and all("next#" not in line.replace("n_next#", "") and "array<bigint>,next:" not in line for line in scans), scans
