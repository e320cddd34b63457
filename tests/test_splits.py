"""Files read by many tasks give the rows of the whole-text readers; digests read only what changed."""

import csv
import json
import os
import random
import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.operators import skew
from cartulary.sources import manifests, splits, tables


@pytest.fixture()
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def test_listings(spark, tmp_path, small_splits):
    rng = random.Random(1)
    want = [["k", "t", "u"]] + [[f"k{i}", str(i), 'a"],["b' * rng.randrange(2) + "]]" * rng.randrange(2) + "é,"] for i in range(400)]
    texts = {"lines": "[" + ",\n ".join(map(json.dumps, want)) + "]\n", "one": json.dumps(want), "spread": json.dumps(want[:9], indent=2), "none": "[]", "empty": "",
             "commas": "[\n" + "\n,".join(map(json.dumps, want)) + "\r\n]"}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text, newline="")
    assert splits.placed_lines(spark, f"{tmp_path}/lines.json").rdd.getNumPartitions() > 10
    got = {n: {} for n in texts}
    for r in splits.listing_rows(spark, f"{tmp_path}/*.json").collect():
        got[os.path.basename(r.file)[:-5]][r.row_no] = list(r["cells"])
    assert got == {n: dict(enumerate(json.loads(t or "[]"))) for n, t in texts.items()}
    fields = tables.listing_columns(tables.read_capture_listing(spark, f"{tmp_path}/lines.json"), ["t", "none"])
    assert rows(fields, "row_no", "t", "none") == [(i, str(i - 1), None) for i in range(1, 401)]


def test_csv_with_line_breaks_in_quotes(spark, tmp_path, small_splits):
    rng = random.Random(2)
    data = [(i, rng.choice(["", "x", "a,b", 'q"uo"te']), rng.choice(["plain", "two\nlines", 'three\r\n\nlines,"x"\n', "", "long " * 300 + "\n" + "tail " * 300])) for i in range(300)]
    for name, part in (("broken", data), ("plain", [(i, n, "z") for i, n, _ in data]), ("head", [])):
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            csv.writer(f).writerows([("id", "name", "note"), *part])
    schema = T.StructType.fromDDL("id int, name string, note string")
    got = tables.read_table(spark, f"{tmp_path}/*.csv", schema)
    assert rows(got) == rows(spark.read.schema(schema).options(**tables.CSV).csv(f"{tmp_path}/*.csv")) and got.count() == 600
    assert tables.read_table(spark, f"{tmp_path}/*.none", schema).count() == 0


def test_ranges_follow_the_data(spark):
    """No fixed buckets: values that all lie between -1 and 1 spread evenly, and a value many rows share is split."""
    rng = random.Random(3)
    data = [(i, 0.25 if i % 3 == 0 else rng.uniform(-1, 1)) for i in range(30000)]
    df = spark.createDataFrame(data, "id long, v double").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    out = skew.ranged(df, [F.col("v"), F.col("id")], {"place": F.lit(1).cast("long"), "upto": F.col("id")})
    sizes = sorted(r["count"] for r in df.repartitionByRange("v", "id").groupBy(F.spark_partition_id()).count().collect())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]
    order = sorted(data, key=lambda r: (r[1], r[0]))
    total, want = 0, {}
    for place, (i, _) in enumerate(order, 1):
        total += i
        want[i] = (place, total)
    assert {r.id: (r.place, r.upto) for r in out.collect()} == want
    assert skew.ranged(df.limit(0), [F.col("v")], {"n": F.lit(1)}).count() == 0


def test_digests_read_only_what_changed(spark, tmp_path, monkeypatch):
    for name in ("a", "b"):
        spark.range(100).select("id", (F.col("id") / 7).alias("x"), F.when(F.col("id") % 3 > 0, "t").alias("s"), F.array("id").alias("l"),
                                F.lit("2020-01-02").cast("timestamp").alias("at")).repartition(4).write.parquet(f"{tmp_path}/{name}")
    spark.createDataFrame([], "id long").write.parquet(f"{tmp_path}/c")
    where = {n: f"{tmp_path}/{n}" for n in "abc"}
    first = manifests.file_digests(spark, where)
    first.write.parquet(f"{tmp_path}/kept")
    kept = spark.read.parquet(f"{tmp_path}/kept")
    before = rows(manifests.table_manifest(kept))
    assert before[0][1:] == before[1][1:] and [r[1] for r in before] == [100, 100, 0]  # layout does not matter
    new = spark.range(3).select("id", F.lit(1.5).alias("x"), F.lit(None).cast("string").alias("s"), F.array("id").alias("l"), F.lit(None).cast("timestamp").alias("at"))
    new.coalesce(1).write.mode("append").parquet(f"{tmp_path}/b")
    read = []
    digests = manifests._digests
    monkeypatch.setattr(manifests, "_digests", lambda s, name, *paths: read.append((name, len(paths))) or digests(s, name, *paths))
    again = manifests.file_digests(spark, where, kept)
    after = rows(manifests.table_manifest(again))
    assert read == [("b", 1)] and after[0] == before[0] and after[1][1] == 103 and after[1][2:] != before[1][2:]
    read.clear()
    assert rows(manifests.table_manifest(manifests.file_digests(spark, where, again))) == after and read == []
    shutil.copytree(f"{tmp_path}/b", f"{tmp_path}/d")
    assert rows(manifests.table_manifest(manifests.file_digests(spark, {"b": f"{tmp_path}/d"})))[0][1:] == after[1][1:]


@pytest.mark.parametrize("a, b", [(("1", "2"), ("12", "")), ((None, "~"), ("~", None)), (("1", None), ("1", "")), (("0.1", "x"), ("0.10000000000000002", "x"))])
def test_rows_that_differ_have_other_digests(spark, a, b):
    df = spark.createDataFrame([a, b], "p string, q string")
    df = df.select(F.col("p").try_cast("double").alias("d"), "p", "q")
    got = [r.x for r in df.select(manifests.row_digest(df.schema).alias("x")).collect()]
    assert got[0] != got[1]
