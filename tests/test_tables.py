"""Files in and out, schemas, versioned tables and gated refresh."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from cartulary import schemas
from cartulary.operators import quality
from cartulary.sources import tables as tb


def test_csv_round_trip_keeps_null_text_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([(2, 'say "hi", ok', None), (1, "línea\ndos", "x"), (3, "", "y")], "k int, a string, b string")
    path = f"{tmp_path}/t"
    tb.write_table(df, path, ["k", "a", "b"], [F.col("k")])
    schema = schemas.T.StructType.fromDDL("k string, a string, b string")
    assert rows(tb.read_table(spark, path, schema)) == [("1", "línea\ndos", "x"), ("2", 'say "hi", ok', None), ("3", None, "y")]


def test_gzip_and_missing_tables(spark, tmp_path):
    with gzip.open(tmp_path / "p.csv.gz", "wt", encoding="utf-8") as f:
        f.write("k,a\n1,ñ\n")
    schema = schemas.T.StructType.fromDDL("k string, a string")
    assert rows(tb.read_table(spark, f"{tmp_path}/p.csv.gz", schema)) == [("1", "ñ")]
    assert tb.read_table(spark, f"{tmp_path}/none.csv", schema).count() == 0


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a"b'), (2, "c\td")], "k int, v string")
    tb.export_rows(df, f"{tmp_path}/csv", [F.col("k")])
    text = "".join(p.read_text("utf-8") for p in sorted((tmp_path / "csv").glob("part-*.csv")))
    assert text.startswith("﻿k,v\n") and '1,"a""b"' in text
    tb.export_rows(df, f"{tmp_path}/tsv", [F.col("k")], tsv=True)
    assert "k\tv\n" in "".join(p.read_text("utf-8") for p in (tmp_path / "tsv").glob("part-*.csv"))


def test_capture_listing(spark, tmp_path):
    (tmp_path / "l.json").write_text(json.dumps([["original", "timestamp", "statuscode"], ["http://a/x?anio=2001", "20010203040506", "200"], ["http://a/y", "2002", "-"]]))
    (tmp_path / "empty.json").write_text("[]")
    got = tb.listing_columns(tb.read_capture_listing(spark, f"{tmp_path}/*.json"), ["timestamp", "statuscode", "digest"])
    assert rows(got, "row_no", "timestamp", "statuscode", "digest") == [(1, "20010203040506", "200", None), (2, "2002", "-", None)]


def test_rebuilding_leaves_no_old_partition(spark, tmp_path):
    path = f"{tmp_path}/tree"
    tb.overwrite_subtree(spark.createDataFrame([("2001", 1), ("2002", 2)], "season string, v int"), path, ["season"])
    tb.overwrite_subtree(spark.createDataFrame([("2002", 3)], "season string, v int"), path, ["season"])
    assert sorted(p.name for p in (tmp_path / "tree").glob("season=*")) == ["season=2002"]


def test_log_is_history(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = tb.upsert_log(old, new, ["k"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(tb.upsert_log(once, new, ["k"])) == rows(once)
    assert rows(tb.upsert_log(once, new.limit(0), ["k"])) == rows(once)


def test_publish_splits_a_hot_entity_without_losing_rows(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("e"), "id", F.lit(None).cast("string").alias("note"))
    docs = tb.publish_entities(df, "e", ["id", "note"], F.floor(F.col("id") / 500), [F.col("id")], 100).collect()
    parsed = [json.loads(d.doc) for d in docs]
    assert sum(p["count"] for p in parsed) == 5000 and max(p["count"] for p in parsed) == 100
    hot = [r["id"] for p in sorted((p for p in parsed if p["e"] == 0), key=lambda p: p["part"]) for r in p["rows"]]
    assert hot == list(range(0, 5000, 3)) and parsed[0]["rows"][0]["note"] is None


@pytest.mark.parametrize("name", schemas.tables())
def test_every_schema_types_blank_text_as_null(spark, name):
    text = schemas.text_schema(name)
    df = spark.createDataFrame([tuple("" for _ in text)], text)
    out = schemas.typed(df, name)
    assert out.schema.names == schemas.schema(name).names
    assert all(v is None for v in out.collect()[0])


def test_typing_values(spark):
    text = schemas.text_schema("identity_decisions")
    row = {"decision_id": "D1", "kind": "merge", "ids": "1; 2|x", "survivor_id": "1", "evidence": "e"}
    out = schemas.typed(spark.createDataFrame([tuple(row.get(f.name, "") for f in text)], text), "identity_decisions").collect()[0]
    assert out.ids == [1, 2, None] and out.survivor_id == 1


def orders(spark, n, bad=False):
    return spark.range(n).select("id", F.when(F.lit(bad) & (F.col("id") == 1), None).otherwise(F.lit("ok")).alias("state"))


def test_gated_refresh(spark, tmp_path):
    rules = {"state": quality.required("state")}

    def more(df):
        return quality.check_rules(df, {"id": F.col("id") >= 0})

    first = quality.gated_refresh(orders(spark, 3), f"{tmp_path}/orders", ["id"], rules, more)
    assert first.passed and first.n_rows == 3 and spark.read.parquet(first.path).count() == 3
    assert rows(first.changes.groupBy("change").count()) == [("added", 3)]
    assert rows(first.results, "check_name", "n_checked", "n_failed", "passed") == [("id", 3, 0, True), ("rows", 3, 0, True), ("state", 3, 0, True), ("unique id", 3, 0, True)]
    current = spark.read.parquet(first.path)
    blocked = quality.gated_refresh(orders(spark, 9, bad=True), f"{tmp_path}/orders", ["id"], rules, current=current)
    assert not blocked.passed and blocked.path != first.path and current.count() == 3
    assert rows(blocked.results.where("NOT passed"), "check_name", "n_failed") == [("state", 1)]
    grown = quality.gated_refresh(orders(spark, 4), f"{tmp_path}/orders", ["id"], rules, current=current)
    assert grown.passed and rows(grown.changes) == [(3, "added")]
    assert not quality.gated_refresh(orders(spark, 0), f"{tmp_path}/orders", ["id"], rules).passed
    twice = orders(spark, 2).unionByName(orders(spark, 1))
    assert rows(quality.gated_refresh(twice, f"{tmp_path}/orders", ["id"], {}).results.where("NOT passed"), "check_name", "n_failed") == [("unique id", 1)]


def test_checks(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1,), (3,)], "k int")
    got = {r.check_name: (r.n_checked, r.n_failed, r.passed) for r in quality.suite(
        quality.check_unique(a, "unique", ["k"]), quality.check_rules(a, {"known": F.col("v").isNotNull(), "enum": F.col("v").isin("x", "y")}),
        quality.check_reference(a, "fk", "k", b, "k"), quality.check_reference(a, "none retired", "k", b, "k", forbidden=True),
        quality.check_rates(a, {"rate": (F.col("k") == 1, 0.5, 0.7)}), quality.check_exclusive(a, b, "xor", ["k"]),
        quality.check_totals(b.withColumn("n", F.lit(2)), a, "sum", ["k"], "n", F.count("*")), quality.check_same_rows(a, a, "same"),
        quality.check_same_rows(a, a.dropDuplicates(["k"]), "less"), quality.scan_text(a.withColumn("v", F.lit("PeÃ±a")), ["v"], {"bad": quality.DAMAGED})).collect()}
    assert got == {"unique": (2, 1, False), "known": (3, 1, False), "enum": (3, 1, False), "fk": (3, 1, False), "none retired": (3, 2, False),
                   "rate": (3, 1, True), "xor": (3, 1, False), "sum": (3, 2, False), "same": (3, 0, True), "less": (3, 1, False), "v: bad": (3, 3, False)}


def test_published_records_read_back_as_written(spark, tmp_path):
    df = spark.createDataFrame([(1, 5, None), (1, 6, "a"), (2, 7, "b")], "e int, id int, note string")
    tb.publish_entities(df, "e", ["id", "note"], F.lit(0), [F.col("id")]).write.parquet(f"{tmp_path}/p")
    doc = F.from_json("doc", "e int, count int, rows array<struct<id: int, note: string>>")
    back = (spark.read.parquet(f"{tmp_path}/p").select(doc.alias("d")).select("d.e", F.explode("d.rows").alias("r")).select("e", "r.id", "r.note"))
    assert quality.check_same_rows(df, back, "published").collect()[0].passed
