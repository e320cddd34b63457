"""Tables on disk: CSV (plain or gzip), capture listings, sidecar metadata, and their sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.reconcile import table_digest
from ..operators.skew import numbered, top_k
from . import splits

CSV = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "encoding": "UTF-8", "nullValue": "", "emptyValue": ""}


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV or .csv.gz table with a stated schema; a file that is not there has no rows."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p):
        return spark.createDataFrame([], schema)
    return splits.read_csv(spark, path, schema, CSV)


def write_table(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[Column], sep: str = ",",
                mode: str = "overwrite") -> None:
    """Fixed columns in a full order, NULL as an empty cell. The sort is a range partitioning, not one task."""
    (df.orderBy(*order).select(*[F.col(c).cast("string") for c in columns])
     .write.mode(mode).options(**{**CSV, "sep": sep}).csv(path))


def export_rows(df: DataFrame, path: str, order: Sequence[Column], tsv: bool = False) -> None:
    """The whole result, not the page on screen. The first header carries a byte-order mark for spreadsheets."""
    first = df.columns[0]
    out = df.orderBy(*order)
    out = out if tsv else out.withColumnRenamed(first, "﻿" + first)
    out.write.mode("overwrite").options(**{**CSV, "sep": "\t" if tsv else ","}).csv(path)


def overwrite_subtree(df: DataFrame, path: str, partition: Sequence[str]) -> None:
    """Replace a generated tree as a whole, so no partition of an earlier build survives."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition).parquet(path))


def read_capture_listing(spark: SparkSession, path: str) -> DataFrame:
    """Archive index files, each `[header, row, row, ...]`, as (file, row_no, fields map)."""
    rows = splits.listing_rows(spark, path)
    heads = rows.where("row_no = 0").select("file", F.col("cells").alias("__h"))
    return rows.where("row_no > 0").join(heads, "file").select("file", "row_no", F.map_from_arrays("__h", "cells").alias("fields"))


def listing_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select("file", "row_no", *[F.try_element_at("fields", F.lit(n)).alias(n) for n in names])


def publish_entities(df: DataFrame, entity: str, fields: Sequence[str], buckets: Column | Sequence[Column],
                     order: Sequence[Column], size: int = 1000) -> DataFrame:
    """One nested JSON record per entity, its rows sorted, in parts of `size` rows.

    An entity with very many rows becomes several parts, so no record is unbounded and
    none is cut. Keys are sorted, unknown values stay null.
    """
    n = numbered(df, [entity], buckets, order, "__n")
    rows = n.select(entity, F.floor((F.col("__n") - 1) / size).cast("int").alias("part"), "__n",
                    F.struct(*[F.col(f) for f in sorted(fields)]).alias("__r"))
    packed = rows.groupBy(entity, "part").agg(F.sort_array(F.collect_list(F.struct("__n", "__r"))).alias("__a"))
    body = F.struct(F.size("__a").alias("count"), F.col(entity), "part", F.transform("__a", lambda x: x["__r"]).alias("rows"))
    return packed.select(entity, "part", F.to_json(body, {"ignoreNullFields": "false"}).alias("doc"))


class Section(NamedTuple):
    rows: DataFrame
    fields: Sequence[str]
    buckets: Column | Sequence[Column]
    order: Sequence[Column]


def publish_sections(sections: Mapping[str, Section], entity: str, size: int = 1000) -> DataFrame:
    """The full record of an entity (career, observations, box scores, ...) as one document per section and part."""
    parts = [publish_entities(s.rows, entity, s.fields, s.buckets, s.order, size)
             .select(entity, F.lit(name).alias("section"), "part", "doc") for name, s in sections.items()]
    return reduce(DataFrame.unionByName, parts)


def manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and content digest of every table."""
    parts = [table_digest(df).select(F.lit(name).alias("table_name"), "n_rows", "xor_1", F.col("sum_2").cast("string").alias("sum_2"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def version(manifest_rows: DataFrame, revision: str) -> DataFrame:
    """One version for the whole archive: it changes with any row of any table and with the build revision."""
    line = F.concat_ws(":", "table_name", "n_rows", "xor_1", "sum_2")
    return manifest_rows.agg(
        F.sha2(F.concat(F.lit(revision + "|"), F.array_join(F.sort_array(F.collect_list(line)), "|")), 256).alias("version"),
        F.sum("n_rows").alias("n_rows"))


def upsert_log(old: DataFrame, new: DataFrame, keys: Sequence[str], tie: Sequence[Column] = ()) -> DataFrame:
    """History log: what was logged stays, the newer batch wins per key. Needs a `batch` column on neither side."""
    both = old.withColumn("__batch", F.lit(0)).unionByName(new.withColumn("__batch", F.lit(1)), allowMissingColumns=True)
    return top_k(both, keys, [F.col("__batch").desc(), *tie]).drop("__batch")
