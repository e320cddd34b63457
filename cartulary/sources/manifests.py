"""What an archive holds: digests of its files, kept beside the data and combined upwards.

A file's digest is its rows' digests combined in an order-free way, so it does not depend on how the file is laid out, and
digests of files combine into a table's and tables' into the archive's version in the same way. Only files that are new or
have another length or time than when they were last read are read again.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTION = 1 << 52  # a double's fraction in whole steps: no double of at least 1 has a finer one
WHOLE = 1 << 62


def _text(c: Column, kind: T.DataType) -> Column:
    """The value as a text that two values share only if they are equal, and that any engine can make."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        d = c.cast("double")
        parts = F.concat_ws(".", F.floor(d).cast("string"), F.floor((d - F.floor(d)) * F.lit(float(FRACTION))).cast("string"))
        return F.when(F.abs(d) < float(WHOLE), parts).otherwise(d.cast("string"))
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: _marked(x, kind.elementType)), ","), F.lit("]"))
    if isinstance(kind, (T.StructType, T.MapType, T.VariantType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return F.hex(c) if isinstance(kind, T.BinaryType) else c.cast("string")


def _marked(c: Column, kind: T.DataType) -> Column:
    """Length and text, so that no two lists of values run together; NULL is a mark of its own."""
    text = _text(c, kind)
    return F.when(c.isNull(), "~").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(schema: T.StructType) -> Column:
    """SHA-256 of all columns of a row, by name."""
    return F.sha2(F.concat(*[F.concat(F.lit(f"{f.name}="), _marked(F.col(f"`{f.name}`"), f.dataType)) for f in sorted(schema.fields, key=lambda f: f.name)]), 256)


def _combined(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), F.bit_xor("xor_1").alias("xor_1"), F.sum("sum_2").cast("decimal(38,0)").alias("sum_2"))


def _file(c: Column) -> Column:
    """One spelling of a file's address, whoever lists it."""
    return F.regexp_replace(c, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def listing(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """(table_name, file, length, modified) of all files of the tables. Reads no file's content."""
    parts = [spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.lit(name).alias("table_name"), _file(F.col("path")).alias("file"), "length", F.col("modificationTime").alias("modified")) for name, path in tables.items()]
    return reduce(DataFrame.unionAll, parts)


def _digests(spark: SparkSession, name: str, *paths: str) -> DataFrame:
    rows = spark.read.parquet(*paths)
    told = rows.select(_file(F.col("_metadata.file_path")).alias("file"), row_digest(rows.schema).alias("d"))
    return _combined(told.select(
        F.lit(name).alias("table_name"), "file", F.lit(1).cast("long").alias("n_rows"), F.conv(F.substring("d", 1, 15), 16, 10).cast("long").alias("xor_1"),
        F.conv(F.substring("d", 16, 12), 16, 10).cast("decimal(20,0)").alias("sum_2")), "table_name", "file")


def file_digests(spark: SparkSession, tables: Mapping[str, str], kept: DataFrame | None = None) -> DataFrame:
    """(table_name, file, length, modified, n_rows, xor_1, sum_2) of every file of the Parquet tables.

    With `kept`, an earlier result, only files that are not in it as they are now are read; a file that went is no longer
    there. The list of files to read is on the driver, as Spark's own list of a table's files is. A file without rows has 0.
    """
    files = listing(spark, tables)
    if kept is None:
        fresh = reduce(DataFrame.unionAll, [_digests(spark, name, path) for name, path in tables.items()])
        out = files.join(fresh, ["table_name", "file"], "left")
    else:
        same = ["table_name", "file", "length", "modified"]
        changed: dict[str, list[str]] = {}
        for r in files.join(kept, same, "left_anti").toLocalIterator():
            changed.setdefault(r["table_name"], []).append(r["file"])
        known = files.join(kept, same)
        if not changed:
            return known.select(*same, "n_rows", "xor_1", "sum_2")
        fresh = reduce(DataFrame.unionAll, [_digests(spark, name, *paths) for name, paths in changed.items()])
        new = files.join(kept, same, "left_anti").join(fresh, ["table_name", "file"], "left")
        out = known.select(*same, "n_rows", "xor_1", "sum_2").unionByName(new)
    zero = F.lit(0).cast("long")
    return out.select("table_name", "file", "length", "modified", F.coalesce("n_rows", zero).alias("n_rows"), F.coalesce("xor_1", zero).alias("xor_1"),
                      F.coalesce("sum_2", zero.cast("decimal(38,0)")).alias("sum_2"))


def table_manifest(digests: DataFrame) -> DataFrame:
    """Row count and content digest of every table, from its files' digests."""
    return _combined(digests, "table_name").withColumn("sum_2", F.col("sum_2").cast("string"))
