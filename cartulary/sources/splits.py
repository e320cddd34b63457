"""Large text files read by many tasks although their records do not end where lines end.

A file is read as lines, each with the block it was read from and its turn in that block. Blocks are what Spark cuts a file
into, so one block is one task's share; what a line needs to know of the lines before it (rows so far, whether a quote is
open, where the record began) is summed up a block at a time and carried over the blocks of the file.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import running

PLACE = ("file", "block", "turn")


def placed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, turn, value): the lines of text files; block and turn together are their order in the file."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("turn"), "value")


def _in_file(df: DataFrame, sums: Mapping, carries: Mapping | None = None) -> DataFrame:
    return running(df, ["file"], F.col("block"), [F.col("turn")], sums, carries=carries)


def listing_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of JSON listings `[header, row, row, ...]` as (file, row_no from 0, cells), from files that hold rows on lines. Empty rows are none.

    A line may hold any number of whole rows, so a listing on one line is read too. Files in which a row runs over several
    lines are read whole, one task a file.
    """
    core = F.regexp_replace(F.trim(F.regexp_replace("value", r"\r$", "")), r"^,|,$", "")
    core = F.regexp_replace(F.regexp_replace(core, r"^\[\s*(?=\[|$)", ""), r"(?<=\]|^)\s*\]$", "")
    core = F.when(core.isin("", "[", "]"), F.lit("")).otherwise(core)
    rows = F.from_json(F.concat(F.lit("["), core, F.lit("]")), "array<array<string>>")
    lines = placed_lines(spark, path).withColumn("rows", F.filter(rows, lambda r: r.isNull() | (F.size(r) > 0)))
    broken = F.col("rows").isNull() | F.exists("rows", lambda r: r.isNull())
    spread = lines.where(broken).select("file").distinct()
    whole = lines.select("file").distinct().join(spread, "file", "left_semi")
    fine = lines.join(spread, "file", "left_anti").where(F.size("rows") > 0)
    numbered = _in_file(fine, {"__upto": F.size("rows").cast("long")})
    out = numbered.select("file", (F.col("__upto") - F.size("rows")).alias("__start"), F.posexplode("rows").alias("__i", "cells")).select(
        "file", (F.col("__start") + F.col("__i")).alias("row_no"), "cells")
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value").join(whole, "file", "left_semi")
    slow = raw.select("file", F.posexplode(F.from_json("value", "array<array<string>>")).alias("row_no", "cells")).where(F.size("cells") > 0).withColumn("row_no", F.col("row_no").cast("long"))
    return out.unionByName(slow)


def csv_records(spark: SparkSession, path: str | list[str], quote: str = '"') -> DataFrame:
    """(file, block, turn, record): CSV records with the line breaks inside their quotes, from blocks of any size.

    A line begins a record when the quotes before it in the file are even; a doubled quote inside a field counts twice and
    changes nothing. Records on one line are passed on as they are; only the lines of longer ones are brought together.
    """
    lines = placed_lines(spark, path)
    quotes = (F.length("value") - F.length(F.replace(F.col("value"), F.lit(quote)))).cast("long")
    counted = _in_file(lines.withColumn("__q", quotes), {"__upto": F.col("__q")})
    starts = (F.col("__upto") - F.col("__q")) % 2 == 0
    ends = F.col("__upto") % 2 == 0
    marked = counted.withColumns({"__first": starts, "__last": ends})
    single = marked.where("__first AND __last").select(*PLACE, F.regexp_replace("value", r"\r$", "").alias("record"))
    place = F.struct("block", "turn")
    parts = _in_file(marked.where("NOT (__first AND __last)").withColumn("__p", F.when(F.col("__first"), place)), {}, {"__at": "__p"})
    joined = (parts.groupBy("file", "__at").agg(F.sort_array(F.collect_list(F.struct("block", "turn", "value"))).alias("x"))  # lines of one record
              .select("file", F.coalesce("__at.block", F.get("x", 0)["block"]).alias("block"), F.coalesce("__at.turn", F.get("x", 0)["turn"]).alias("turn"),
                      F.regexp_replace(F.regexp_replace(F.array_join(F.transform("x", lambda r: r["value"]), "\n"), r"\r$", ""), "\r\n", "\n").alias("record")))
    return single.unionByName(joined)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str]) -> DataFrame:
    """CSV files with one header line each under a stated schema.

    Files without a line break inside quotes are Spark's own splittable reader's; the others are put together by
    `csv_records`. One pass over the lines, which only counts quotes, tells them apart.
    """
    quote = options.get("quote", '"')
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    odd = (F.length("value") - F.length(F.replace(F.col("value"), F.lit(quote)))) % 2 == 1
    told = {r["file"]: r["odd"] for r in lines.groupBy("file").agg(F.bool_or(odd).alias("odd")).toLocalIterator()}  # names of files
    reader = {k: v for k, v in options.items() if k not in ("multiLine", "header")}
    plain, broken = ([f for f, odd in told.items() if odd == which] for which in (False, True))
    parts = []
    if plain:
        parts.append(spark.read.schema(schema).options(**reader, header="true").csv(plain))
    if broken:
        records = csv_records(spark, broken, quote)
        heads = records.groupBy("file").agg(F.min(F.struct("block", "turn")).alias("__h"))
        body = records.join(heads, "file").where((F.struct("block", "turn") > F.col("__h")) & (F.trim("record") != ""))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts.append(body.select(F.from_csv("record", fields, {**reader, "multiLine": "true"}).alias("r")).select("r.*"))
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)
