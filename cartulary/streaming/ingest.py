"""Captures that keep arriving. The batch twins are `digest_representative` and `latest_wins`.

Each micro-batch is reduced and written under its own batch number, so a batch that is
run again after a failure replaces itself. Readers fold the batches; because the fold
does not depend on order, a late capture gives the same answer as an early one and no
unbounded state is kept in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None, fmt: str = "parquet",
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def _run(stream: DataFrame, reduce_batch: Callable[[DataFrame], DataFrame], ledger: str, checkpoint: str, mode: str = "append") -> None:
    def write(batch: DataFrame, batch_id: int) -> None:
        reduce_batch(batch).write.mode("overwrite").parquet(f"{ledger}/batch_id={batch_id}")

    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _earliest(df: DataFrame, digest: str, ident: str, stamp: str) -> DataFrame:
    return df.groupBy(digest).agg(F.min(F.struct(stamp, ident)).alias("__x"), F.sum("n_captures").alias("n_captures")).select(
        digest, F.col(f"__x.{ident}").alias(ident), F.col(f"__x.{stamp}").alias(stamp), "n_captures")


def ingest_captures(stream: DataFrame, digest: str, ident: str, stamp: str, ledger: str, checkpoint: str,
                    relabel: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Append one row per new digest and batch; late captures may be relabelled by their capture time first."""
    rows = stream if relabel is None else relabel(stream)
    _run(rows, lambda b: _earliest(b.withColumn("n_captures", F.lit(1).cast("long")), digest, ident, stamp), ledger, checkpoint)


def captures(spark: SparkSession, ledger: str, digest: str, ident: str, stamp: str) -> DataFrame:
    """One row per digest over all batches: its earliest capture and how often it was captured."""
    return _earliest(spark.read.parquet(ledger), digest, ident, stamp)


def ingest_observations(stream: DataFrame, keys: Sequence[str], compared: Sequence[str], order: Sequence[str], ledger: str,
                        checkpoint: str) -> None:
    """Append, per batch, each distinct value of a key with its newest time and count."""
    def per_batch(b: DataFrame) -> DataFrame:
        return b.groupBy(*keys, *compared).agg(F.max(F.struct(*order)).alias("newest"), F.count("*").alias("n_captures"))

    _run(stream, per_batch, ledger, checkpoint)


def latest_observations(spark: SparkSession, ledger: str, keys: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """Newest value per key over all batches, disputed when another value was ever seen."""
    values = (spark.read.parquet(ledger).groupBy(*keys, *compared)
              .agg(F.max("newest").alias("newest"), F.sum("n_captures").alias("n_captures")))
    known: Column = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in compared])
    return (values.groupBy(*keys)
            .agg(F.max(F.struct("newest", *compared)).alias("x"), F.sum("n_captures").alias("n_captures"), F.count_if(known).alias("n_variants"))
            .select(*keys, "x.*", "n_captures", "n_variants")
            .withColumn("confidence", F.when(F.col("n_variants") > 1, "disputed").otherwise("single-source")))


def compact(spark: SparkSession, ledger: str, target: str, fold: Callable[[DataFrame], DataFrame]) -> None:
    """Fold the batches into one written table; the ledger itself is left as it is."""
    fold(spark.read.parquet(ledger)).write.mode("overwrite").parquet(target)
