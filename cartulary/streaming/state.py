"""Answers that a stream keeps: what is known of a key is its state, and a batch only touches the keys it brings.

Each micro-batch is first reduced inside its partitions, so a hot key sends one row a task to its state. The states are the
buffers of Spark's own streaming aggregations: no row and no key goes through Python.
The state of a key is small: its newest value and what is needed to tell a dispute. Changed answers are written under the
batch's own number, so a batch that is run again after a failure replaces itself, and the newest row of a key is its answer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ingest import _run


def latest_updates(stream: DataFrame, keys: Sequence[str], compared: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A row for each key a batch touched: its newest value so far (by `order`), how often it was seen, how many values it had.

    Rows without any compared value count as seen but are no value. The state holds a hash for each different value of the
    key, so a dispute is never forgotten; arrival order and batch borders change nothing in the answer.
    """
    known = sum((F.col(c).isNotNull().cast("int") for c in compared), F.lit(0)) > 0
    per = stream.groupBy(*keys).agg(F.max(F.struct(*order, *compared)).alias("__x"), F.count(F.lit(1)).alias("n_captures"),
                                    F.collect_set(F.when(known, F.xxhash64(*compared))).alias("__hashes"))
    return per.select(*keys, *[F.col(f"__x.{c}").alias(c) for c in (*compared, *order)], "n_captures", F.size("__hashes").cast("long").alias("n_variants"))


def first_updates(stream: DataFrame, digest: str, ident: str, stamp: str, relabel: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """A row for each digest a batch touched: its earliest capture so far and how often it was captured.

    `relabel` renames captures by their own time before they are told apart, so one that arrives late is labelled like one in time.
    """
    rows = stream if relabel is None else relabel(stream)
    per = rows.groupBy(digest).agg(F.min(F.struct(stamp, ident)).alias("__x"), F.count(F.lit(1)).alias("n_captures"))
    return per.select(digest, F.col(f"__x.{ident}").alias(ident), F.col(f"__x.{stamp}").alias(stamp), "n_captures")


def keep_updates(updates: DataFrame, ledger: str, checkpoint: str) -> None:
    """Run the stream over all that has arrived; each batch's changed answers go under its own number."""
    _run(updates, lambda b: b, ledger, checkpoint, mode="update")


def answers(spark: SparkSession, ledger: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """The newest row of each key: only answers that changed were written, and none is worked out again."""
    whole = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(whole).parquet(ledger)
    rest = [f.name for f in schema.fields if f.name not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("__x")).select(*keys, "__x.*")
