"""Choosing among repeated observations of one fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import attach_totals, null_safe, top_k


class Latest(NamedTuple):
    latest: DataFrame    # one row per key
    variants: DataFrame  # one row per key and distinct compared value, with its count


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str], compared: Sequence[str]) -> Latest:
    """Newest observation per key; older ones that disagree make it disputed.

    The variants stay a table of their own, so a key with very many of them is
    never gathered into one row.
    """
    known = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in compared])
    rest = [c for c in df.columns if c not in keys and c not in order and c not in compared]
    # newest row and count per distinct value first; the keys are then folded from those
    values = df.groupBy(*keys, *compared).agg(
        F.max(F.struct(*order, *rest)).alias("__x"), F.count("*").alias("n_captures"))
    latest = (values.groupBy(*keys)
              .agg(F.max(F.struct("__x", *compared)).alias("__y"), F.sum("n_captures").alias("n_captures"),
                   F.count_if(known).alias("n_variants"))
              .select(*keys, "__y.__x.*", *[F.col(f"__y.{c}") for c in compared], "n_captures", "n_variants")
              .withColumn("confidence", F.when(F.col("n_variants") > 1, "disputed").otherwise("single-source")))
    return Latest(latest, values.drop("__x"))


def latest_batch(df: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """All rows of the newest capture of each group.

    The join key holds the capture time too, so a hot group is already spread by time.
    """
    newest = df.groupBy(*keys).agg(F.max(stamp).alias(stamp)).withColumn("__newest", F.lit(True))
    return null_safe(df, newest, [*keys, stamp]).where("__newest").drop("__newest")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_k(df, keys, order)


def keep_fullest(df: DataFrame, keys: Sequence[str], score: Sequence[Column], tie: Sequence[Column]) -> DataFrame:
    """The record with the best score per key."""
    return top_k(df, keys, [*[s.desc_nulls_last() for s in score], *tie])


def best_by_measure(df: DataFrame, keys: Sequence[str], measure: Column, tie: Sequence[Column]) -> DataFrame:
    """The row with the largest measure, unknown counting as zero; never a sum of rows."""
    return top_k(df, keys, [F.coalesce(measure, F.lit(0)).desc(), *tie])


def distinct_observations(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Distinct rows of several sources; each source is reduced before the union."""
    parts = [f.select(*columns).distinct() for f in frames]
    return reduce(DataFrame.unionByName, parts).distinct()


def digest_representative(df: DataFrame, content: str, ident: str, order: str | None = None,
                          newest: bool = False) -> DataFrame:
    """Every row with the representative of its content digest and the size of its copy group."""
    pick = (F.max_by if newest else F.min_by)(ident, order or ident)
    digested = df.withColumn("digest", F.sha2(F.col(content), 256)).drop(content)
    return attach_totals(digested, ["digest"], {"representative": pick, "n_copies": F.count(F.lit(1))})


def ranked_candidates(df: DataFrame, keys: Sequence[str], rank: Sequence[Column], keep: int) -> DataFrame:
    """The best `keep` candidates per key with their rank, so a failed first choice has a fallback."""
    return top_k(df, keys, rank, keep, rank_col="candidate_rank")


def merge_sources(df: DataFrame, key: str, priority: str, first: Sequence[str], counters: Sequence[str] = (),
                  sets: Mapping[str, str] | None = None) -> DataFrame:
    """One entity per key from many sources: first known value by priority, widest counters, distinct counts of sets."""
    aggs = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(priority))).alias(c) for c in first]
    aggs += [F.max(c).alias(c) for c in counters]
    aggs += [F.count_distinct(c).alias(n) for n, c in (sets or {}).items()]
    return df.groupBy(key).agg(*aggs)
