"""Window operators. Inputs at entity-and-period grain are bounded by the calendar;
row-grain inputs go through the bucketed forms in `skew`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import attach_totals, numbered, ranged, top_k  # noqa: F401


def change_from_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                         out: Mapping[str, str]) -> DataFrame:
    """Difference to the previous period of the same entity; NULL where either is unknown."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.select("*", *[(F.col(c) - F.lag(c).over(w)).alias(n) for n, c in out.items()])


def consecutive_runs(df: DataFrame, keys: Sequence[str], period: str, least: int = 2) -> DataFrame:
    """Runs of consecutive integer periods per key: first, last, length."""
    w = Window.partitionBy(*keys).orderBy(period)
    return (df.select(*keys, period).distinct()
            .withColumn("__island", F.col(period) - F.row_number().over(w))
            .groupBy(*keys, "__island")
            .agg(F.min(period).alias("run_start"), F.max(period).alias("run_end"),
                 F.count("*").alias("run_length"))
            .where(F.col("run_length") >= least).drop("__island"))


def holder_streaks(df: DataFrame, scope: Sequence[str], period: str, holder: str) -> DataFrame:
    """How long each period's holder had held it by then; a gap in periods ends the streak."""
    keys = [*scope, holder]
    w = Window.partitionBy(*keys).orderBy(period)
    inside = Window.partitionBy(*keys, "__island").orderBy(period)
    return (df.withColumn("__island", F.col(period) - F.row_number().over(w))
            .withColumn("streak", F.row_number().over(inside)).drop("__island"))


def shared_rank(df: DataFrame, measure: str, name: str = "place") -> DataFrame:
    """Equal measures share a place: 1, 2, 2, 4. A row without a measure has no place and moves nobody.

    Places are worked out on the distinct measures, in ranges of their own values, so no task sees the whole table.
    """
    per = df.where(F.col(measure).isNotNull()).groupBy(measure).agg(F.count("*").cast("long").alias("__n"))
    ranked = ranged(per, [F.col(measure).desc()], {"__upto": F.col("__n")})
    places = ranked.select(measure, (F.col("__upto") - F.col("__n") + 1).alias(name))
    return df.join(places, measure, "left")


def games_behind(df: DataFrame, group: Sequence[str], wins: str, losses: str, order: Sequence[Column]) -> DataFrame:
    """((leader wins - wins) + (losses - leader losses)) / 2 inside a group."""
    leader = top_k(df, group, order).select(
        *group, F.col(wins).alias("__lw"), F.col(losses).alias("__ll"))
    return (df.join(leader, list(group), "left")
            .withColumn("games_behind", ((F.col("__lw") - F.col(wins)) + (F.col(losses) - F.col("__ll"))) / 2)
            .drop("__lw", "__ll"))


def nth_occurrence(df: DataFrame, keys: Sequence[str], buckets: Column | Sequence[Column], order: Sequence[Column],
                   ordinal: str = "ordinal", total: str = "n_total") -> DataFrame:
    """Ordinal of a row among its key's rows, with the key's total."""
    return numbered(df, keys, buckets, order, ordinal, total)


def rank_contiguity(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Are the positions of each group exactly 1..n? Missing and duplicate positions."""
    per = df.groupBy(*keys, position).agg(F.count("*").alias("__n"))
    return (per.groupBy(*keys)
            .agg(F.count("*").alias("n_positions"), F.max(position).cast("long").alias("max_position"),
                 F.min(position).cast("long").alias("min_position"),
                 F.sum(F.col("__n") - 1).alias("n_duplicates"))
            .withColumn("contiguous", (F.col("n_positions") == F.col("max_position"))
                        & (F.col("min_position") == 1) & (F.col("n_duplicates") == 0)))


def share_of_max(df: DataFrame, keys: Sequence[str], value: str, floor: float = 0.02,
                 name: str = "share_of_max") -> DataFrame:
    """Value on a 0..1 axis of its group's maximum; unknown draws as 0, known at least `floor`."""
    return (attach_totals(df, keys, {"__max": F.max(value)})
            .withColumn(name, F.when(F.col(value).isNull(), F.lit(0.0)).otherwise(
                F.greatest(F.lit(floor), F.col(value) / F.nullif("__max", F.lit(0.0)))))
            .drop("__max"))


def share_of_group(df: DataFrame, keys: Sequence[str], value: Column, name: str = "share_pct") -> DataFrame:
    """Percent of its group's total."""
    valued = df.withColumn("__v", value)
    return (attach_totals(valued, keys, {"__sum": F.sum("__v")})
            .withColumn(name, F.when(F.col("__sum") != 0, F.col("__v") * 100 / F.col("__sum")))
            .drop("__v", "__sum"))
