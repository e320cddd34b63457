"""Building blocks that stay exact when one key holds a large share of the rows.

Nothing here drops, caps or samples rows: work is pre-aggregated, split into
ordered pieces, or limited per map task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

Keys = Sequence[str]
HOT_SHARE = 1000  # totals: a key is hot when it holds at least 1/HOT_SHARE of the rows


def null_safe(left: DataFrame, right: DataFrame, keys: Keys, how: str = "left") -> DataFrame:
    """Join on keys where NULL equals NULL; the key columns of `left` stay."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def shuffled(df: DataFrame) -> DataFrame:
    """A join side that is never broadcast: exploded keys and per-key totals, which Catalyst takes for as small as the file
    they come from, though they grow with the rows."""
    return df.hint("merge")


def top_k(df: DataFrame, keys: Keys, order: Sequence[Column], k: int = 1, rank_col: str | None = None) -> DataFrame:
    """First k rows per key in a full order.

    Catalyst turns the filtered rank into a group limit on the map side, so a hot
    key sends at most k rows per task through the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    name = rank_col or "__rank"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def running(df: DataFrame, keys: Keys, buckets: Column | Sequence[Column], order: Sequence[Column],
            sums: Mapping[str, Column], overall: Mapping[str, str] | None = None, carries: Mapping[str, str] | None = None) -> DataFrame:
    """Running totals per key in `order`, and for each of `carries` (name: column) its last known value so far.

    `buckets` goes from coarse to fine (say day, then id range) and must not decrease along `order`. Every key spreads
    over its finest buckets; each coarser level only orders the totals of the level below, so neither a hot key nor a hot
    day meets in one task, and a key's size changes nothing in the plan. The input is read twice: once for the totals of
    its buckets, once for its rows, which are shuffled by key and bucket and stay there. `overall` names columns for the
    key's whole total.
    """
    carries = carries or {}
    cols = [buckets] if isinstance(buckets, Column) else list(buckets)
    levels = [f"__b{i}" for i in range(len(cols))]
    base = df.withColumns(dict(zip(levels, cols, strict=True)))
    at_row = F.struct(*order)
    totals = base.groupBy(*keys, *levels).agg(
        F.count(F.lit(1)).alias("__rows"), *[F.sum(v).alias(f"__t_{n}") for n, v in sums.items()],
        *[F.max_by(v, F.when(F.col(v).isNotNull(), at_row)).alias(f"__c_{n}") for n, v in carries.items()])
    starts = totals.select(*keys, *levels)
    for i, level in enumerate(levels):
        at, finer = [*keys, *levels[:i + 1]], levels[i + 1:]
        size = totals if not finer else totals.groupBy(*at).agg(
            F.sum("__rows").alias("__rows"), *[F.sum(f"__t_{n}").alias(f"__t_{n}") for n in sums],
            *[F.max_by(f"__c_{n}", F.when(F.col(f"__c_{n}").isNotNull(), F.struct(*finer))).alias(f"__c_{n}") for n in carries])
        whole = Window.partitionBy(*keys, *levels[:i])
        before = whole.orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        prefix = size.select(
            *at, *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__s{i}_{n}") for n in sums],
            *[F.last(f"__c_{n}", ignorenulls=True).over(before).alias(f"__l{i}_{n}") for n in carries],
            *([F.sum(f"__t_{n}").over(whole).alias(name) for name, n in (overall or {}).items()] if i == 0 else []))
        starts = prefix if len(levels) == 1 else null_safe(starts, prefix, at)
    inside = Window.partitionBy(*keys, *levels).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    depth = range(len(levels))
    out = null_safe(base, starts, [*keys, *levels])
    new = {n: sum((F.col(f"__s{i}_{n}") for i in depth[1:]), F.col(f"__s0_{n}")) + F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in sums.items()}
    new |= {n: F.coalesce(F.last(v, ignorenulls=True).over(inside), *[F.col(f"__l{i}_{n}") for i in reversed(depth)]) for n, v in carries.items()}
    return out.withColumns(new).drop(*levels, *[f"__s{i}_{n}" for i in depth for n in sums], *[f"__l{i}_{n}" for i in depth for n in carries])


def ranged(df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """Running totals over the whole table in a full order, over ranges whose borders come from the data.

    Spark samples the order's own values for the borders, so ranges are of like size whatever the values are, and a value
    that many rows share is split by what comes after it in the order. The rows are written in their ranges once; a range's
    totals are one row, and what goes before each range is added to the running totals inside it.
    """
    out = written(df.withColumns({f"__v_{n}": v for n, v in sums.items()}).repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    totals = out.groupBy("__part").agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in sums])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("__part", *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__s_{n}") for n in sums])
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    new = {n: F.col(f"__s_{n}") + F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0)) for n in sums}
    return (out.join(F.broadcast(starts), "__part").withColumns(new)  # one row for each range
            .select(*df.columns, *sums))


def numbered(df: DataFrame, keys: Keys, buckets: Column | Sequence[Column], order: Sequence[Column], name: str = "ordinal",
             total: str | None = None) -> DataFrame:
    """Position 1..n of each row in its key, and n when `total` names it. For positions in a whole table, `ranged` needs no buckets."""
    return running(df, keys, buckets, order, {name: F.lit(1).cast("long")}, {total: name} if total else None)


def attach_totals(df: DataFrame, keys: Keys, aggs: Mapping[str, Column]) -> DataFrame:
    """Per-key aggregates put back on every row of the key.

    Hot keys (at most HOT_SHARE of them by construction, so their side has a proven
    size) are attached by broadcast; their rows then spread over the join by a row
    hash instead of meeting in one task.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), *[a.alias(n) for n, a in aggs.items()])
    total = per_key.agg(F.sum("__rows").alias("all")).scalar()  # the same exchange again, not the rows
    is_hot = F.col("__rows") * HOT_SHARE >= F.greatest(total, F.lit(HOT_SHARE * 1000))
    names = list(aggs)
    hot = per_key.where(is_hot).select(
        *keys, F.lit(True).alias("__hot"), *[F.col(n).alias(f"__h_{n}") for n in names])
    cold = per_key.where(~is_hot).select(*keys, F.lit(0).alias("__salt"), *names)
    left = null_safe(df, F.broadcast(hot), keys).withColumn(
        "__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)).cast("int") + 1).otherwise(0))
    out = null_safe(left, cold, [*keys, "__salt"])
    return out.select(*df.columns, *[F.coalesce(f"__h_{n}", n).alias(n) for n in names])


def fill_down(df: DataFrame, keys: Keys, buckets: Column | Sequence[Column], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Last known value carried down each key in `order`, bucket by bucket like `running`."""
    return running(df, keys, buckets, [F.col(c) for c in order], {}, carries={name: value})
