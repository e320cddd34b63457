"""Set operations over same-shaped sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import null_safe


def union_sources(sources: Mapping[str, DataFrame], source: str = "source_id") -> DataFrame:
    """All rows of all sources with their source name; missing columns are NULL."""
    parts = [df.withColumn(source, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def key_spine(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Every key that occurs in any of the frames, once."""
    return reduce(DataFrame.unionByName, [f.select(*keys).distinct() for f in frames]).distinct()


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys added, removed or changed between two snapshots with unique keys."""

    def digested(df, side):
        values = [c for c in sorted(df.columns) if c not in keys]
        packed = F.to_json(F.struct(*[F.col(c) for c in values]), {"ignoreNullFields": "false"})
        return df.select(*[F.col(k).alias(f"__{side}_{k}") for k in keys], F.sha2(packed, 256).alias(f"__{side}"))

    o, n = digested(old, "o"), digested(new, "n")
    cond = reduce(lambda a, b: a & b, [F.col(f"__o_{k}").eqNullSafe(F.col(f"__n_{k}")) for k in keys])
    status = (F.when(F.col("__o").isNull(), "added").when(F.col("__n").isNull(), "removed")
              .when(F.col("__o") != F.col("__n"), "changed"))
    return (o.join(n, cond, "full_outer")
            .select(*[F.coalesce(f"__o_{k}", f"__n_{k}").alias(k) for k in keys], status.alias("change"))
            .where(F.col("change").isNotNull()))


def key_differences(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on one side only, labelled."""
    a, b = left.select(*keys), right.select(*keys)
    return (a.exceptAll(b).withColumn("side", F.lit("left_only"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("right_only"))))


def fill_gaps(base: DataFrame, additions: DataFrame, keys: Sequence[str], compare: Mapping[str, Column] | None = None,
              value: str | None = None) -> DataFrame:
    """Base rows are never replaced; additions only fill absent keys. A disagreement is a footnote."""
    present = base.select(*keys).distinct()
    extra = null_safe(additions, present.withColumn("__in", F.lit(True)), keys).where(F.col("__in").isNull()).drop("__in")
    out = base.withColumn("origin", F.lit("base"))
    if value:
        other = additions.select(*keys, F.col(value).alias("__other"))
        out = (null_safe(out, other, keys)
               .withColumn("footnote", F.when(F.col("__other") != F.col(value), F.col("__other"))).drop("__other"))
        extra = extra.withColumn("footnote", F.lit(None).cast(dict(out.dtypes)["footnote"]))
    return out.unionByName(extra.withColumn("origin", F.lit("addition")))
