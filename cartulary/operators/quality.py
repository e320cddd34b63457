"""Declarative checks over tables, one result table for the whole suite."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .sets import snapshot_diff

RESULT = ["check_name", "n_checked", "n_failed", "passed"]


def _result(df: DataFrame, name: str, checked: Column, failed: Column, allowed: Column | None = None) -> DataFrame:
    ok = F.col("n_failed") <= (F.lit(0) if allowed is None else allowed)
    return (df.agg(checked.cast("long").alias("n_checked"), F.coalesce(failed, F.lit(0)).cast("long").alias("n_failed"))
            .select(F.lit(name).alias("check_name"), "n_checked", "n_failed", ok.alias("passed")))


def check_unique(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, NULL keys included."""
    per = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    return _result(per, name, F.count("*"), F.count_if(F.col("__n") > 1))


def check_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Row rules (required, enumeration, pattern, range), all in one pass. Unknown counts as failed."""
    one = df.agg(F.count("*").alias("__n"), *[F.count_if(~F.coalesce(c, F.lit(False))).alias(f"__{i}")
                                              for i, c in enumerate(rules.values())])
    packed = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col("__n").alias("n_checked"), F.col(f"__{i}").alias("n_failed"))
                       for i, n in enumerate(rules)])
    return one.select(F.explode(packed).alias("r")).select("r.*").withColumn("passed", F.col("n_failed") == 0)


def required(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "") for c in columns])


def check_reference(df: DataFrame, name: str, key: str, target: DataFrame, target_key: str, forbidden: bool = False) -> DataFrame:
    """Every known key points at a target row (or, with `forbidden`, at none). Keys are reduced before the join."""
    keys = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__k")).agg(F.count("*").alias("__n"))
    hit = target.select(F.col(target_key).alias("__k")).distinct().withColumn("__hit", F.lit(True))
    bad = F.col("__hit").isNotNull() if forbidden else F.col("__hit").isNull()
    return _result(keys.join(hit, "__k", "left"), name, F.sum("__n"), F.sum(F.when(bad, F.col("__n"))))


def check_references(df: DataFrame, targets: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """`check_reference` of several keys of one table, read once: check name -> (key, target, key of the target).

    The keys of all checks are counted in one grouping before they meet their targets.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(k).cast("string").alias("__k")) for n, (k, _, _) in targets.items()])
    keys = df.select(F.explode(pairs).alias("p")).select("p.*").where("__k IS NOT NULL").groupBy("check_name", "__k").agg(F.count(F.lit(1)).alias("__n"))
    hits = reduce(DataFrame.unionAll, [t.select(F.lit(n).alias("check_name"), F.col(k).cast("string").alias("__k"), F.lit(True).alias("__hit")).distinct()
                                       for n, (_, t, k) in targets.items()])
    found = keys.join(hits, ["check_name", "__k"], "left").groupBy("check_name").agg(
        F.sum("__n").alias("n_checked"), F.coalesce(F.sum(F.when(F.col("__hit").isNull(), F.col("__n"))), F.lit(0)).alias("n_failed"))
    names = df.sparkSession.createDataFrame([(n,) for n in targets], "check_name string")
    zero = F.lit(0).cast("long")
    return (names.join(found, "check_name", "left").select("check_name", F.coalesce("n_checked", zero).alias("n_checked"), F.coalesce("n_failed", zero).alias("n_failed"))
            .withColumn("passed", F.col("n_failed") == 0))


def check_rates(df: DataFrame, rates: Mapping[str, tuple[Column, float, float]]) -> DataFrame:
    """Share of rows with a property against [lo, hi]; n_failed counts the rows outside the property."""
    one = df.agg(F.count("*").alias("__n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"__{i}")
                                              for i, (c, _, _) in enumerate(rates.values())])
    packed = F.array(*[F.struct(
        F.lit(n).alias("check_name"), F.col("__n").alias("n_checked"), (F.col("__n") - F.col(f"__{i}")).alias("n_failed"),
        (F.col(f"__{i}") / F.col("__n")).between(lo, hi).alias("passed")) for i, (n, (_, lo, hi)) in enumerate(rates.items())])
    return one.select(F.explode(packed).alias("r")).select("r.*")


def check_exclusive(a: DataFrame, b: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """No key may be on both sides."""
    both = (a.select(*keys).distinct().withColumn("__a", F.lit(1)).unionByName(b.select(*keys).distinct().withColumn("__a", F.lit(2)))
            .groupBy(*keys).agg(F.count("*").alias("__n")))
    return _result(both, name, F.count("*"), F.count_if(F.col("__n") > 1))


def check_totals(totals: DataFrame, parts: DataFrame, name: str, keys: Sequence[str], total: str, part: Column) -> DataFrame:
    """Each stated total equals the sum of its parts; a missing side fails."""
    summed = parts.groupBy(*keys).agg(part.alias("__s"))
    both = totals.select(*keys, F.col(total).alias("__t")).join(summed, list(keys), "full_outer")
    return _result(both, name, F.count("*"), F.count_if(~F.coalesce(F.col("__t") == F.col("__s"), F.lit(False))))


def check_same_rows(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Two tables hold the same rows, counted with repeats. One shuffle by row digest, no sort."""

    def digested(df, sign):
        packed = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
        return df.select(F.sha2(packed, 256).alias("__d"), F.lit(sign).alias("__s"))

    per = digested(a, 1).unionByName(digested(b, -1)).groupBy("__d").agg(F.sum("__s").alias("__n"))
    return _result(per, name, F.count("*"), F.sum(F.abs("__n")))


# fixed values: what damaged text looks like
DAMAGED = "[�]|Ã[\u0080-¿]|Â[\u0080-¿]"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


def scan_text(df: DataFrame, columns: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """Rows per column and kind of bad text, in one pass."""
    pairs = [(c, k) for c in columns for k in kinds]
    one = df.agg(F.count("*").alias("__n"), *[F.count_if(F.col(c).rlike(kinds[k])).alias(f"__{i}") for i, (c, k) in enumerate(pairs)])
    packed = F.array(*[F.struct(F.lit(f"{c}: {k}").alias("check_name"), F.col("__n").alias("n_checked"), F.col(f"__{i}").alias("n_failed"))
                       for i, (c, k) in enumerate(pairs)])
    return one.select(F.explode(packed).alias("r")).select("r.*").withColumn("passed", F.col("n_failed") == 0)


def suite(*checks: DataFrame) -> DataFrame:
    """All results as one table, one row per check."""
    return reduce(DataFrame.unionByName, [c.select(*RESULT) for c in checks])


class Refresh(NamedTuple):
    passed: bool
    path: str           # the candidate, written and checked; nobody reads it until the caller switches to it
    n_rows: int
    results: DataFrame  # one row per check
    changes: DataFrame  # added / removed / changed keys against the rows in use


def gated_refresh(build: DataFrame, folder: str, keys: Sequence[str], rules: Mapping[str, Column], checks: Callable[[DataFrame], DataFrame] | None = None,
                  current: DataFrame | None = None, least: int = 1) -> Refresh:
    """Write a candidate, audit it, and say whether it may replace the rows in use.

    `rules` are counted while the candidate is written, in the same pass; what needs more than one row (`checks`, unique keys)
    reads what was written. The candidate is a new folder under `folder`: the caller switches to `path` if it passed, and
    a failed one is left for inspection. Only counts reach the driver. `least` rows are needed, so an empty build never passes.
    """
    seen = Observation()
    bad = {f"r{i}": F.count_if(~F.coalesce(c, F.lit(False))) for i, c in enumerate(rules.values())}
    path = f"{folder.rstrip('/')}/candidate-{uuid.uuid4().hex}"
    build.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in bad.items()]).write.parquet(path)
    counts = seen.get
    n = counts["n"]
    spark = build.sparkSession
    observed = [("rows", n, max(least - n, 0), n >= least), *[(name, n, counts[f"r{i}"], counts[f"r{i}"] == 0) for i, name in enumerate(rules)]]
    fresh = spark.read.schema(build.schema).parquet(path)
    parts = [spark.createDataFrame(observed, "check_name string, n_checked long, n_failed long, passed boolean"), check_unique(fresh, "unique " + ", ".join(keys), keys)]
    results = suite(*parts, *([checks(fresh)] if checks else []))
    failed = results.where(~F.coalesce("passed", F.lit(False))).count()
    return Refresh(failed == 0, path, n, results, snapshot_diff(current if current is not None else fresh.limit(0), fresh, keys))
