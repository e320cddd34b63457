"""Merging entities in every table that names them, from one list of decisions.

A decision retires an id into a survivor. Decisions may chain; chains are followed to their end by doubling, cycles and
what leads into them are reported and move nothing. All tables are then re-keyed from the one resulting map, each by its own
rule, and what a rule cannot settle is held back in a table of clashes instead of being dropped or guessed. Since no row
kept names a retired id, a second run changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .resolve import apply_merges
from .skew import null_safe


class Chains(NamedTuple):
    survivors: DataFrame  # retired_id, survivor_id: the end of each chain
    cyclic: DataFrame  # retired_id, next_id: decisions that never end
    ambiguous: DataFrame  # retired_id, n: retired into several survivors


def resolve_chains(decisions: DataFrame, retired: str = "retired_id", survivor: str = "survivor_id") -> Chains:
    """Ends of all chains of decisions. A round halves every chain left, so there are as many rounds as the longest chain has
    binary digits; ids left over when a round finishes none are on a cycle or lead into one. An id retired into two
    survivors is reported and not followed; one retired into itself is a cycle."""
    pairs = decisions.select(F.col(retired).alias("retired_id"), F.col(survivor).alias("next_id")).where("retired_id IS NOT NULL AND next_id IS NOT NULL").distinct()
    counted = written(pairs.groupBy("retired_id").agg(F.count(F.lit(1)).alias("n"), F.min("next_id").alias("next_id")))
    ambiguous = counted.where("n > 1").select("retired_id", "n")
    step = counted.where("n = 1").select("retired_id", "next_id")
    left = None
    while True:
        onward = step.select(F.col("retired_id").alias("__at"), F.col("next_id").alias("__then"))
        step = written(step.join(onward, F.col("next_id") == F.col("__at"), "left")
                       .select("retired_id", F.coalesce("__then", "next_id").alias("next_id"), F.col("__at").isNotNull().alias("open")))
        unfinished = step.where("open").count()
        if not unfinished or unfinished == left:
            break
        left, step = unfinished, step.select("retired_id", "next_id")
    stuck = ambiguous.select(F.col("retired_id").alias("next_id"))
    ends = step.where("NOT open").select("retired_id", "next_id").join(stuck, "next_id", "left_anti").select("retired_id", F.col("next_id").alias("survivor_id"))
    cyclic = step.where("open").select("retired_id").join(counted.select("retired_id", "next_id"), "retired_id")
    return Chains(ends, cyclic, ambiguous)


class Rule(NamedTuple):
    """How a table follows its ids. `ident` holds one id, `lists` hold arrays of them, `name` the survivor's name beside the id.

    kind: `canonical` (retired rows go), `move`, `alias` (the retired name's `typed` column becomes `merged_name`, repeats of
    `unique` go), `facts` (a moved row equal on `unique` to one the survivor has goes), `one` (at most one row for each id and
    `unique`; a moved row that would be a second one is held back).
    """

    kind: str
    ident: str | None = None
    unique: Sequence[str] = ()
    name: str | None = None
    lists: Sequence[str] = ()
    typed: str = "alias_type"


class Merge(NamedTuple):
    tables: dict[str, DataFrame]
    clashes: DataFrame  # table, survivor_id, retired_id, reason
    dropped: DataFrame  # table, survivor_id, retired_id, n_rows
    moved: DataFrame  # table, n_rows


def _lists(df: DataFrame, survivors: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Survivors in place of retired ids inside list columns, the first occurrence kept. Only lists that name a retired id are rebuilt."""
    t = survivors.select(F.col("retired_id").alias("__id"), F.col("survivor_id").alias("__to"))
    for c in columns:
        lists = df.select(F.col(c).alias("__l")).where(F.size(c) > 0).distinct()
        hit = lists.select("__l", F.posexplode("__l").alias("__i", "__id")).join(t, "__id")
        places = hit.groupBy("__l").agg(F.map_from_entries(F.collect_list(F.struct("__i", "__to"))).alias("__m"))  # places of one list
        new = F.array_distinct(F.transform(c, lambda x, i: F.coalesce(F.try_element_at("__m", i), x)))
        df = df.join(places, F.col(c) == F.col("__l"), "left").withColumn(c, F.when(F.col("__m").isNotNull(), new).otherwise(F.col(c))).drop("__l", "__m")
    return df


def _named(rows: DataFrame, names: DataFrame | None, rule: Rule) -> DataFrame:
    if names is None or rule.name is None:
        return rows
    kind = dict(rows.dtypes)[rule.name]
    n = names.select(F.col("id").alias("__id"), F.col("name").cast(kind).alias("__name"))
    return (rows.join(n, F.col("survivor_id") == F.col("__id"), "left").withColumn(rule.name, F.coalesce("__name", rule.name)).drop("__id", "__name"))


def merge_tables(tables: Mapping[str, tuple[DataFrame, Rule]], survivors: DataFrame) -> Merge:
    """Every table under the surviving ids.

    The `canonical` table also says which survivors exist and what they are called: decisions for a survivor that is no
    canonical row are clashes and are not followed. Rows that name no retired id are never changed or dropped.
    """
    canonical = next(((df, rule) for df, rule in tables.values() if rule.kind == "canonical"), None)
    clashes, dropped, moved, out = [], [], [], {}
    names = None
    if canonical is not None:
        df, rule = canonical
        names = df.select(F.col(rule.ident).alias("id"), F.col(rule.name).alias("name") if rule.name else F.lit(None).cast("string").alias("name"))
        there = names.select(F.col("id").alias("survivor_id"))
        clashes.append(survivors.join(there, "survivor_id", "left_anti").select(
            F.lit("canonical").alias("table"), "survivor_id", "retired_id", F.lit("survivor is no canonical row").alias("reason")))
        survivors = survivors.join(there, "survivor_id", "left_semi")
    survivors = written(survivors.select("retired_id", "survivor_id"))
    for label, (df, rule) in tables.items():
        followed = _lists(df, survivors, rule.lists)
        if rule.ident is None:
            out[label] = followed
            continue
        t = survivors.select(F.col("retired_id").alias(rule.ident), "survivor_id")
        if rule.kind == "canonical":
            out[label] = followed.join(t.select(rule.ident), rule.ident, "left_anti").select(*df.columns)
            moved.append(followed.join(t, rule.ident).select(F.lit(label).alias("table")))
            continue
        if rule.kind in ("alias", "facts"):
            rows = followed
            if rule.kind == "alias":
                rows = (followed.join(t, rule.ident, "left")
                        .withColumn(rule.typed, F.when(F.col("survivor_id").isNotNull() & (F.col(rule.typed) == "canonical"), "merged_name").otherwise(F.col(rule.typed))).drop("survivor_id"))
            done = apply_merges(rows, survivors, rule.ident, list(rule.unique), [F.col(c) for c in rule.unique])
            out[label] = done.rows.select(*df.columns)
            dropped.append(done.dropped.select(F.lit(label).alias("table"), F.col(rule.ident).alias("survivor_id"), "retired_id"))
            moved.append(followed.join(t, rule.ident).select(F.lit(label).alias("table")))
            continue
        marked = followed.join(t, rule.ident, "left").withColumn("retired_id", F.when(F.col("survivor_id").isNotNull(), F.col(rule.ident)))
        marked = _named(marked, names, rule).withColumn(rule.ident, F.coalesce("survivor_id", rule.ident))
        if rule.kind == "one":
            key = [rule.ident, *rule.unique]
            several = marked.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), F.count("retired_id").alias("__moved")).where("__n > 1 AND __moved > 0")
            marked = null_safe(marked, several.select(*key, F.lit(True).alias("__clash")), key)
            held = marked.where("__clash AND retired_id IS NOT NULL")
            clashes.append(held.select(F.lit(label).alias("table"), F.col(rule.ident).alias("survivor_id"), "retired_id", F.lit("survivor would have several rows").alias("reason")))
            marked = marked.where("__clash IS NULL OR retired_id IS NULL")
        moved.append(marked.where("retired_id IS NOT NULL").select(F.lit(label).alias("table")))
        out[label] = marked.select(*df.columns)
    none = survivors.limit(0)

    def every(parts: Sequence[DataFrame], *columns: Column) -> DataFrame:
        return reduce(DataFrame.unionByName, parts) if parts else none.select(*columns)

    word, ident = F.lit("").alias("table"), [F.col("survivor_id"), F.col("retired_id")]
    return Merge(out, every(clashes, word, *ident, F.lit("").alias("reason")),
                 every(dropped, word, *ident).groupBy("table", "survivor_id", "retired_id").agg(F.count(F.lit(1)).alias("n_rows")),
                 every(moved, word).groupBy("table").agg(F.count(F.lit(1)).alias("n_rows")))
