"""Reconciling sources that disagree. Nothing picks a winner, NULL never equals 0,
and every row that leaves a table shows up in a log with its reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import city_token, repair_mojibake, strip_accents
from ..session import written
from .skew import null_safe


class Reconciled(NamedTuple):
    rows: DataFrame
    conflicts: DataFrame
    repeated: DataFrame  # source, keys, n_rows: keys with several rows, whose rows pair up; should be empty


def reconcile_two(first: DataFrame, second: DataFrame, keys: Sequence[str], slots: Sequence[str],
                  no_result: str | None = None, resolutions: DataFrame | None = None,
                  names: tuple[str, str] = ("first", "second"), carry: Sequence[str] = ()) -> Reconciled:
    """Full outer join of two sources with one row per key each; keys that have more are in `repeated`, and NULL keys never meet.

    `carry` columns of the first source stay beside the result.

    status: agree / conflict / <name>_only / no_result. A conflicting slot stays empty,
    the other slots keep their value. `resolutions` (slot, keys, value, confidence) are
    curated and supersede what the comparison finds.
    """
    a_name, b_name = names
    a = first.select(*[F.col(k).alias(f"__a_{k}") for k in keys], *carry, *[F.col(s).alias(f"{s}_{a_name}") for s in slots],
                     F.lit(True).alias("__has_a"))
    b = second.select(*[F.col(k).alias(f"__b_{k}") for k in keys], *[F.col(s).alias(f"{s}_{b_name}") for s in slots],
                      (F.col(no_result) if no_result else F.lit(False)).alias("__none"), F.lit(True).alias("__has_b"))
    cond = reduce(lambda x, y: x & y, [F.col(f"__a_{k}") == F.col(f"__b_{k}") for k in keys])
    out = a.join(b, cond, "full_outer").withColumns({k: F.coalesce(f"__a_{k}", f"__b_{k}") for k in keys})
    for s in slots:
        if resolutions is None:
            out = out.withColumns({f"__r_{s}": F.lit(None).cast("string"), f"__rc_{s}": F.lit(None).cast("string")})
        else:
            r = resolutions.where(F.col("slot") == s).select(
                *keys, F.col("value").alias(f"__r_{s}"), F.col("confidence").alias(f"__rc_{s}"))
            out = out.join(r, list(keys), "left")
    both = F.col("__has_a") & F.col("__has_b")
    clash = {s: F.coalesce(both & (F.col(f"{s}_{a_name}") != F.col(f"{s}_{b_name}")) & F.col(f"__rc_{s}").isNull(),
                           F.lit(False)) for s in slots}
    out = out.withColumns({f"__x_{s}": c for s, c in clash.items()})
    any_clash = reduce(lambda x, y: x | y, [F.col(f"__x_{s}") for s in slots])
    settled = F.array_compact(F.array(*[F.col(f"__rc_{s}") for s in slots]))
    status = (F.when(F.coalesce(F.col("__none"), F.lit(False)), "no_result")
              .when(F.col("__has_b").isNull(), f"{a_name}_only").when(F.col("__has_a").isNull(), f"{b_name}_only")
              .when(any_clash, "conflict").otherwise("agree"))
    confidence = (F.when(F.col("status") == "conflict", "disputed")
                  .when((F.col("status") == "agree") & (F.size(settled) == 0), "verified")
                  .when(F.col("status") == "agree", F.array_min(settled)).otherwise("single-source"))
    out = out.withColumn("status", status).withColumn("confidence", confidence)
    chosen = {s: F.when((F.col("status") != "no_result") & ~F.col(f"__x_{s}"),
                        F.coalesce(F.col(f"__r_{s}"), F.col(f"{s}_{a_name}").cast("string"),
                                   F.col(f"{s}_{b_name}").cast("string"))) for s in slots}
    rows = out.select(*keys, *carry, *[c.alias(s) for s, c in chosen.items()],
                      *[f"{s}_{n}" for s in slots for n in names], "status", "confidence")
    conflicts = (out.where((F.col("status") == "conflict"))
                 .select(*keys, F.explode(F.array(*[F.struct(
                     F.lit(s).alias("slot"), F.col(f"__x_{s}").alias("x"),
                     F.col(f"{s}_{a_name}").cast("string").alias("value_a"),
                     F.col(f"{s}_{b_name}").cast("string").alias("value_b")) for s in slots])).alias("__c"))
                 .where("__c.x").select(*keys, "__c.slot", "__c.value_a", "__c.value_b"))
    repeated = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1").select(F.lit(n).alias("source"), *keys, "n_rows")
                for n, df in zip(names, (first, second), strict=True)]
    return Reconciled(rows, conflicts, repeated[0].unionByName(repeated[1]))


def last_name(c: str | Column) -> Column:
    """Family name of "Family, Given" or "Given Family", folded."""
    s = F.trim(F.lower(strip_accents(c)))
    return F.when(s.contains(","), F.regexp_extract(s, "^([^ ,]*)", 1)).otherwise(F.substring_index(s, " ", -1))


def reconcile_three(sources: Mapping[str, tuple[DataFrame, str]], key: str, dual_keys: DataFrame | None = None) -> DataFrame:
    """`reconcile_named` of one table for each source: (table, column of the name)."""
    parts = [df.select(key, F.lit(n).alias("source"), F.col(col).cast("string").alias("name")) for n, (df, col) in sources.items()]
    return reconcile_named(reduce(DataFrame.unionByName, parts), key, list(sources), dual_keys)


def reconcile_named(rows: DataFrame, key: str, sources: Sequence[str], dual_keys: DataFrame | None = None) -> DataFrame:
    """Agreement of the family names the sources give each key, from rows (key, source, name), in one aggregation.

    A source that names a key more than once counts by its smallest name. A key listed in `dual_keys` records both metrics
    side by side and is no conflict. Rows of unknown key are one key.
    """
    named = F.nullif(F.col("name"), F.lit(""))
    out = rows.groupBy(key).agg(*[F.min(F.when(F.col("source") == n, named)).alias(n) for n in sources])
    present = F.array_compact(F.array(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in sorted(sources)]))
    lasts = F.array_distinct(F.array_compact(F.array(*[last_name(n) for n in sources])))
    out = out.withColumns({"__p": present, "__l": lasts})
    dual = F.lit(False)
    if dual_keys is not None:
        out = out.join(dual_keys.select(key, F.lit(True).alias("__dual")), key, "left")
        dual = F.coalesce("__dual", F.lit(False))
    agreement = (F.when(dual, "dual_metric").when(F.size("__p") == 0, "none")
                 .when(F.size("__p") == 1, F.concat(F.get("__p", F.lit(0)), F.lit("_only")))
                 .when(F.size("__l") == 1, "agree").otherwise("conflict"))
    confidence = (F.when(F.col("agreement").isin("dual_metric", "agree"), "verified")
                  .when(F.col("agreement") == "conflict", "disputed").otherwise("single-source"))
    return (out.withColumn("agreement", agreement).withColumn("confidence", confidence)
            .withColumn("sources", F.array_join("__p", "; ")).drop("__p", "__l", "__dual"))


def lineage(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Every dated edge once per franchise at either end (a self edge once)."""
    a = edges.withColumn("franchise", F.col(source))
    b = edges.withColumn("franchise", F.col(target)).where(~F.col(source).eqNullSafe(F.col(target)))
    return a.unionByName(b).where(F.col("franchise").isNotNull())


class Folded(NamedTuple):
    kept: DataFrame
    merged: DataFrame
    conflicts: DataFrame


def fold_cross_source(df: DataFrame, ident: str, period: str, team: str, stats: Sequence[str], source: str,
                      second: str, franchise: Column) -> Folded:
    """Fold a second-source row into the other source's row it repeats.

    Same entity, period and city, no two different named franchises, and equal stats
    (two unknowns are equal, an unknown and a zero are not). Rows that differ stay as
    two rows and are logged. Each second-source row meets at most three aggregated
    rows (unnamed, same franchise, any), whatever the group size.
    """
    columns = df.columns
    row = written(df.withColumns({"__city": city_token(team), "__fr": F.coalesce(franchise, F.lit(""))}))
    base = row.where(~F.col(source).eqNullSafe(second))  # a row of unknown source is nobody's repeat
    extra = row.where(F.col(source) == second)
    key = [ident, period, "__city"]
    twin = F.min(F.struct(*[F.col(c) for c in columns if c not in (ident, period)])).alias("__twin")

    def compatible(keys, how):
        named = base.groupBy(*keys, "__fr").agg(twin)
        anyone = named.groupBy(*keys).agg(F.min("__twin").alias("__any"))
        unnamed = named.where(F.col("__fr") == "").drop("__fr").withColumnRenamed("__twin", "__bare")
        out = null_safe(extra, anyone, keys)
        out = null_safe(out, unnamed, keys)
        out = null_safe(out, named, [*keys, "__fr"])
        return out.withColumn(how, F.when(F.col("__fr") == "", F.col("__any")).otherwise(
            F.least("__bare", "__twin"))).drop("__any", "__bare", "__twin")

    same = written(compatible([*key, *stats], "__same"))
    merged = same.where(F.col("__same").isNotNull())
    left = same.where(F.col("__same").isNull()).drop("__same")
    extra = left
    clash = compatible(key, "__other").where(F.col("__other").isNotNull())

    def log(rows, twin_col):
        return rows.select(*columns, *[F.col(f"{twin_col}.{c}").alias(f"{c}_kept")
                                       for c in columns if c not in (ident, period)])

    return Folded(base.select(*columns).unionByName(left.select(*columns)), log(merged, "__same"), log(clash, "__other"))


class Split(NamedTuple):
    kept: DataFrame
    dropped: DataFrame


def fold_totals(df: DataFrame, keys: Sequence[str], stats: Sequence[str], source: str, first: str, second: str) -> Split:
    """Drop a second-source row that is the sum of at least two first-source rows.

    All figures must be known, and a row that equals one single row is left to the ordinary fold.
    """
    base = df.where(F.col(source) == first)
    complete = reduce(lambda a, b: a & b, [F.count(s) == F.count("*") for s in stats])
    sums = base.groupBy(*keys).agg(F.count("*").alias("__n"), complete.alias("__full"),
                                   *[F.sum(s).alias(f"{s}_sum") for s in stats])
    single = base.select(*keys, *stats).distinct().withColumn("__one", F.lit(True))
    extra = df.where(F.col(source) == second).join(sums, list(keys), "left").join(single, [*keys, *stats], "left")
    is_sum = ((F.col("__n") >= 2) & F.col("__full") & F.col("__one").isNull()
              & reduce(lambda a, b: a & b, [F.col(s) == F.col(f"{s}_sum") for s in stats]))
    extra = extra.withColumn("__total", F.coalesce(is_sum, F.lit(False)))
    kept = df.where(~F.coalesce(F.col(source) == second, F.lit(False))).unionByName(
        extra.where(~F.col("__total")).select(*df.columns))
    dropped = extra.where("__total").select(*df.columns, F.col("__n").alias("n_parts"))
    return Split(kept, dropped)


class Listed(NamedTuple):
    kept: DataFrame
    dropped: DataFrame
    stale: DataFrame  # list entries that no longer match a row


def drop_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str], only: Column | None = None) -> Listed:
    """Remove the rows a curated list names by their full key; log them with the list's evidence."""
    marks = listed.dropDuplicates(list(keys)).withColumn("__hit", F.lit(True))
    tagged = null_safe(df, marks, keys)
    hit = F.coalesce(F.col("__hit"), F.lit(False)) & (F.lit(True) if only is None else F.coalesce(only, F.lit(False)))
    tagged = tagged.withColumn("__drop", hit)
    have = df.select(*keys).distinct().withColumn("__in", F.lit(True))
    stale = null_safe(listed, have, keys).where(F.col("__in").isNull()).drop("__in")
    return Listed(tagged.where(~F.col("__drop")).select(*df.columns),
                  tagged.where("__drop").drop("__hit", "__drop"), stale)


class Changed(NamedTuple):
    rows: DataFrame
    log: DataFrame


def relabel(df: DataFrame, column: str, new_value: Column) -> Changed:
    """Replace a label by a rule and log every row whose label changed."""
    moved = df.withColumn("__new", new_value)
    log = moved.where(~F.col("__new").eqNullSafe(F.col(column))).withColumnRenamed("__new", f"{column}_new")
    return Changed(moved.withColumn(column, F.col("__new")).drop("__new"), log)


class Overridden(NamedTuple):
    rows: DataFrame
    applied: DataFrame
    stale: DataFrame


def compare_and_set(df: DataFrame, overrides: DataFrame, key: str, column: str, old: str = "old_value",
                    new: str = "new_value") -> Overridden:
    """Apply a correction only while the current value still is the recorded old one."""
    o = overrides.select(key, F.col(old).alias("__old"), F.col(new).alias("__new"), F.lit(True).alias("__has"))
    out = df.join(o, key, "left").withColumn(
        "__ok", F.coalesce(F.col("__has"), F.lit(False)) & F.col(column).eqNullSafe(F.col("__old")))
    rows = out.withColumn(column, F.when(F.col("__ok"), F.col("__new")).otherwise(F.col(column))).select(*df.columns)
    log = out.where("__has").select(key, F.col(column).alias("found"), F.col("__old").alias(old),
                                    F.col("__new").alias(new), "__ok")
    return Overridden(rows, log.where("__ok").drop("__ok"), log.where(~F.col("__ok")).drop("__ok"))


def table_digest(df: DataFrame) -> DataFrame:
    """Row count and an order-free content digest in one pass, with no sort and no collected list."""
    packed = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    return df.select(F.sha2(packed, 256).alias("__d")).agg(
        F.count("*").alias("n_rows"),
        F.bit_xor(F.conv(F.substring("__d", 1, 15), 16, 10).cast("long")).alias("xor_1"),
        F.sum(F.conv(F.substring("__d", 16, 12), 16, 10).cast("decimal(38,0)")).alias("sum_2"))


class Repaired(NamedTuple):
    rows: DataFrame
    log: DataFrame
    untouched: DataFrame


def repair_overlay(df: DataFrame, text_column: str, ident: str, resolve) -> Repaired:
    """Repair damaged text in place; only repaired rows without an id are resolved again.

    `resolve` takes and returns a DataFrame and adds `resolved_id`.
    """
    fixed = df.withColumn("__fixed", repair_mojibake(text_column, only_marked=False))
    hit = F.col("__fixed") != F.col(text_column)
    untouched = fixed.where(~F.coalesce(hit, F.lit(False))).drop("__fixed")
    touched = fixed.where(hit).withColumn("__before", F.col(text_column)).withColumn(text_column, F.col("__fixed")).drop("__fixed")
    ready = touched.where(F.col(ident).isNotNull()).withColumn("__id_before", F.col(ident))
    again = resolve(touched.where(F.col(ident).isNull())).withColumn("__id_before", F.lit(None).cast(dict(df.dtypes)[ident]))
    again = again.withColumn(ident, F.col("resolved_id").cast(dict(df.dtypes)[ident])).drop("resolved_id")
    done = ready.unionByName(again)
    log = done.select(*df.columns, F.col("__before").alias("text_before"), F.col("__id_before").alias("id_before"))
    return Repaired(untouched.unionByName(done.select(*df.columns)), log, untouched)


def cross_check(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys on which two lists both have a value and the values differ, or one has none."""
    x, y = a.select(*keys, F.col(value).alias("value_a")), b.select(*keys, F.col(value).alias("value_b"))
    status = (F.when(F.col("value_b").isNull(), "only_a").when(F.col("value_a").isNull(), "only_b").otherwise("differs"))
    return (x.join(y, list(keys), "full_outer").where(~F.col("value_a").eqNullSafe(F.col("value_b")))
            .withColumn("status", status))


def overlay_facts(curated: DataFrame, built: DataFrame, key: str, replace: Sequence[str], union: Sequence[str]) -> DataFrame:
    """Built facts over curated rows: `replace` columns come from the build where it has the
    entity, `union` arrays merge both sides, every other curated column stays."""
    b = built.select(key, *[F.col(c).alias(f"__b_{c}") for c in [*replace, *union]], F.lit(True).alias("__has"))
    out = curated.join(b, key, "left")
    for c in replace:
        out = out.withColumn(c, F.when(F.col("__has"), F.col(f"__b_{c}")).otherwise(F.col(c)))
    for c in union:
        empty = F.array().cast(dict(curated.dtypes)[c])
        out = out.withColumn(c, F.array_sort(F.array_union(F.coalesce(F.col(c), empty), F.coalesce(F.col(f"__b_{c}"), empty))))
    return out.select(*curated.columns)
