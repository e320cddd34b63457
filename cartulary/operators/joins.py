"""Lookups, dated ranges, candidate matching and gap joins.

Matching operators answer "how many candidates, and which one if exactly one".
They reach that by joining on pre-aggregated keys, so no group is ever expanded
into pairs. Joins carry no broadcast hint unless the build side is bounded;
Catalyst broadcasts by measured size and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import attach_totals, null_safe, running, shuffled, top_k


class Crosswalk(NamedTuple):
    joined: DataFrame
    unmapped: DataFrame  # keys in the data without a map entry
    unused: DataFrame    # map entries no row uses


def crosswalk(df: DataFrame, mapping: DataFrame, key: str) -> Crosswalk:
    """Left lookup, with completeness reported in both directions."""
    keys = df.select(key).distinct()
    return Crosswalk(df.join(mapping, key, "left"), keys.join(mapping, key, "left_anti"),
                     mapping.join(keys, key, "left_anti"))


def invalid_ranges(ranges: DataFrame, key: str, start: str, end: str, value: str, evidence: str) -> DataFrame:
    """Range rows that must not be used: blank parts, reversed, no evidence, or overlapping the next one."""
    s, e = F.col(start).try_cast("int"), F.col(end).try_cast("int")
    w = Window.partitionBy(key).orderBy(s)
    blank = F.coalesce(F.trim(key), F.lit("")) == ""
    reason = (F.when(blank | (F.coalesce(F.trim(value), F.lit("")) == ""), "blank key or value")
              .when(F.coalesce(F.trim(evidence), F.lit("")) == "", "no evidence")
              .when(s.isNull() | (F.col(end).isNotNull() & e.isNull()), "not a year")
              .when(e < s, "reversed")
              .when(F.lead(s).over(w) <= F.coalesce(e, F.lit(9999)), "overlaps next"))
    return ranges.withColumn("reason", reason).where(F.col("reason").isNotNull())


def dated_override(df: DataFrame, ranges: DataFrame, key: str, period: str, start: str, end: str, value: str,
                   name: str) -> DataFrame:
    """Value of the range the period falls in; a range without an end is open. Ranges of a key do not overlap.

    The asked (key, period) pairs and the range starts form one line per key; the last start at or before a
    period is its range, and the end is tested afterwards.
    """
    starts = ranges.where(F.col(start).isNotNull()).select(F.col(key), F.col(start).alias(period), F.lit(0).alias("__ask"),
                           F.struct(F.col(end).alias("e"), F.col(value).alias("v")).alias("__range"))
    asks = df.where(F.col(key).isNotNull() & F.col(period).isNotNull()).select(key, period).distinct().select(
        key, period, F.lit(1).alias("__ask"), F.lit(None).cast(starts.schema["__range"].dataType).alias("__range"))
    w = Window.partitionBy(key).orderBy(period, "__ask").rowsBetween(Window.unboundedPreceding, 0)
    per = (starts.unionByName(asks).withColumn("__last", F.last("__range", ignorenulls=True).over(w)).where("__ask = 1")
           .select(key, period, F.when(F.col("__last.e").isNull() | (F.col("__last.e") >= F.col(period)), F.col("__last.v")).alias(name)))
    return df.join(per, [key, period], "left")


def unique_keys(df: DataFrame, key: str, ident: str) -> DataFrame:
    """Keys that name exactly one entity; ambiguous keys are left out, never guessed."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.min(ident).alias(ident), F.max(ident).alias("__max"))
            .where(F.col(ident) == F.col("__max")).drop("__max"))


def resolver_chain(df: DataFrame, steps: Sequence[tuple[str, Column, DataFrame, str, str]],
                   name: str = "resolved_id") -> DataFrame:
    """First lookup that answers wins. A step is (method, key on df, lookup, lookup key, lookup id)."""
    out, found = df, []
    for i, (method, key, lookup, lkey, lid) in enumerate(steps):
        unique = unique_keys(lookup, lkey, lid).select(F.col(lkey).alias(f"__k{i}"), F.col(lid).alias(f"__id{i}"))
        out = out.withColumn(f"__q{i}", key).join(unique, F.col(f"__q{i}") == F.col(f"__k{i}"), "left")
        found.append((method, f"__id{i}"))
    method = F.lit("unresolved")
    for m, c in reversed(found):
        method = F.when(F.col(c).isNotNull(), m).otherwise(method)
    out = out.withColumn(name, F.coalesce(*[F.col(c) for _, c in found])).withColumn("method", method)
    return out.drop(*[f"__{p}{i}" for i in range(len(steps)) for p in ("q", "k", "id")])


# --- keys of the "family words are a prefix, first given word equal" test ----

def _joined(words: Column, n) -> Column:
    return F.array_join(F.slice(words, F.lit(1), n), " ")


def family_probe(df: DataFrame, keep: Sequence[str], family: str = "family", given: str = "given") -> DataFrame:
    """Observed side: every prefix of its family words, and the whole."""
    w = F.col(family)
    whole = F.array_join(w, " ")
    keys = F.concat(F.transform(F.sequence(F.lit(1), F.size(w)), lambda n: F.concat(F.lit("p|"), _joined(w, n))),
                    F.array(F.concat(F.lit("w|"), whole)))
    return df.where((F.size(w) > 0) & (F.col(given) != "")).select(*keep, F.explode(keys).alias("__f"), F.col(given).alias("__g"))


def family_build(df: DataFrame, keep: Sequence[str], family: str = "family", given: str = "given") -> DataFrame:
    """Canonical side: the whole, and every shorter prefix."""
    w = F.col(family)
    shorter = F.slice(F.transform(F.sequence(F.lit(1), F.size(w)), lambda n: F.concat(F.lit("w|"), _joined(w, n))),
                      F.lit(1), F.greatest(F.size(w) - 1, F.lit(0)))
    keys = F.concat(F.array(F.concat(F.lit("p|"), F.array_join(w, " "))), shorter)
    return df.where((F.size(w) > 0) & (F.col(given) != "")).select(*keep, F.explode(keys).alias("__f"), F.col(given).alias("__g"))


def family_shape_candidates(obs: DataFrame, canon: DataFrame, obs_id: str, ident: str,
                            family: str = "family", given: str = "given") -> DataFrame:
    """Candidates whose family words are a prefix of the other's, with the same first given word.

    `family` is an array of words, `given` one word. Either side's prefixes become an
    equi key; the canonical side is reduced to one row per key first.
    """
    stats = family_build(canon, [ident], family, given).groupBy("__f", "__g").agg(
        F.count("*").alias("__n"), F.min(ident).alias("__lo"), F.max(ident).alias("__hi"))
    per = (family_probe(obs, [obs_id], family, given).join(shuffled(stats), ["__f", "__g"]).groupBy(obs_id)
           .agg(F.sum("__n").alias("n_candidates"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi")))
    return (obs.join(shuffled(per), obs_id, "left")
            .withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0).cast("long")))
            .withColumn("candidate_id", F.when(F.col("__lo") == F.col("__hi"), F.col("__lo"))).drop("__lo", "__hi"))


def name_splits(tokens: Column) -> Column:
    """Every way to cut "given family" words in two, as array<struct<given, family>>."""
    n = F.size(tokens)
    cuts = F.when(n >= 2, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(cuts, lambda i: F.struct(
        F.get(tokens, 0).alias("given"),
        F.slice(tokens, i + 1, F.greatest(n - i, F.lit(0))).alias("family")))


def span_corroboration(obs: DataFrame, candidates: DataFrame, key: str, period: str, ident: str, lo: str, hi: str,
                       slack: int = 1) -> DataFrame:
    """Candidates of the name key whose span, widened by `slack`, covers the period.

    Spans become +1/-1 steps per key and period; running sums of counts and ids give
    the number of survivors and, when it is one, the survivor, without any pairs.
    """
    one, num = F.lit(1).cast("long"), F.col(ident).cast("decimal(38,0)")
    steps = (candidates.select(key, F.explode(F.array(
        F.struct((F.col(lo) - slack).alias("__p"), one.alias("__n"), num.alias("__i")),
        F.struct((F.col(hi) + slack + 1).alias("__p"), (-one).alias("__n"), (-num).alias("__i")))).alias("__s"))
        .select(key, "__s.*").groupBy(key, "__p").agg(F.sum("__n").alias("__n"), F.sum("__i").alias("__i")))
    asked = obs.select(key, F.col(period).alias("__p")).distinct().withColumn("__ask", F.lit(True))
    both = steps.withColumn("__ask", F.lit(False)).unionByName(
        asked.withColumns({"__n": F.lit(0).cast("long"), "__i": F.lit(0).cast("decimal(38,0)")}),
        allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy("__p").rangeBetween(Window.unboundedPreceding, 0)
    totals = (both.withColumn("n_in_span", F.sum("__n").over(w)).withColumn("__sum", F.sum("__i").over(w))
              .where("__ask")
              .select(key, F.col("__p").alias(period), "n_in_span",
                      F.when(F.col("n_in_span") == 1, F.col("__sum").cast("long")).alias("survivor_id")))
    return obs.join(totals, [key, period], "left").withColumn("n_in_span", F.coalesce("n_in_span", F.lit(0).cast("long")))


def near_club_check(obs: DataFrame, career: DataFrame, ident: str, period: str, club: str, slack: int = 1) -> DataFrame:
    """confirms / contradicts / no_career_club / no_obs_club for the observed club near that period."""
    near = career.where(F.col(club).isNotNull()).select(ident, club, F.explode(
        F.sequence(F.col(period) - slack, F.col(period) + slack)).alias(period)).distinct()
    any_club = near.select(ident, period).distinct().withColumn("__any", F.lit(True))
    return (obs.join(near.withColumn("__same", F.lit(True)), [ident, period, club], "left")
            .join(any_club, [ident, period], "left")
            .withColumn("club_check", F.when(F.col(club).isNull(), "no_obs_club").when(F.col("__same"), "confirms")
                        .when(F.col("__any"), "contradicts").otherwise("no_career_club"))
            .drop("__same", "__any"))


def date_tolerance(left: DataFrame, right: DataFrame, keys: Sequence[str], day: str, ident: str,
                   days: int = 7) -> DataFrame:
    """Rows of `right` with the same key within `days` of each row of `left`.

    Both sides shrink to one row per key and day first; the frame then holds at most
    2 * days + 1 rows. Adds n_near, near_min and near_max.
    """
    num = F.datediff(F.col(day), F.lit("1970-01-01"))
    facts = right.where(F.col(day).isNotNull()).groupBy(*keys, num.alias("__d")).agg(
        F.count("*").alias("__n"), F.min(ident).alias("__lo"), F.max(ident).alias("__hi"), F.lit(False).alias("__ask"))
    none = F.lit(None).cast(dict(right.dtypes)[ident])
    asked = (left.where(F.col(day).isNotNull()).select(*keys, num.alias("__d")).distinct()
             .select("*", F.lit(0).cast("long").alias("__n"), none.alias("__lo"), none.alias("__hi"),
                     F.lit(True).alias("__ask")))
    w = Window.partitionBy(*keys).orderBy("__d").rangeBetween(-days, days)
    found = (facts.unionByName(asked)
             .select("*", F.sum("__n").over(w).alias("n_near"), F.min("__lo").over(w).alias("near_min"),
                     F.max("__hi").over(w).alias("near_max"))
             .where("__ask").select(*keys, "__d", "n_near", "near_min", "near_max"))
    return (left.withColumn("__d", num).join(found, [*keys, "__d"], "left").drop("__d")
            .withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long"))))


def attach_or_synthesise(rows: DataFrame, facts: DataFrame, keys: Sequence[str], row_id: str,
                         prefer: Sequence[Column], fact_columns: Sequence[str]) -> DataFrame:
    """Facts (one per key) go to the best row of their key; a fact without a row becomes a row."""
    matched = null_safe(rows, facts, list(keys), "inner")
    best = top_k(matched, keys, [*[p.desc_nulls_last() for p in prefer], F.col(row_id)]).select(row_id, *fact_columns)
    attached = rows.join(best, row_id, "left").withColumn("origin", F.lit("row"))
    held = rows.select(*keys).distinct().withColumn("__held", F.lit(True))
    new = null_safe(facts, held, list(keys)).where(F.col("__held").isNull()).withColumn("origin", F.lit("fact_only"))
    return attached.unionByName(new.select(*keys, *fact_columns, "origin"), allowMissingColumns=True)


def unique_slugs(df: DataFrame, slug: str, ident: str, richness: Column) -> DataFrame:
    """The richest entity keeps the plain slug; the others get slug-id. Twins are counted."""
    rank = F.struct((-F.coalesce(richness, F.lit(0))).alias("r"), F.col(ident).alias("i"))
    out = attach_totals(df, [slug], {"__first": F.min_by(ident, rank), "__n": F.count(F.lit(1))})
    return (out.withColumn("unique_slug", F.when(F.col(ident) == F.col("__first"), F.col(slug))
                           .otherwise(F.concat_ws("-", slug, ident)))
            .withColumn("n_twins", F.col("__n") - 1).drop("__first", "__n"))


class Redirects(NamedTuple):
    redirects: DataFrame
    clashes: DataFrame  # old slugs that a live entity uses: an error to report


def redirects(tombstones: DataFrame, slugs: DataFrame, retired: str, survivor: str, ident: str, slug: str) -> Redirects:
    """Old slug of a retired id -> slug of its survivor."""
    old = slugs.select(F.col(ident).alias(retired), F.col(slug).alias("old_slug"))
    new = slugs.select(F.col(ident).alias(survivor), F.col(slug).alias("new_slug"))
    out = (tombstones.select(retired, survivor).join(old, retired).join(new, survivor)
           .where(F.col("old_slug") != F.col("new_slug")))
    live = slugs.join(tombstones.select(F.col(retired).alias(ident)), ident, "left_anti").select(
        F.col(slug).alias("old_slug")).distinct()
    return Redirects(out.join(live, "old_slug", "left_anti"), out.join(live, "old_slug", "left_semi"))


def match_counts(asserted: DataFrame, published: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many published rows equal each asserted row, NULL equal to NULL; the rule is exactly one."""
    per = published.groupBy(*keys).agg(F.count("*").alias("n_matches"))
    return (null_safe(asserted, per, keys).withColumn("n_matches", F.coalesce("n_matches", F.lit(0).cast("long")))
            .withColumn("ok", F.col("n_matches") == 1))


def criteria_grid(df: DataFrame, row_criteria: Mapping[str, Column], col_criteria: Mapping[str, Column],
                  ident: str) -> DataFrame:
    """Entities that satisfy a row AND a column criterion, per cell. The lists bound the fan-out."""

    def named(criteria):
        hits = F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in criteria.items()])
        return F.filter(hits, lambda x: x.isNotNull())

    return (df.select(ident, F.explode(named(row_criteria)).alias("row_criterion"), named(col_criteria).alias("__c"))
            .select(ident, "row_criterion", F.explode("__c").alias("col_criterion"))
            .groupBy("row_criterion", "col_criterion").agg(F.count("*").alias("n_entities")))


def comparable_counts(df: DataFrame, group: str, value: str, ident: str, least: int = 100, width: int = 10000, agrees: Column | None = None) -> DataFrame:
    """For each row: others of its group at least max(`least`, 2 % of the larger) away.

    A row for which `agrees` does not hold (say, its rate is not its total over its games, see `rate_agrees`) is compared
    with nothing, like one of unknown value.

    Integer values (cents). Counting is by running totals over the distinct values of a
    group, cut into value ranges of `width`; no pair is formed. An unknown value is compared with
    nothing: its row keeps NULL counts and counts for no other.
    """
    v = F.col(value) if agrees is None else F.when(agrees, F.col(value))
    up = F.greatest(v + least, F.when(v > 0, F.ceil(v * 50 / F.lit(49))).otherwise(v + least)).cast("long")
    down = (v - F.greatest(F.lit(least), F.ceil(v * 2 / F.lit(100)))).cast("long")
    known = df.where(v.isNotNull())
    points = known.groupBy(group, v.cast("long").alias("__v")).agg(F.count("*").alias("__n"))
    asks = (known.select(group, F.explode(F.array(up - 1, down)).alias("__v")).distinct()
            .withColumn("__n", F.lit(0).cast("long")))
    both = points.unionByName(asks).groupBy(group, "__v").agg(F.sum("__n").alias("__n"))
    cum = running(both, [group], F.floor(F.col("__v") / width), [F.col("__v")], {"__upto": F.col("__n")}).select(
        group, "__v", "__upto")
    size = known.groupBy(group).agg(F.count("*").alias("__all"))
    below = cum.select(group, F.col("__v").alias("__down"), F.col("__upto").alias("n_below"))
    above = cum.select(group, F.col("__v").alias("__up"), F.col("__upto").alias("__not_above"))
    asked = df.withColumns({"__down": down, "__up": (up - 1).cast("long")})
    for counts, keys in ((below, [group, "__down"]), (above, [group, "__up"]), (size, [group])):
        asked = null_safe(asked, counts, keys)
    return (asked.withColumn("n_below", F.when(v.isNotNull(), F.col("n_below")))
            .withColumn("__all", F.when(v.isNotNull(), F.col("__all"))).withColumn("n_above", F.col("__all") - F.col("__not_above"))
            .drop("__down", "__up", "__all", "__not_above"))


def rate_agrees(total: str, games: str, rate: str, most: float = 0.15) -> Column:
    """Whether a listed rate is the total over the games, within `most`; an unknown figure agrees with nothing."""
    return F.coalesce((F.col(games) != 0) & (F.abs(F.try_divide(F.col(total), F.col(games)) - F.col(rate)) <= most), F.lit(False))


def flag_semi(df: DataFrame, others: DataFrame, key: str, name: str) -> DataFrame:
    """Does the key occur among the others (leaders, disputed rows)?"""
    marks = others.select(key).distinct().withColumn("__hit", F.lit(True))
    return df.join(marks, key, "left").withColumn(name, F.coalesce("__hit", F.lit(False))).drop("__hit")


def missing_periods(df: DataFrame, day: str, scope: DataFrame | None = None) -> DataFrame:
    """Days of the observed range (or of `scope`) on which nothing was recorded."""
    days = df.select(F.col(day).cast("date").alias("day")).distinct()
    spine = scope if scope is not None else days.agg(
        F.min("day").alias("a"), F.max("day").alias("b")).select(F.explode(F.sequence("a", "b")).alias("day"))
    return spine.join(days, "day", "left_anti")
