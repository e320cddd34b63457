"""The archive's fixed questions as operators over a season ledger and fact tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import search_fold
from .aggregates import title_summary
from .skew import attach_totals, top_k


def champion_of(finals: DataFrame, period: str, wanted: int, winner: str, runner_up: str) -> DataFrame:
    """Winner, runner-up and the winner's how-manieth title. The ledger holds one row per period."""
    w = Window.partitionBy(winner).orderBy(period)
    return (finals.withColumn("nth_title", F.row_number().over(w)).where(F.col(period) == wanted)
            .select(period, winner, runner_up, "nth_title"))


def period_champions(finals: DataFrame, bucket: Column, winner: str) -> DataFrame:
    """Club with most titles per bucket, its titles, and how many clubs won."""
    per = finals.groupBy(bucket.alias("bucket"), winner).agg(F.count("*").alias("titles"))
    best = top_k(per, ["bucket"], [F.col("titles").desc(), F.col(winner)])
    size = per.groupBy("bucket").agg(F.count("*").alias("n_winners"), F.sum("titles").alias("n_periods"))
    return best.join(size, "bucket")


def since_last(df: DataFrame, keys: Sequence[str], when: Column, day: str) -> DataFrame:
    """Count and days since the last hit, per key, against the newest day of the data."""
    newest = df.agg(F.max(F.col(day).cast("date"))).scalar()
    return (df.groupBy(*keys)
            .agg(F.count_if(when).alias("n_hits"), F.max(F.when(when, F.col(day).cast("date"))).alias("last_day"))
            .withColumn("days_since", F.datediff(newest, F.col("last_day"))))


def titles_and_drought(finals: DataFrame, period: str, winner: str, runner_up: str, club) -> DataFrame:
    return title_summary(finals, period, winner, runner_up).where(F.col("club") == club)


def head_to_head(df: DataFrame, a: str, b: str, won_by_a: Column) -> DataFrame:
    """Wins each way for every unordered pair that met."""
    swap = F.col(a) > F.col(b)
    first_won = F.when(swap, ~won_by_a).otherwise(won_by_a)
    return (df.where(F.col(a) != F.col(b))
            .groupBy(F.least(a, b).alias("club_1"), F.greatest(a, b).alias("club_2"))
            .agg(F.count_if(first_won).alias("wins_1"), F.count_if(~first_won).alias("wins_2"), F.count("*").alias("n_met")))


def meeting_matrix(df: DataFrame, rows: str, cols: str, values: Sequence) -> DataFrame:
    """Counts of row x column; the column values are given, so no extra pass finds them."""
    return df.groupBy(rows).pivot(cols, list(values)).agg(F.count(F.lit(1))).fillna(0)


def top_rival(df: DataFrame, a: str, b: str) -> DataFrame:
    sides = df.select(F.explode(F.array(F.struct(F.col(a).alias("club"), F.col(b).alias("rival")),
                                        F.struct(F.col(b).alias("club"), F.col(a).alias("rival")))).alias("s")).select("s.*")
    per = sides.where(F.col("club") != F.col("rival")).groupBy("club", "rival").agg(F.count("*").alias("n_met"))
    return top_k(per, ["club"], [F.col("n_met").desc(), F.col("rival")])


def award_tally(awards: DataFrame, holder: str, period: str) -> DataFrame:
    return awards.groupBy(holder).agg(F.count("*").alias("n_awards"), F.min(period).alias("first_award"),
                                      F.max(period).alias("last_award"))


def leaders(df: DataFrame, measure: Column, tie: Sequence[Column], n: int, era: Column | None = None) -> DataFrame:
    """Top n by one measure; `era` keeps totals and averages apart."""
    rows = df if era is None else df.where(era)
    return rows.withColumn("measure", measure).where(F.col("measure").isNotNull()).orderBy(F.col("measure").desc(), *tie).limit(n)


def records_by_topic(records: DataFrame, text: str, words: Sequence[str]) -> DataFrame:
    """Records whose folded text holds any of the topic words."""
    pattern = "|".join(rf"\Q{w.lower()}\E" for w in words)
    return records.where(search_fold(text).rlike(pattern))


def mentions(texts: DataFrame, ident: str, text: str, names: DataFrame, name: str, name_id: str, most_words: int) -> DataFrame:
    """Longest known name in each text, on word borders, over the whole text.

    The text opens into its word groups of up to `most_words` words; their hashes meet those of the
    names in an equi join, so the cost does not grow with texts x names. Only a group whose hash is
    known is written out and compared, and only these are told apart within a text.
    """
    def words(c: str) -> Column:
        return F.array_remove(F.split(search_fold(c), r"[^\p{L}\p{N}]+"), "")

    def by_size(of: Callable[[int], Column]) -> Column:
        return reduce(lambda other, n: F.when(F.col("__k") == n, of(n)).otherwise(other), range(most_words - 1, 0, -1), of(most_words))

    def group(n: int) -> list[Column]:
        return [F.get("__w", F.col("__at") + i) for i in range(n)]

    starts = F.when(F.size("__w") > 0, F.sequence(F.lit(0), F.size("__w") - 1))
    sizes = F.sequence(F.lit(1), F.least(F.lit(most_words), F.size("__w") - F.col("__at")))
    hashed, written = by_size(lambda n: F.xxhash64(*group(n))), by_size(lambda n: F.concat_ws(" ", *group(n)))
    grams = (texts.select(ident, words(text).alias("__w")).select(ident, "__w", F.explode(starts).alias("__at"))
             .select(ident, "__w", "__at", F.explode(sizes).alias("__k")).select(ident, hashed.alias("__h"), written.alias("__t")))
    known = (names.select(words(name).alias("__w"), F.col(name_id).alias("entity_id"), F.lit(0).alias("__at")).withColumn("__k", F.size("__w"))
             .where(F.col("__k").between(1, most_words)).groupBy(hashed.alias("__known"), written.alias("__g")).agg(F.min("entity_id").alias("entity_id")))
    same = F.startswith("__t", "__g") & F.startswith("__g", "__t")  # not as an equality: the join's key stays one number
    hits = grams.join(known, (F.col("__h") == F.col("__known")) & same).groupBy(ident, "__g").agg(F.min("entity_id").alias("entity_id"))
    best = hits.groupBy(ident).agg(F.count("*").alias("n_names"), F.max(F.struct(
        F.length("__g").alias("n"), F.col("__g").alias("g"), F.col("entity_id").alias("e"))).alias("b"))
    return best.select(ident, "n_names", F.col("b.g").alias("longest_name"), F.col("b.e").alias("entity_id"))


def fragment_match(names: DataFrame, name: str, ident: str, fragments: Sequence[str]) -> DataFrame:
    """Each typed fragment: exact, prefix and substring hits, and the entity when it is only one.

    The fragments are the caller's short list, so they are tested in one pass over the names.
    """
    folded = search_fold(name)
    tests = F.array(*[F.struct(
        F.lit(f.lower()).alias("fragment"), (folded == search_fold(F.lit(f))).alias("exact"),
        folded.startswith(search_fold(F.lit(f))).alias("prefix"),
        F.contains(folded, search_fold(F.lit(f))).alias("inside")) for f in fragments])
    hit = (names.select(F.col(ident).alias("__id"), F.explode(tests).alias("t")).where("t.inside").select("__id", "t.*")
           .groupBy("fragment").agg(
               F.count_if("exact").alias("n_exact"), F.count_if("prefix").alias("n_prefix"), F.count("*").alias("n_inside"),
               F.min(F.when(F.col("exact"), F.col("__id"))).alias("e"), F.min(F.when(F.col("prefix"), F.col("__id"))).alias("p"),
               F.min("__id").alias("s")))
    status = (F.when(F.col("n_exact") == 1, "exact").when(F.col("n_exact") > 1, "ambiguous")
              .when(F.col("n_prefix") == 1, "prefix").when(F.col("n_inside") == 1, "inside").otherwise("ambiguous"))
    chosen = F.when(F.col("n_exact") == 1, F.col("e")).when(F.col("n_exact") > 1, None).when(
        F.col("n_prefix") == 1, F.col("p")).when(F.col("n_inside") == 1, F.col("s"))
    return hit.withColumn("status", status).withColumn("entity_id", chosen).drop("e", "p", "s")


def period_detail(boards: DataFrame, keys: Sequence[str], category: str, order: Sequence[Column], label: str,
                  totals: DataFrame) -> DataFrame:
    """First row of every category of a period beside the period's totals."""
    first = top_k(boards, [*keys, category], order).select(*keys, category, F.col(label).alias("leader"))
    return first.join(totals, list(keys))


def on_this_day(df: DataFrame, day: str, month: int, dom: int, today: str, tie: Sequence[Column]) -> DataFrame:
    """Rows of this month and day; failing that the month's, by day; failing that the first five."""
    d = F.col(day).cast("date")
    rows = df.withColumn("__tier", F.when((F.month(d) == month) & (F.dayofmonth(d) == dom), 1)
                         .when(F.month(d) == month, 2).otherwise(3))
    best = rows.agg(F.min("__tier")).scalar()
    found = rows.where(F.col("__tier") == best).withColumn("days_since", F.datediff(F.lit(today).cast("date"), d))
    # only the last tier is cut, and five is what the question asks for
    first_five = top_k(rows.where(F.col("__tier") == 3), ["__tier"], [F.col(day), *tie], 5).select(
        *df.columns, "__tier", F.datediff(F.lit(today).cast("date"), d).alias("days_since"))
    return (found.where(F.col("__tier") < 3).unionByName(first_five.where(F.lit(3) == best))
            .withColumn("match", F.element_at(F.array(*map(F.lit, ("day", "month", "first"))), F.col("__tier"))).drop("__tier"))


def global_search(tables: Mapping[str, tuple[DataFrame, str, str]], text: str, limit: int) -> DataFrame:
    """Typed hits of a folded text in several tables, `limit` of them in a full order."""
    needle = search_fold(F.lit(text))
    out = None
    for kind, (df, ident, column) in tables.items():
        part = (df.where(F.contains(search_fold(column), needle))
                .select(F.lit(kind).alias("kind"), F.col(ident).cast("string").alias("ident"), F.col(column).alias("label")))
        out = part if out is None else out.unionByName(part)
    return out.orderBy("kind", "label", "ident").limit(limit)


def compare_entities(metrics: DataFrame, ident: str, entities: Sequence, names: Sequence[str]) -> DataFrame:
    """Side by side: one row per metric, leader and lead only where every entity has a value."""
    long = (metrics.where(F.col(ident).isin(*entities))
            .select(ident, *[F.col(n).cast("double").alias(n) for n in names])
            .unpivot([ident], list(names), "metric", "value"))
    wide = long.groupBy("metric").agg(*[F.max(F.when(F.col(ident) == e, F.col("value"))).alias(f"value_{i + 1}")
                                        for i, e in enumerate(entities)])
    vals = [F.col(f"value_{i + 1}") for i in range(len(entities))]
    known = F.lit(True)
    for v in vals:
        known = known & v.isNotNull()
    top = F.greatest(*vals)
    n_top = sum((F.when(v == top, 1).otherwise(0) for v in vals), F.lit(0))
    leader = F.when(known & (n_top == 1), F.coalesce(*[F.when(v == top, F.lit(str(e))) for v, e in zip(vals, entities, strict=True)]))
    return wide.withColumn("shared", known).withColumn("leader", leader)


def comparison_score(compared: DataFrame) -> DataFrame:
    """Rows won per entity over shared rows, ties and holes counted."""
    return compared.groupBy(F.when(~F.col("shared"), "hole").otherwise(F.coalesce("leader", F.lit("tie"))).alias("outcome")).agg(
        F.count("*").alias("n_metrics"))


def fact_selectivity(df: DataFrame, facts: Mapping[str, Column], too_broad: float = 0.7) -> DataFrame:
    """For each fact how many entities it leaves possible and certain, alone and after the facts before it."""
    size = F.count("*")
    aggs, so_far = [size.alias("n_all")], F.lit(True)
    for i, (_, p) in enumerate(facts.items()):
        possible = F.coalesce(p, F.lit(True))
        so_far = so_far & possible
        aggs += [F.count_if(possible).alias(f"p{i}"), F.count_if(F.coalesce(p, F.lit(False))).alias(f"c{i}"),
                 F.count_if(so_far).alias(f"s{i}")]
    packed = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("fact"), F.col(f"p{i}").alias("n_possible"),
                                F.col(f"c{i}").alias("n_certain"), F.col(f"s{i}").alias("n_left")) for i, n in enumerate(facts)])
    return (df.agg(*aggs).select("n_all", F.explode(packed).alias("f")).select("n_all", "f.*")
            .withColumn("too_broad", F.col("n_possible") > F.col("n_all") * too_broad).drop("n_all"))


def composite_rating(df: DataFrame, tags: Mapping[str, tuple[Column, float]],
                     rates: Mapping[str, tuple[Column, float, float]], name: str = "rating") -> DataFrame:
    """Points per tag plus weight x the part of a rate above its threshold; an unknown rate adds nothing."""
    total = F.lit(0.0)
    for pred, points in tags.values():
        total = total + F.when(pred, F.lit(float(points))).otherwise(0.0)
    for value, threshold, weight in rates.values():
        total = total + F.coalesce(F.greatest(F.lit(0.0), value - threshold) * weight, F.lit(0.0))
    return df.withColumn(name, total)


def group_depth(df: DataFrame, groups: Column, periods: Column, ident: str, floor: int = 1) -> DataFrame:
    """Distinct candidates per group x period, pairs below the floor left out."""
    pairs = df.select(ident, F.explode(groups).alias("group_key"), periods.alias("__p")).select(
        ident, "group_key", F.explode("__p").alias("period_key"))
    return (pairs.groupBy("group_key", "period_key").agg(F.count_distinct(ident).alias("depth"))
            .where(F.col("depth") >= floor))


def answer_share(df: DataFrame, cell: Sequence[str], weight: str) -> DataFrame:
    """Percent of one answer among its cell's answers."""
    return (attach_totals(df, cell, {"__all": F.sum(weight)})
            .withColumn("share_pct", F.col(weight) * 100 / F.col("__all")).drop("__all"))
