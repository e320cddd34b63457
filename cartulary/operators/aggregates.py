"""Aggregations of the archive: standings, coverage, inventories, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import null_safe, top_k


def standings_from_games(games: DataFrame, season: str, team_a: str, score_a: str, team_b: str, score_b: str) -> DataFrame:
    """One row per season and team. A tied score is a loss for both sides; an unknown score is no game."""
    sides = F.array(
        F.struct(F.col(team_a).alias("team"), (F.col(score_a) > F.col(score_b)).alias("won")),
        F.struct(F.col(team_b).alias("team"), (F.col(score_b) > F.col(score_a)).alias("won")))
    table = (games.where(F.col(score_a).isNotNull() & F.col(score_b).isNotNull())
             .select(season, F.explode(sides).alias("__s")).groupBy(season, "__s.team")
             .agg(F.count_if("__s.won").alias("wins"), F.count_if(~F.col("__s.won")).alias("losses")))
    order = Window.partitionBy(season).orderBy(
        (F.col("wins") / (F.col("wins") + F.col("losses"))).desc(), F.col("wins").desc(), "team")
    return table.withColumn("position", F.row_number().over(order))


def preferred_source(sources: Sequence[DataFrame], scope: Sequence[str], complete: Sequence[Column | None]) -> DataFrame:
    """All rows of the first source that covers a scope (and is complete there, when a test is given)."""
    out = None
    for i, (df, test) in enumerate(zip(sources, complete, strict=True)):
        part = df.withColumn("source_rank", F.lit(i))
        if test is not None:
            ok = df.groupBy(*scope).agg(test.alias("__ok")).where("__ok").drop("__ok")
            part = part.join(ok, list(scope), "left_semi")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    best = out.groupBy(*scope).agg(F.min("source_rank").alias("source_rank"))
    return out.join(best, [*scope, "source_rank"], "left_semi")


def inferred_lineups(box: DataFrame, game: Sequence[str], team: Sequence[str], member: str, measure: str,
                     points: str, raw: str, size: int = 5, min_games: int = 15, min_resolved: float = 0.6, known: Column | None = None) -> DataFrame:
    """Members most often among the top `size` of a game, per team, with support floors.

    Only games with `size` rows count. A member without an id is ranked as 'raw:' and the raw name. A seat is resolved when
    its member has an id and `known` holds (say, that the position is on file); a team needs `min_games` games and
    `min_resolved` of its seats. `n_resolved` counts the resolved members of the line-up itself. The reference breaks ties by
    input order; rows have none here, so the id does, then the raw name.
    """
    who = F.coalesce(F.col(member).cast("string"), F.concat(F.lit("raw:"), F.coalesce(F.col(raw), F.lit(""))))
    resolved = F.col(member).isNotNull() & F.coalesce(F.lit(True) if known is None else known, F.lit(False))
    seats = box.where(F.col(measure).isNotNull()).withColumns({"__who": who, "__ok": resolved})
    starters = top_k(seats, [*game, *team], [F.col(measure).desc(), F.col(member).asc_nulls_last(), F.col("__who")], size)
    whole = Window.partitionBy(*game, *team)  # at most `size` rows
    starters = starters.withColumn("__n", F.count("*").over(whole)).where(F.col("__n") == size)
    support = (starters.groupBy(*team).agg((F.count("*") / size).cast("long").alias("n_games"), F.avg(F.col("__ok").cast("int")).alias("resolved_share"),
                                           F.count("*").alias("__s"), F.count_if("__ok").alias("__r"))
               .where((F.col("n_games") >= min_games) & (F.col("__r") >= F.col("__s") * min_resolved)).drop("__s", "__r"))
    freq = starters.groupBy(*team, "__who").agg(F.count("*").alias("n_starts"), F.avg(F.coalesce(points, F.lit(0))).alias("mean_points"), F.bool_or("__ok").alias("__ok"))
    best = top_k(freq, team, [F.col("n_starts").desc(), F.col("__who")], size, rank_col="slot")
    in_team = Window.partitionBy(*team)  # at most `size` rows
    return (best.withColumn("n_resolved", F.count_if("__ok").over(in_team)).drop("__ok").withColumnRenamed("__who", member).join(support, list(team)))


def tracked_matrix(df: DataFrame, period: str, category: str, categories: Sequence[str], has_data: Column) -> DataFrame:
    """1 carried data, 0 an empty table was seen, NULL never seen."""
    flagged = df.withColumn("__f", F.when(has_data, 1).otherwise(0))
    return flagged.groupBy(period).pivot(category, list(categories)).agg(F.max("__f"))


def coverage(spine: DataFrame, period: str, facts: Mapping[str, DataFrame], bucket: Column) -> DataFrame:
    """Per bucket of periods the share of facts held, in percent."""
    out = spine.select(period).distinct()
    for name, df in facts.items():
        out = out.join(df.select(period).distinct().withColumn(name, F.lit(1)), period, "left")
    held = sum((F.coalesce(F.col(n), F.lit(0)) for n in facts), F.lit(0))
    return (out.groupBy(bucket.alias("bucket"))
            .agg(F.count("*").alias("n_periods"), *[F.count(n).alias(n) for n in facts], F.sum(held).alias("__held"))
            .withColumn("coverage_pct", F.round(F.col("__held") * 100 / (F.col("n_periods") * len(facts)), 1))
            .drop("__held"))


def capture_inventory(df: DataFrame, keys: Sequence[str], ok: Column, digest: Column, stamp: str, variant: Column) -> DataFrame:
    """Captures, usable ones, distinct contents and variants, first and last, per script.

    Reduced by content first, so the distinct counts never move the pages themselves.
    """
    small = df.select(*keys, ok.alias("__ok"), digest.alias("__d"), F.col(stamp).alias("__t"), variant.alias("__v"))
    return small.groupBy(*keys).agg(
        F.count("*").alias("n_captures"), F.count_if("__ok").alias("n_ok"),
        F.count_distinct("__d").alias("n_digests"), F.count_distinct("__v").alias("n_variants"),
        F.min("__t").alias("first_seen"), F.max("__t").alias("last_seen"))


def status_histogram(df: DataFrame, keys: Sequence[str], status: str) -> DataFrame:
    """Counts by status as one map per key; the number of statuses bounds the map."""
    per = df.groupBy(*keys, status).agg(F.count("*").alias("__n"))
    return per.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(status, "__n")))).alias("histogram"))


def best_status(spine: DataFrame, df: DataFrame, period: str, ranked: Sequence[tuple[str, Column]],
                absent: str = "absent") -> DataFrame:
    """Best status seen per period, in the order given; periods without rows are absent."""
    flags = df.groupBy(period).agg(*[F.bool_or(p).alias(f"__f{i}") for i, (_, p) in enumerate(ranked)])
    status = F.lit(absent)
    for i, (name, _) in reversed(list(enumerate(ranked))):
        status = F.when(F.col(f"__f{i}"), name).otherwise(status)
    return spine.join(flags, period, "left").select(*spine.columns, status.alias("status"))


def compact_ranges(df: DataFrame, keys: Sequence[str], number: str, name: str = "ranges") -> DataFrame:
    """ "1958-1960, 1972". Distinct periods first: what one key gathers is bounded by the calendar."""
    w = Window.partitionBy(*keys).orderBy(number)
    islands = (df.select(*keys, number).distinct()
               .withColumn("__g", F.col(number) - F.row_number().over(w))
               .groupBy(*keys, "__g").agg(F.min(number).alias("__a"), F.max(number).alias("__b")))
    label = F.when(F.col("__a") == F.col("__b"), F.col("__a").cast("string")).otherwise(F.concat_ws("-", "__a", "__b"))
    return (islands.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct("__a", label.alias("t")))).alias("__r"), F.count("*").alias("n_ranges"))
            .withColumn(name, F.array_join(F.transform("__r", lambda r: r["t"]), ", ")).drop("__r"))


def title_summary(finals: DataFrame, period: str, winner: str, runner_up: str) -> DataFrame:
    """Titles, finals lost, win share, last title and drought per club. One row per period goes in."""
    sides = (finals.select(period, F.explode(F.array(
        F.struct(F.col(winner).alias("club"), F.lit(True).alias("won")),
        F.struct(F.col(runner_up).alias("club"), F.lit(False).alias("won")))).alias("__s"))
        .select(period, "__s.*").where(F.col("club").isNotNull()))
    latest = finals.agg(F.max(period)).scalar()
    return (sides.groupBy("club")
            .agg(F.count_if("won").alias("titles"), F.count_if(~F.col("won")).alias("finals_lost"),
                 F.count("*").alias("finals"), F.max(F.when(F.col("won"), F.col(period))).alias("last_title"))
            .withColumn("win_pct", F.round(F.col("titles") * 100 / F.col("finals"), 1))
            .withColumn("drought", latest - F.col("last_title")))


def totals_without_flagged(df: DataFrame, keys: Sequence[str], flagged: Column, sums: Sequence[str], period: str) -> DataFrame:
    """Sums over rows without a dispute flag; flagged rows stay visible as a count."""
    use = ~F.coalesce(flagged, F.lit(False))
    return df.groupBy(*keys).agg(
        *[F.sum(F.when(use, F.col(c))).alias(c) for c in sums],
        F.count_distinct(F.when(use, F.col(period))).alias("n_periods"),
        F.min(F.when(use, F.col(period))).alias("first_period"), F.max(F.when(use, F.col(period))).alias("last_period"),
        F.count_if(~use).alias("n_flagged"))


def conflict_split(df: DataFrame, keys: Sequence[str], a: tuple[str, str], b: tuple[str, str]) -> DataFrame:
    """Two-source rows by which of two fields agrees."""
    same_1, same_2 = F.col(a[0]).eqNullSafe(F.col(b[0])), F.col(a[1]).eqNullSafe(F.col(b[1]))
    kind = (F.when(same_1 & same_2, "equal").when(same_1, "second_differs").when(same_2, "first_differs")
            .otherwise("both_differ"))
    return df.groupBy(*keys, kind.alias("kind")).agg(F.count("*").alias("n_rows"))


def season_leaders(boards: Sequence[DataFrame], scope: Sequence[str], rank: str, label: str, size: int) -> DataFrame:
    """Leader boards merged into one sorted array per scope, `size` entries at most."""
    from functools import reduce

    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), boards)
    best = top_k(rows, scope, [F.col(rank), F.col(label)], size)
    return best.groupBy(*scope).agg(F.sort_array(F.collect_list(F.struct(rank, label))).alias("leaders"))


def entity_counts(df: DataFrame, keys: Sequence[str], distinct: Mapping[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"),
                                 *[F.count_distinct(c).alias(n) for n, c in distinct.items()])


def modal_value(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent value per key; the smallest value among equals."""
    per = df.groupBy(*keys, value).agg(F.count("*").alias("n_modal"))
    return top_k(per, keys, [F.col("n_modal").desc(), F.col(value)])


def margins(df: DataFrame, per_key: DataFrame, keys: Sequence[str], value: str, reference: str) -> DataFrame:
    """Difference of each row to a value of its group."""
    return null_safe(df, per_key, keys).withColumn("margin", F.col(value) - F.col(reference))
