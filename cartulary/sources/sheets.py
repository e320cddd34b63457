"""Typed rows of the archive's known page families, from the cells `pages.extract_tables` gives.

Tables are recognised by what their header says, never by their position on the page.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..operators.skew import shuffled, top_k
from ..session import written
from .pages import caption, column_paths, divider_groups, first_table, labelled_cells, named_cells


def _heading(c: Column) -> Column:
    return F.upper(F.trim(text.strip_accents(c)))


def champion_ledger(cells: DataFrame) -> DataFrame:
    """Season ledger rows: the table with a club column and a champion or runner-up column."""
    names = F.transform("header", _heading)
    is_ledger = F.array_contains(names, "EQUIPO") & F.exists(names, lambda h: h.contains("CAMPEON"))
    cell = [text.squish(F.get("cells", F.lit(i))) for i in range(4)]
    out = cells.where(F.coalesce(is_ledger, F.lit(False))).withColumns({
        "season": dates.season_key(cell[0]), "__c": dates.champion_cell(cell[1]), "coach": cell[2], "runner_up_city": cell[3]})
    multi = ~F.col("coach").contains(",") & (F.size(F.split("coach", " ")) >= 4)
    return (out.withColumns({"champion_city": F.col("__c.city"), "note": F.col("__c.note"), "no_champion": F.col("__c.no_champion"),
                             "coach_flag": F.when(multi, "multi?").otherwise("")})
            .where(F.col("season") != "").drop("__c", "header", "cells"))


class Games(NamedTuple):
    results: DataFrame
    box: DataFrame
    pages: DataFrame  # page, status: ok or skipped


# fixed values: column labels of the wide box score
BOX_LABELS = {"player": "JUGADOR", "min": "MIN", "three": "CC3I-CC3A", "two": "CCI-CCA", "free": "TLI-TLA", "reb": "REB off/def",
              "ast": "AST", "stl": "STEALS", "blk": "BK", "pf": "FP", "tov": "TO", "pts": "TP"}


def game_boxes(cells: DataFrame, key: str) -> Games:
    """Results and player rows of pages with one line score and exactly two box scores; others are counted."""
    at = F.col("row_no")
    tables = cells.groupBy(key, "table_no").agg(
        F.count("*").alias("n"), F.max(F.when(at == 0, F.get("cells", F.lit(0)))).alias("title"),
        F.bool_or((at == 0) & F.array_contains("cells", "TOTAL") & F.array_contains("cells", "1st")).alias("line"),
        F.bool_or((at == 1) & (F.trim(F.get("cells", F.lit(0))) == "JUGADOR")).alias("box"),
        F.max_by("cells", F.when(at == 1, 1)).alias("labels"))
    line = tables.where("line AND n >= 3").groupBy(key).agg(F.min("table_no").alias("table_no"), F.min_by("title", "table_no").alias("heading"))
    boxes = tables.where("box AND n > 2")
    fit = boxes.groupBy(key).agg(F.count("*").alias("n_box")).where("n_box = 2").join(line, key).select(key, "table_no", "heading")
    pages = (cells.select(key).distinct().join(fit.select(key, F.lit("ok").alias("status")), key, "left").fillna("skipped", ["status"]))

    score = (cells.join(fit, [key, "table_no"]).where(at.between(1, 2))
             .select(key, "heading", at.alias("side"), text.squish(F.get("cells", F.lit(0))).alias("team"),
                     numbers.to_int(F.element_at("cells", -1)).alias("total"),
                     F.transform(F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 2, F.lit(0))), lambda q: numbers.to_int(q)).alias("q")))

    def of(side, c):
        return F.max_by(c, F.when(F.col("side") == side, 1))

    results = score.groupBy(key).agg(
        dates.game_date(F.regexp_extract(F.max("heading"), r"^(\d{1,2}/\d{1,2}/\d{2})", 1)).alias("date"),
        of(1, "team").alias("team_a_raw"), of(1, "total").alias("score_a"), of(2, "team").alias("team_b_raw"), of(2, "total").alias("score_b"),
        of(1, "q").alias("quarters_a"), of(2, "q").alias("quarters_b"))

    rows = (cells.join(boxes.select(key, "table_no", "title", "labels").join(fit.select(key), key, "left_semi"), [key, "table_no"])
            .where(at >= 2))
    named = labelled_cells(rows, BOX_LABELS, "labels").withColumn("player", text.squish("player"))
    named = named.where((F.col("player") != "") & ~F.lower("player").startswith("total"))
    who = text.split_jersey("player")
    pairs = {"three": numbers.split_pair("three", "-", ("fg3a", "fg3m")), "two": numbers.split_pair("two", "-", ("fg2a", "fg2m")),
             "free": numbers.split_pair("free", "-", ("fta", "ftm")), "reb": numbers.split_pair("reb", "/", ("oreb", "dreb"))}
    named = named.withColumns({**pairs, "who": who})
    out = named.select(
        key, text.squish("title").alias("team_raw"), "who.jersey", F.col("who.name").alias("player_raw"), numbers.to_int("min").alias("minutes"),
        "two.fg2m", "two.fg2a", "three.fg3m", "three.fg3a", "free.ftm", "free.fta", "reb.oreb", "reb.dreb",
        (F.col("reb.oreb") + F.col("reb.dreb")).alias("reb"),
        *[numbers.to_int(c).alias(c) for c in ("ast", "stl", "blk", "pf", "tov", "pts")])
    return Games(results, out.withColumn("box_check", numbers.points_check("fg2m", "fg3m", "ftm", "pts")), pages)


def standings_rows(cells: DataFrame, key: str, group: str = r"(?i)^\s*group\s+([a-z])\s*$", record: str = r"(\d+)\s*-\s*(\d+)") -> DataFrame:
    """Position, club, wins, losses and group; a club listed twice in a group counts once, by its first row."""
    line = F.array_join("cells", " ")
    rows = divider_groups(cells.withColumn("line", line), [key, "table_no"], "row_no", F.col("line").rlike(group),
                          F.lower(F.regexp_extract("line", group, 1)))
    pat = r"^\s*(\d+)\.?\s+(.+?)\s+" + record
    found = rows.where(F.col("line").rlike(pat)).select(
        key, "table_no", "row_no", "group_label", F.regexp_extract("line", pat, 1).try_cast("int").alias("position"),
        text.squish(F.regexp_extract("line", pat, 2)).alias("city_raw"), F.regexp_extract("line", pat, 3).try_cast("int").alias("wins"),
        F.regexp_extract("line", pat, 4).try_cast("int").alias("losses"))
    return top_k(found, [key, "table_no", "group_label", "city_raw"], [F.col("row_no")])


# --- game pages with stacked headers -----------------------------------------

#: Column of each figure: the label, and which of several columns of that label (made and attempted repeat for two, three, free).
MODERN_BOX = {"no": ("No", 1), "player": ("Name", 1), "min": ("Min", 1), "fg2m": ("M", 1), "fg2a": ("A", 1), "fg3m": ("M", 2), "fg3a": ("A", 2),
              "ftm": ("M", 3), "fta": ("A", 3), "oreb": ("O", 1), "dreb": ("D", 1), "reb": ("To", 1), "ast": ("AS", 1), "pf": ("PF", 1),
              "tov": ("TO", 1), "stl": ("ST", 1), "blk": ("BS", 1), "pts": ("PTS", 1)}  # fixed values: labels of the source
MODERN_COLUMNS = 20  # fewest columns of a player box


def _leaves(paths: str = "paths") -> Column:
    return F.transform(paths, lambda p: F.coalesce(F.try_element_at(p, F.lit(-1)), F.lit("")))


def modern_boxes(grid: DataFrame, key: str) -> Games:
    """Results and player rows of pages whose box scores have stacked headers, by label.

    A page without a player box is skipped and counted. Boxes belong to the teams of the line score in their order on the
    page. A team's score is its stated total, else the total its box ends with; figures the page lacks are NULL.
    """
    g = grid.withColumn("paths", column_paths()).withColumn("__leaf", _leaves())
    width = F.size("__leaf")
    is_box = (width >= MODERN_COLUMNS) & F.array_contains("__leaf", "Name") & F.array_contains("__leaf", "PTS")
    all_labels = F.array_join(F.flatten("head"), " ")
    is_line = width.between(4, 7) & (F.col("n_rows") >= 2) & all_labels.contains("TOTAL") & all_labels.contains("1st")
    # four branches read these rows: the header tree is worked out once for all
    g = written(g.withColumns({"__box": F.coalesce(is_box, F.lit(False)), "__line": F.coalesce(is_line, F.lit(False))}).drop("__leaf", "links", "alts"))

    pages = g.groupBy(key).agg(F.min(F.when(F.col("__line"), F.col("table_no"))).alias("__line_no"),
                               F.sort_array(F.collect_set(F.when(F.col("__box"), F.col("table_no")))).alias("__box_nos"))  # tables of one page
    seen = pages.select(key, F.when(F.size("__box_nos") > 0, "ok").otherwise("skipped").alias("status"))
    here = g.join(pages.where(F.size("__box_nos") > 0), key)

    side = F.array_position("__box_nos", F.col("table_no")).cast("int")
    rows = named_cells(here.where("__box").withColumn("side", side), MODERN_BOX).withColumn("player", text.squish("player"))
    is_total = F.lower("player").startswith("total")
    totals = rows.where(is_total).groupBy(key).agg(*[F.min_by(numbers.to_int("pts"), F.when(F.col("side") == i, F.col("row_no"))).alias(f"__t{i}") for i in (1, 2)])

    line = here.where("__line AND table_no = __line_no AND row_no < 2").withColumn("side", F.col("row_no") + 1)
    line = line.select(key, "side", all_labels.alias("__labels"), text.squish(F.get("cells", F.lit(0))).alias("team"), numbers.to_int(F.try_element_at("cells", F.lit(-1))).alias("total"),
                       F.transform(F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 2, F.lit(0))), lambda q: numbers.to_int(q)).alias("q"))

    def of(i, c):
        return F.max_by(c, F.when(F.col("side") == i, 1))

    teams = line.where("team NOT IN ('', 'nan')").groupBy(key).agg(
        dates.game_date(F.regexp_extract(F.max("__labels"), r"(\d{1,2}/\d{1,2}/\d{4})", 1)).alias("date"), F.count("*").alias("__n"),
        *[of(i, c).alias(f"__{c}{i}") for i in (1, 2) for c in ("team", "total", "q")])
    results = (teams.where("__n = 2").join(totals, key, "left")
               .select(key, "date", F.col("__team1").alias("team_a_raw"), F.coalesce("__total1", "__t1").alias("score_a"),
                       F.col("__team2").alias("team_b_raw"), F.coalesce("__total2", "__t2").alias("score_b"),
                       F.col("__q1").alias("quarters_a"), F.col("__q2").alias("quarters_b")))

    players = rows.where(~is_total & ~F.col("player").isin("", "nan")).join(teams.select(key, "date", "__team1", "__team2"), key, "left")
    figures = [c for c in MODERN_BOX if c not in ("no", "player", "min")]
    out = players.select(
        key, "date", F.when(F.col("side") == 1, F.col("__team1")).when(F.col("side") == 2, F.col("__team2")).alias("team_raw"),
        F.regexp_replace(text.squish("no"), r"\.0$", "").alias("jersey"), F.col("player").alias("player_raw"), numbers.to_minutes("min").alias("minutes"),
        *[numbers.to_int(c).alias(c) for c in figures])
    return Games(results, out.withColumn("box_check", numbers.points_check("fg2m", "fg3m", "ftm", "pts")), seen)


def play_rows(grid: DataFrame, key: str, least: int = 5) -> DataFrame:
    """Rows of play-by-play tables, in page order: who did what when, and the score the source states beside it.

    The table is told by its first label; its last two labels name the teams. Rows without a description and the captions
    of a period's start are left out but keep their place in `seq`. A grid in `parts` has its headers read part by part.
    """
    g = grid.withColumn("paths", column_paths()).withColumn("__leaf", _leaves())
    own = (F.get("__leaf", F.lit(0)) == "Cuarto") & (F.col("n_rows") >= least)
    teams = {"local_team": text.squish(F.replace(F.get("__leaf", F.lit(3)), F.lit("Local"))),
             "visit_team": text.squish(F.regexp_replace(F.get("__leaf", F.lit(4)), "Vistante|Visitante", ""))}
    rows = first_table(g.where(own).select(key, "table_no", "row_no", "cells", *[c.alias(n) for n, c in teams.items()]), key)
    if dict(grid.dtypes)["cells"] == "array<array<string>>":
        rows = rows.select(key, "row_no", *teams, F.posexplode("cells").alias("__at", "cells")).withColumn("row_no", F.col("row_no") + F.col("__at"))
    cell = ["period_raw", "clock", "play_raw", "__local", "__visit"]
    # each cell is squished once, not once for each pattern it is held against
    rows = rows.select(key, (F.col("row_no") + 1).alias("seq"), *teams, *[text.squish(F.coalesce(F.get("cells", F.lit(i)), F.lit(""))).alias(n) for i, n in enumerate(cell)])
    play = text.play_fields("play_raw", squished=True)
    return (rows.where((F.col("play_raw") != "") & ~F.lower("play_raw").startswith("primer |"))
            .select(key, "seq", *cell[:3], play["event_type"].alias("event_type"), play["actor_raw"].alias("actor_raw"), play["team_raw"].alias("team_raw"),
                    *teams, numbers.to_int("__local").alias("local_score"), numbers.to_int("__visit").alias("visit_score")))


# --- people and team seasons ---------------------------------------------------

class Directory(NamedTuple):
    people: DataFrame  # one row for each person
    jerseys: DataFrame  # person, number: every number seen
    pages: DataFrame  # page, status: ok, or what was wrong with it


def directory(grid: DataFrame, links: DataFrame, key: str, captured: str, pattern: str = r"jugador\.asp\?id=(\d+)") -> Directory:
    """People of directory pages, merged over all captures.

    `grid` carries the capture's time beside each row, `links` are the page's links in order; the n-th person link belongs to
    the n-th row, so a page whose links and rows differ in number is reported and not read. The newest capture with a name
    gives it; the oldest one with a nickname or a birth date gives those (ties: the smaller page).
    """
    g = grid.withColumn("paths", column_paths()).withColumn("__leaf", _leaves())
    own = g.where(F.array_contains("__leaf", "Apellidos") & F.array_contains("__leaf", "Nombre"))
    first = own.groupBy(key).agg(F.min("table_no").alias("table_no"), F.min_by("n_rows", "table_no").alias("__rows"))
    ids = links.withColumn("id", F.regexp_extract("link", pattern, 1)).where("id != ''")
    found = ids.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("position", "id"))).alias("__ids"))  # links of one page
    pages = (grid.select(key).distinct().join(first, key, "left").join(found, key, "left")
             .withColumn("status", F.when(F.col("__rows").isNull(), "no table").when(F.col("__rows") != F.coalesce(F.size("__ids"), F.lit(0)), "rows and links differ").otherwise("ok")))
    rows = own.join(pages.where("status = 'ok'").select(key, "table_no", "__ids"), [key, "table_no"])
    rows = named_cells(rows, {"family": ("Apellidos", 1), "given": ("Nombre", 1), "born": ("Nació", 1), "number": ("Camisa", 1)})

    def known(c):
        v = text.squish(c)
        return F.when((v != "") & (F.lower(v) != "nan"), v)

    rows = rows.select(
        F.get("__ids", F.col("row_no"))["id"].alias("person_id"), F.col(key).alias("__page"), F.col(captured).alias("__at"), known("family").alias("family"),
        known(text.strip_nickname("given")).alias("given"), known(text.extract_nickname("given")).alias("nickname"),
        dates.clean_date_text("born").alias("born"), F.regexp_replace(known("number"), r"\.0$", "").alias("number"))
    at = F.struct("__at", "__page")

    def newest(c):
        return F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c)

    def oldest(c):
        return F.min_by(c, F.when(F.col(c).isNotNull(), at))

    people = rows.groupBy("person_id").agg(
        newest("family"), newest("given"), oldest("nickname").alias("nickname"), oldest("born").alias("birth_date"),
        F.coalesce(F.min(F.when(F.col("born").isNotNull(), at)), F.min(at))["__page"].alias("source_page"),
        F.count("*").alias("n_captures"), F.min("__at").alias("first_seen"), F.max("__at").alias("last_seen"))
    return Directory(people, rows.where("number IS NOT NULL").select("person_id", F.col("number").alias("jersey")).distinct(), pages.select(key, "status"))


# fixed values: place of each figure in the accumulated and the average table
ACCUMULATED = {"games": 2, "minutes": 4, "dreb": 8, "treb": 9, "ast": 10, "stl": 11, "blk": 12, "tov": 13, "pts": 14}
PAIRS = {"two": (5, "fga", "fgm"), "three": (6, "tpa", "tpm"), "free": (7, "fta", "ftm")}
TEAM_COLUMNS = 15


class TeamSeasons(NamedTuple):
    players: DataFrame
    teams: DataFrame
    pages: DataFrame  # page, status: ok, no table, or older (another capture of the same team season is newer)


def team_seasons(grid: DataFrame, key: str, context: list[str], captured: str) -> TeamSeasons:
    """Player and team rows of team-season pages: accumulated figures, with averages from the second table by name.

    `context` names the columns of `grid` that tell one team season from another; of several captures the newest is read
    (ties: the larger page). The totals row of a table is the team's.
    """
    title = F.upper(F.concat_ws(" ", caption(), F.get(F.get("head", F.lit(0)), F.lit(0))))
    g = grid.withColumn("__kind", F.when(title.contains("ACUMULADOS"), "acc").when(title.contains("PROMEDIO POR JUGADOR"), "avg"))
    chosen = g.groupBy(key, *context, captured).agg(*[F.max(F.when(F.col("__kind") == k, F.col("table_no"))).alias(f"__{k}") for k in ("acc", "avg")])
    newest = top_k(chosen.where("__acc IS NOT NULL"), context, [F.desc(captured), F.desc(key)]).select(key, "__acc", "__avg")
    pages = (chosen.select(key, "__acc").join(shuffled(newest.select(key, F.lit(True).alias("__new"))), key, "left")
             .select(key, F.when(F.col("__new"), "ok").when(F.col("__acc").isNull(), "no table").otherwise("older").alias("status")))
    rows = g.where("__kind IS NOT NULL").where(F.size("cells") >= TEAM_COLUMNS).join(shuffled(newest), key)
    name = text.squish(F.get("cells", F.lit(1)))
    averages = (rows.where("__kind = 'avg' AND table_no = __avg").groupBy(key, name.alias("player_raw"))
                .agg(F.max_by("cells", "row_no").alias("__c"))
                .select(key, "player_raw", numbers.to_float(F.get("__c", F.lit(14))).alias("ppg"), numbers.to_float(F.get("__c", F.lit(5))).alias("fg_pct")))
    pair = {n: numbers.split_pair(F.get("cells", F.lit(i)), "-", (a, m)) for n, (i, a, m) in PAIRS.items()}
    full = rows.where("__kind = 'acc' AND table_no = __acc").withColumns(pair).select(
        key, *context, captured, F.coalesce(text.squish(F.get("cells", F.lit(0))), F.lit("")).alias("jersey"), name.alias("player_raw"),
        *[numbers.to_int(F.get("cells", F.lit(i))).alias(c) for c, i in ACCUMULATED.items()],
        *[F.col(f"{n}.{c}") for n, (_, a, m) in PAIRS.items() for c in (a, m)])
    total = (F.lower("player_raw") == "totales") | ((F.col("jersey") == "") & F.lower("player_raw").startswith("total"))
    return TeamSeasons(full.where(~total & (F.col("player_raw") != "")).join(shuffled(averages), [key, "player_raw"], "left"),
                       full.where(total).drop("jersey", "player_raw"), pages)
