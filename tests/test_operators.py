"""Small fixtures for the operators whose rules the test tables cannot show."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from cartulary.operators import aggregates, dedup, joins, questions, select, sets, windows


def test_ledger_keeps_the_newest_and_says_what_was_disputed(spark):
    df = spark.createDataFrame([("1950", "1", "rio", "mar", "n1"), ("1950", "3", "rio", "mar", "n3"), ("1951", "1", "rio", None, ""), ("1951", "2", "sol", None, ""),
                                ("1953", "5", None, None, "no champion"), ("1942-1943", "1", "sol", "rio", "")], "season string, ts string, champion string, runner_up string, note string")
    r = dedup.latest_wins(df, ["season"], ["ts"], ["champion", "runner_up"])
    assert rows(r.latest, "season", "ts", "champion", "note", "n_captures", "n_variants", "confidence") == [
        ("1942-1943", "1", "sol", "", 1, 1, "single-source"), ("1950", "3", "rio", "n3", 2, 1, "single-source"),
        ("1951", "2", "sol", "", 2, 2, "disputed"), ("1953", "5", None, "no champion", 1, 0, "single-source")]
    assert rows(r.variants.where("season = '1951'"), "champion", "n_captures") == [("rio", 1), ("sol", 1)]


def test_boards_keep_all_rows_of_the_newest_capture(spark):
    df = spark.createDataFrame([("2010", "pts", "1", 1, "old"), ("2010", "pts", "2", 1, "a"), ("2010", "pts", "2", 2, "b"), ("2010", "reb", "1", 1, "c"),
                                ("2011", "pts", "9", 1, "finals")], "season string, cat string, ts string, rank int, who string")
    scoped = df.withColumns({"career": F.lit(False), "grp": F.lit(""), "known": F.lit(True), "regular": F.col("who") != "finals"})
    kept = dedup.latest_batch(scoped.where(select.board_scope("season", "career", "grp", "known", "regular")), ["season", "cat"], "ts")
    assert rows(kept, "season", "cat", "who") == [("2010", "pts", "a"), ("2010", "pts", "b"), ("2010", "reb", "c")]


def test_measures_are_never_summed_and_sources_merge_by_priority(spark):
    df = spark.createDataFrame([("p", None, 1), ("p", 5, 2), ("p", 3, 3), ("q", None, 4)], "k string, games int, id int")
    assert rows(dedup.best_by_measure(df, ["k"], F.col("games"), [F.col("id")]), "k", "id") == [("p", 2), ("q", 4)]
    src = spark.createDataFrame([("a", 2, "x", 5), ("a", 1, None, 9), ("a", 3, "z", 1)], "k string, pri int, label string, n int")
    assert rows(dedup.merge_sources(src, "k", "pri", ["label"], ["n"], {"n_src": "pri"}), "label", "n", "n_src") == [("x", 9, 3)]


def test_query_form(spark):
    df = spark.createDataFrame([(1, 1999, "Río Alto", "x"), (2, None, "Mar", "RIO y"), (3, 2005, "Sol", "z"), (4, 1998, "Río", "w")], "id int, season int, club string, note string")
    ds = {"all": select.Dataset(df, [F.col("id")], "season", ["club"])}
    assert rows(select.query_named(ds, "all", year_from=1999, year_to=2001), "id") == [(1,), (2,)]        # an unknown year passes
    assert rows(select.query_named(ds, "all", club="rio"), "id") == [(1,), (4,)]
    assert rows(select.query_named(ds, "all", contains="rio", limit=2), "id") == [(1,), (2,)]
    with pytest.raises(KeyError, match="all"):
        select.query_named(ds, "none")


def test_unknown_sorts_lowest_and_text_follows_the_alphabet(spark):
    df = spark.createDataFrame([("oa", 1), ("ñu", None), ("nz", 3), (None, 2)], "t string, n int")
    assert [r.t for r in df.orderBy(select.sort_order("t", "text")).collect()] == [None, "nz", "ñu", "oa"]
    assert [r.n for r in df.orderBy(select.sort_order("n", "number", True)).collect()] == [3, 2, 1, None]


def test_capture_selection(spark):
    df = spark.createDataFrame([("http://a/l.asp?y=1", "200"), ("http://a/l.asp?y=1&utm_x=1", "200"), ("http://a/l.asp?y=2", "404")], "url string, status string")
    assert rows(select.select_captures(df, F.col("status").isin("200", "-"), [r"utm_"], "url"), "url") == [("http://a/l.asp?y=1",)]


def test_tied_games_lose_twice_and_unknown_scores_do_not_count(spark):
    g = spark.createDataFrame([(1, "a", 80, "b", 70), (1, "a", 60, "b", 60), (1, "b", None, "a", 5)], "s int, x string, xs int, y string, ys int")
    assert rows(aggregates.standings_from_games(g, "s", "x", "xs", "y", "ys"), "team", "wins", "losses", "position") == [("a", 1, 1, 1), ("b", 0, 2, 2)]


def test_lineups_need_support(spark):
    box = [(g, "t", p, 30 - i, 10) for g in range(15) for i, p in enumerate((1, 2, 3, 4, 5, 6))] + [(0, "u", 1, 9, 9)]
    box += [(g, "v", None if i else 1, 30 - i, 10) for g in range(15) for i in range(5)]
    df = spark.createDataFrame(box, "game int, team string, pid int, minutes int, pts int")
    out = aggregates.inferred_lineups(df.withColumn("name", F.lit("x")), ["game"], ["team"], "pid", "minutes", "pts", "name")
    assert rows(out, "team", "pid", "n_starts", "slot") == [("t", str(i), 15, i) for i in range(1, 6)]


def test_ranges_runs_and_streaks(spark):
    df = spark.createDataFrame([("a", y) for y in (1958, 1959, 1960, 1972, 1960)] + [("b", 1961)], "club string, season int")
    assert rows(aggregates.compact_ranges(df, ["club"], "season"), "club", "ranges") == [("a", "1958-1960, 1972"), ("b", "1961")]
    assert rows(windows.consecutive_runs(df, ["club"], "season"), "club", "run_start", "run_length") == [("a", 1958, 3)]
    t = df.distinct()
    assert rows(windows.holder_streaks(t, [], "season", "club"), "season", "streak") == [(1958, 1), (1959, 2), (1960, 3), (1961, 1), (1972, 1)]


def test_title_summary_and_games_behind(spark):
    f = spark.createDataFrame([(1950, "a", "b"), (1951, "b", "a"), (1952, "a", None)], "s int, w string, r string")
    assert rows(aggregates.title_summary(f, "s", "w", "r"), "club", "titles", "finals_lost", "last_title", "drought", "win_pct") == [
        ("a", 2, 1, 1952, 0, 66.7), ("b", 1, 1, 1951, 1, 50.0)]
    st = spark.createDataFrame([("g", "a", 20, 10, 1), ("g", "b", 15, 14, 2)], "g string, t string, w int, l int, p int")
    assert rows(windows.games_behind(st, ["g"], "w", "l", [F.col("p")]), "t", "games_behind") == [("a", 0.0), ("b", 4.5)]


def test_status_precedence_and_matrix(spark):
    spine = spark.createDataFrame([(1,), (2,), (3,)], "y int")
    caps = spark.createDataFrame([(1, "404"), (1, "200"), (2, "-")], "y int, s string")
    ranked = [("ok", F.col("s") == "200"), ("revisit", F.col("s") == "-"), ("error", F.col("s") == "404")]
    assert rows(aggregates.best_status(spine, caps, "y", ranked)) == [(1, "ok"), (2, "revisit"), (3, "absent")]
    m = spark.createDataFrame([(1, "a", 3), (1, "b", 0)], "y int, c string, n int")
    assert rows(aggregates.tracked_matrix(m, "y", "c", ["a", "b", "z"], F.col("n") > 0)) == [(1, 1, 0, None)]


def test_flagged_rows_leave_the_totals_but_stay_counted(spark):
    df = spark.createDataFrame([(1, 2000, 5, True), (1, 2001, 7, False), (1, 2002, None, None)], "k int, s int, pts int, bad boolean")
    assert rows(aggregates.totals_without_flagged(df, ["k"], F.col("bad"), ["pts"], "s")) == [(1, 7, 2, 2001, 2002, 1)]


def test_lookups(spark):
    df = spark.createDataFrame([("1",), ("rio",), ("Mar",), ("twin",), ("zzz",)], "raw string")
    code = spark.createDataFrame([("1", 10)], "c string, i int")
    name = spark.createDataFrame([("rio", 20), ("mar", 30), ("twin", 1), ("twin", 2)], "n string, i int")
    out = joins.resolver_chain(df, [("code", F.col("raw"), code, "c", "i"), ("name", F.lower("raw"), name, "n", "i")])
    assert rows(out) == [("1", 10, "code"), ("Mar", 30, "name"), ("rio", 20, "name"), ("twin", None, "unresolved"), ("zzz", None, "unresolved")]
    x = joins.crosswalk(df, code.withColumnRenamed("c", "raw").unionByName(spark.createDataFrame([("gone", 5)], "raw string, i int")), "raw")
    assert x.unmapped.count() == 4 and rows(x.unused, "raw") == [("gone",)]


def test_club_check_has_four_answers(spark):
    career = spark.createDataFrame([(1, 2000, "a"), (2, 2001, "b")], "id int, s int, club string")
    obs = spark.createDataFrame([(1, 2001, "a"), (1, 2001, "b"), (1, 2003, "a"), (2, 2000, None)], "id int, s int, club string")
    assert rows(joins.near_club_check(obs, career, "id", "s", "club"), "id", "s", "club", "club_check") == [
        (1, 2001, "a", "confirms"), (1, 2001, "b", "contradicts"), (1, 2003, "a", "no_career_club"), (2, 2000, None, "no_obs_club")]


def test_redirect_clashes_are_reported(spark):
    slugs = spark.createDataFrame([(1, "ana"), (2, "eva"), (3, "luz"), (4, "luz"), (5, "x")], "id int, slug string")
    dead = spark.createDataFrame([(1, 2), (3, 5)], "retired int, survivor int")
    r = joins.redirects(dead, slugs, "retired", "survivor", "id", "slug")
    assert rows(r.redirects, "old_slug", "new_slug") == [("ana", "eva")] and rows(r.clashes, "old_slug") == [("luz",)]


def test_gaps_are_filled_not_replaced(spark):
    base = spark.createDataFrame([(1950, "rio"), (1951, "mar")], "s int, w string")
    more = spark.createDataFrame([(1951, "sol"), (1952, "sol")], "s int, w string")
    assert rows(sets.fill_gaps(base, more, ["s"], value="w"), "s", "w", "footnote", "origin") == [
        (1950, "rio", None, "base"), (1951, "mar", "sol", "base"), (1952, "sol", None, "addition")]


def test_diff_sees_null_against_blank(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, ""), (2, "x"), (4, "z")], "k int, v string")
    assert rows(sets.snapshot_diff(a, b, ["k"])) == [(1, "changed"), (3, "removed"), (4, "added")]


def test_facts_stay_with_their_best_row(spark):
    career = spark.createDataFrame([(1, 2000, "rio", 10), (1, 2000, "mar", 11), (2, 2000, "sol", 12)], "pid int, s int, team string, rid int")
    facts = spark.createDataFrame([(1, 2000, "mar", 300), (3, 2001, "x", 5)], "pid int, s int, fact_team string, minutes int")
    out = joins.attach_or_synthesise(career, facts, ["pid", "s"], "rid", [F.col("team") == F.col("fact_team")], ["minutes"])
    assert rows(out, "pid", "team", "minutes", "origin") == [(1, "mar", 300, "row"), (1, "rio", None, "row"), (2, "sol", None, "row"), (3, None, 5, "fact_only")]


def test_comparison_counts_only_shared_rows(spark):
    m = spark.createDataFrame([("a", 5.0, 1.0, None), ("b", 5.0, 3.0, 2.0)], "k string, x double, y double, z double")
    c = questions.compare_entities(m, "k", ["a", "b"], ["x", "y", "z"])
    assert rows(c, "metric", "leader", "shared") == [("x", None, True), ("y", "b", True), ("z", None, False)]
    assert rows(questions.comparison_score(c)) == [("b", 1), ("hole", 1), ("tie", 1)]


def test_longest_whole_word_mention(spark):
    docs = spark.createDataFrame([(1, "The Río Alto team, not Altos."), (2, "rioalto"), (3, "ALTO!")], "d int, t string")
    names = spark.createDataFrame([(10, "Alto"), (20, "Rio Alto"), (30, "zzz")], "i int, n string")
    assert rows(questions.mentions(docs, "d", "t", names, "n", "i", 2), "d", "longest_name", "entity_id", "n_names") == [(1, "rio alto", 20, 2), (3, "alto", 10, 1)]


def test_fragments_resolve_only_when_unique(spark):
    names = spark.createDataFrame([(1, "Ana Paz"), (2, "Ana"), (3, "Eva Paz"), (4, "Luz")], "i int, n string")
    got = rows(questions.fragment_match(names, "n", "i", ["ána", "paz", "eva", "uz", "none"]), "fragment", "status", "entity_id")
    assert got == [("eva", "prefix", 3), ("paz", "ambiguous", None), ("uz", "inside", 4), ("ána", "exact", 2)]


def test_no_day_falls_back_to_month_then_to_five(spark):
    df = spark.createDataFrame([(i, f"2000-03-{i:02d}") for i in range(1, 9)], "i int, d string")
    assert rows(questions.on_this_day(df, "d", 3, 4, "2001-01-01", [F.col("i")]), "i", "match") == [(4, "day")]
    assert questions.on_this_day(df, "d", 3, 30, "2001-01-01", [F.col("i")]).count() == 8
    assert rows(questions.on_this_day(df, "d", 5, 1, "2001-01-01", [F.col("i")]), "i", "match") == [(i, "first") for i in range(1, 6)]


def test_groups_without_key_keep_their_newest_batch(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, ts int")
    assert rows(dedup.latest_batch(df, ["k"], "ts")) == [(None, 2), ("a", 1)]
