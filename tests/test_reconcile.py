"""Folds and reconciliation on small ledgers, with the invariants every one of them keeps."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from cartulary.operators import reconcile

CAREER = "pid long, season int, team string, games int, points int, source string, url string"
LEDGER = [
    (1, 2005, "Rayos, Rio", 20, 300, "main", "u1"), (1, 2005, "RIO", 20, 300, "extra", "j1"),          # equal twin: folded
    (2, 2005, "Rayos, Rio", 20, 300, "main", "u2"), (2, 2005, "RIO", 20, 301, "extra", "j2"),          # differing twin: conflict
    (3, 2005, "Rayos, Rio", 9, 90, "main", "u3"), (3, 2005, "Osos, Rio", 9, 90, "extra", "j3"),        # two named clubs: never
    (4, 2005, "Rayos, Rio", None, None, "main", "u4"), (4, 2005, "RIO", None, None, "extra", "j4"),    # unknown = unknown
    (5, 2005, "Rayos, Rio", 0, 0, "main", "u5"), (5, 2005, "RIO", None, None, "extra", "j5"),          # unknown is not zero
    (6, 2005, "Rayos, Rio", 9, 90, "main", "u6"), (6, 2005, "Osos, Mar", 9, 90, "extra", "j6"),        # trade, equal stats: other city
    (7, 2005, "RIO", 9, 90, "extra", "j7"), (7, 2005, "Rayos, Rio", 9, 90, "extra", "j8"),                # one source: never
    (8, 2005, "RIO", 5, 50, "main", "u8"), (8, 2005, "Osos, Rio", 5, 50, "extra", "j9"),               # bare city names no club
]


def nick():
    return F.when(F.col("team").contains(","), F.substring_index("team", ",", 1)).otherwise("")


def fold(df):
    return reconcile.fold_cross_source(df, "pid", "season", "team", ["games", "points"], "source", "extra", nick())


@pytest.fixture(scope="module")
def ledger(spark):
    return spark.createDataFrame(LEDGER, CAREER)


def test_fold_rules(ledger):
    f = fold(ledger)
    assert rows(f.merged, "url") == [("j1",), ("j4",), ("j9",)]
    assert rows(f.conflicts, "url", "url_kept") == [("j2", "u2"), ("j5", "u5")]
    assert f.kept.count() + f.merged.count() == len(LEDGER)


def test_fold_ignores_input_order_and_is_idempotent(spark, ledger):
    shuffled = LEDGER[:]
    random.Random(5).shuffle(shuffled)
    a, b = fold(ledger), fold(spark.createDataFrame(shuffled, CAREER))
    assert rows(a.kept) == rows(b.kept) and rows(a.merged) == rows(b.merged)
    again = fold(a.kept)
    assert rows(again.kept) == rows(a.kept) and again.merged.count() == 0


def test_season_totals(spark):
    data = [(1, 2005, 10, 100, "main"), (1, 2005, 5, 40, "main"), (1, 2005, 15, 140, "extra"),      # the sum
            (2, 2005, 10, 100, "main"), (2, 2005, 5, 40, "main"), (2, 2005, 15, 141, "extra"),      # only games equal
            (3, 2005, 15, 140, "main"), (3, 2005, 15, 140, "extra"),                                 # one row only
            (4, 2005, 15, 140, "main"), (4, 2005, 0, 0, "main"), (4, 2005, 15, 140, "extra"),       # equals a single row
            (5, 2005, 10, 100, "main"), (5, 2005, None, 40, "main"), (5, 2005, 10, 140, "extra")]   # a blank figure
    df = spark.createDataFrame(data, "pid int, season int, games int, points int, source string")
    s = reconcile.fold_totals(df, ["pid", "season"], ["games", "points"], "source", "main", "extra")
    assert rows(s.dropped, "pid", "n_parts") == [(1, 2)]
    assert s.kept.count() == len(data) - 1
    again = reconcile.fold_totals(s.kept, ["pid", "season"], ["games", "points"], "source", "main", "extra")
    assert again.dropped.count() == 0


def test_listed_rows_need_the_full_key_and_the_second_source(spark):
    df = spark.createDataFrame([(1, 2005, "A", None, "extra"), (1, 2005, "A", 3, "extra"), (1, 2005, "A", None, "main")],
                               "pid int, season int, team string, games int, source string")
    listed = spark.createDataFrame([(1, 2005, "A", None, "e1"), (9, 2005, "A", 1, "e2")], "pid int, season int, team string, games int, evidence string")
    d = reconcile.drop_listed(df, listed, ["pid", "season", "team", "games"], F.col("source") == "extra")
    assert rows(d.dropped, "source", "evidence") == [("extra", "e1")]
    assert d.kept.count() == 2 and rows(d.stale, "evidence") == [("e2",)]


def test_relabel_is_logged_and_idempotent(spark):
    from cartulary.functions.dates import relabelled_season

    df = spark.createDataFrame([(2005, "20060224000000"), (2005, "20060501000000"), (2004, "20070101000000"), (2005, "")], "season int, cap string")
    r = reconcile.relabel(df, "season", relabelled_season("season", "cap", 2005, "20060501000000"))
    assert rows(r.log, "season", "season_new") == [(2005, 2006)]
    assert reconcile.relabel(r.rows, "season", relabelled_season("season", "cap", 2005, "20060501000000")).log.count() == 0


def test_two_sources(spark):
    seed = spark.createDataFrame([("1950", "a", "b"), ("1951", "a", "b"), ("1952", "a", "b"), ("1953", "", None), ("1954", "a", "b"), ("1942-1943", "c", None)],
                                 "season string, champion string, runner_up string")
    other = spark.createDataFrame([("1950", "a", "b", False), ("1951", "x", "b", False), ("1953", None, None, True), ("1954", "a", "y", False), ("1955", "q", "r", False)],
                                  "season string, champion string, runner_up string, no_champion boolean")
    ruled = spark.createDataFrame([("runner_up", "1954", "b", "single-source")], "slot string, season string, value string, confidence string")
    r = reconcile.reconcile_two(seed, other, ["season"], ["champion", "runner_up"], "no_champion", ruled)
    got = {x.season: (x.status, x.champion, x.runner_up, x.confidence) for x in r.rows.collect()}
    assert got == {
        "1950": ("agree", "a", "b", "verified"),
        "1951": ("conflict", None, "b", "disputed"),           # the undisputed slot keeps its value
        "1952": ("first_only", "a", "b", "single-source"),
        "1953": ("no_result", None, None, "single-source"),
        "1954": ("agree", "a", "b", "single-source"),          # an owner ruling supersedes the conflict
        "1955": ("second_only", "q", "r", "single-source"),
        "1942-1943": ("first_only", "c", None, "single-source")}
    assert rows(r.conflicts) == [("1951", "champion", "a", "x")]


def test_three_sources(spark):
    def src(*r):
        return spark.createDataFrame(list(r), "season int, player string"), "player"

    dual = spark.createDataFrame([(1971,)], "season int")
    out = reconcile.reconcile_three({"seed": src((1960, "Ana Paz"), (1961, "Ana Paz"), (1971, "Eva Sol")),
                                     "ledger": src((1960, "PAZ, Ana M."), (1961, "Luz, Ana"), (1971, "Paz, Ana")),
                                     "board": src((1962, "Paz, Ana"), (1963, ""))}, "season", dual)
    assert rows(out, "season", "agreement", "confidence") == [
        (1960, "agree", "verified"), (1961, "conflict", "disputed"), (1962, "board_only", "single-source"),
        (1963, "none", "single-source"), (1971, "dual_metric", "verified")]


def test_overrides_only_while_the_old_value_holds(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, "z")], "pid int, dob string")
    o = spark.createDataFrame([(1, "x", "n"), (2, "old", "n"), (3, None, "n"), (4, "z", None)], "pid int, old_value string, new_value string")
    r = reconcile.compare_and_set(df, o, "pid", "dob")
    assert rows(r.rows) == [(1, "n"), (2, "y"), (3, "n"), (4, None)]
    assert rows(r.stale, "pid", "found") == [(2, "y")] and r.applied.count() == 3


def test_repair_touches_only_damaged_rows(spark):
    df = spark.createDataFrame([(1, "PeÃ±a", None), (2, "PeÃ±a", 7), (3, "Peña", None), (4, "Ã", None)], "k int, name string, pid long")
    r = reconcile.repair_overlay(df, "name", "pid", lambda d: d.withColumn("resolved_id", F.lit(99)))
    assert rows(r.rows) == [(1, "Peña", 99), (2, "Peña", 7), (3, "Peña", None), (4, "Ã", None)]
    assert rows(r.log, "k", "text_before", "id_before") == [(1, "PeÃ±a", None), (2, "PeÃ±a", 7)]
    before = reconcile.table_digest(df.where("k > 2")).collect()
    assert reconcile.table_digest(r.untouched).collect() == before


def test_table_digest_ignores_order_and_sees_null(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(2, "x"), (1, None)], "k int, v string")
    c = spark.createDataFrame([(1, ""), (2, "x")], "k int, v string")
    assert reconcile.table_digest(a).collect() == reconcile.table_digest(b).collect() != reconcile.table_digest(c).collect()


def test_lineage_and_overlay(spark):
    e = spark.createDataFrame([("a", "b", 1950), ("c", "c", 1960), (None, "a", 1940)], "src string, dst string, season int")
    assert rows(reconcile.lineage(e, "src", "dst"), "franchise", "season") == [("a", 1940), ("a", 1950), ("b", 1950), ("c", 1960)]
    cur = spark.createDataFrame([(1, 1930, [1950], "kept"), (2, 1940, [], "kept")], "k int, founded int, won array<int>, color string")
    built = spark.createDataFrame([(1, 1931, [1949, 1950])], "k int, founded int, won array<int>")
    assert rows(reconcile.overlay_facts(cur, built, "k", ["founded"], ["won"])) == [(1, 1931, [1949, 1950], "kept"), (2, 1940, [], "kept")]


def test_rows_of_unknown_source_stay(spark):
    df = spark.createDataFrame([(1, 2000, "rio", 5, 50, None), (1, 2000, "rio", 5, 50, "extra"), (2, 2000, "mar", 1, 2, None)],
                               "pid int, season int, team string, games int, points int, source string")
    out = reconcile.fold_cross_source(df, "pid", "season", "team", ["games", "points"], "source", "extra", nick())
    assert out.kept.count() == 2 and out.merged.count() == 1 and out.conflicts.count() == 0
