"""Queries on made-up tables of shapes that the small test tables lack, against their SQL, and how their plans join."""

import duckdb
import pytest

import __spark_entry__ as entry
from cartulary.sources import pages
from cartulary.streaming import state
from test_oracle import value

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def check(spark, folder, *names):
    """Each query over the tables of `folder` equals its SQL over them."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    for name in names:
        df = QUERIES[name](spark, str(folder))
        result = con.execute(ORACLES[name])
        at = [d[0] for d in result.description]
        want = sorted(tuple(value(r[at.index(c)]) for c in sorted(at)) for r in result.fetchall())
        got = sorted(tuple(value(r[c]) for c in sorted(at)) for r in df.collect())
        assert want and got == want


@pytest.fixture(scope="module")
def long_orders(tmp_path_factory):
    """Forty orders of 25 lines, so that games go on after their first overtime."""
    folder = tmp_path_factory.mktemp("long")
    duckdb.sql(f"""COPY (SELECT * REPLACE (row_number() OVER () // 25 AS l_orderkey) FROM (FROM '/root/testdata/sf0.001/lineitem.parquet' ORDER BY ALL LIMIT 1000))
      TO '{folder}/lineitem.parquet' (FORMAT parquet)""")
    return folder


@pytest.mark.parametrize("name", ["play_events", "court_stretches"])
def test_games_of_several_overtimes(spark, long_orders, name):
    check(spark, long_orders, name)


def joins_of(spark, name, sf="/root/testdata/sf0.001"):
    text = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    return text.count("BroadcastHashJoin"), text.count("SortMergeJoin")


@pytest.mark.parametrize("name,least", [("close_spellings", 3), ("match_tiers", 5), ("candidate_parts", 2)])
def test_exploded_keys_are_never_broadcast(spark, name, least):
    broadcast, merged = joins_of(spark, name)
    assert broadcast == 0 and merged >= least


def test_tables_leave_python_in_small_frames():
    rows = ((1, 0, i, [["a"] * 20] * 3, ["x"] * 20) for i in range(20000))
    frames = list(pages._frames(rows, ["page", "table_no", "row_no", "head", "cells"]))
    assert sum(map(len, frames)) == 20000 and max(map(len, frames)) * 80 <= pages.FRAME_CELLS + 80
    assert [r for f in frames for r in f["row_no"]] == list(range(20000))


def test_pages_reach_python_in_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    df = spark.range(1200).selectExpr("id", "'<table><tr><td>1</table>' AS html")
    assert pages.extract_tables(df, "id", "html").count() == 1200
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 500


def test_header_tree_is_worked_out_once_for_all_branches(spark):
    plan = QUERIES["modern_results"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" not in plan and "MapInPandas" not in plan


def test_streamed_states_stay_out_of_python(spark):
    s = spark.readStream.format("rate").load().selectExpr("value % 3 AS k", "value AS v", "timestamp AS ts")
    for updates in (state.latest_updates(s, ["k"], ["v"], ["ts"]), state.first_updates(s, "k", "v", "ts")):
        plan = updates._jdf.queryExecution().analyzed().toString()
        assert "Pandas" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["play_events", "court_stretches"])
def test_plays_are_told_once_for_all_branches(spark, name):
    """No branch reads headers or squishes cells again; a player's moves are ordered once."""
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Cuarto" not in plan and "array_distinct" not in plan and plan.count("lag(") <= 1
