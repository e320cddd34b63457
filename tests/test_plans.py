"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__  # noqa: F401  registers the queries
from cartulary.plans import base

SF = "/root/testdata/sf0.001"
QUERIES = base.QUERIES
#: Queries that parse HTML, the one thing Python does here; their cells are written once, then all is Spark's.
HTML = {"play_events", "court_stretches", "modern_results", "modern_players", "directory_people", "team_season_players", "team_season_totals", "roster_rows", "roster_pages"}
PYTHON = ("MapInPandas", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroups")


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    writes = {"resolve_obs", "enrich_mint_review", "fold_sources", "fold_merged_rows", "stream_dedup_events", "stream_latest_wins"}
    return {n: plan(spark, n) for n in QUERIES if n not in writes | HTML}


def test_no_query_forms_pairs(plans):
    bad = [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    assert bad == []


def test_registered_queries_stay_out_of_python(plans):
    assert [n for n, p in plans.items() if any(x in p for x in PYTHON)] == []


def nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def test_windows_over_a_whole_table_only_order_bucket_totals(spark, plans):
    """A window without a partition key runs in one task, so it may only see one row per bucket."""
    loose = []
    for name in (n for n, p in plans.items() if "SinglePartition" in p and "Window " in p):
        logical = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan()
        for node in nodes(logical):
            if node.nodeName() == "Window" and node.partitionSpec().isEmpty() and "__t_" not in node.child().output().toString():
                loose.append(name)
    assert loose == []


@pytest.mark.parametrize("name,columns,pushed", [
    ("scoped_orders", "o_orderkey,o_custkey,o_orderstatus,o_orderdate,o_orderpriority", "GreaterThanOrEqual(o_orderdate"),
    ("scan_orders", "o_orderkey,o_custkey,o_orderstatus,o_orderdate", None),
    ("recent_orders", "o_orderkey,o_orderdate", None),
    ("relabel_late", "o_orderkey,o_orderdate", None),
])
def test_scans_read_only_what_they_need(spark, name, columns, pushed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    df = QUERIES[name](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert sorted(re.findall(r"(\w+):", schema)) == sorted(columns.split(","))
    if pushed:
        assert pushed in p


@pytest.mark.parametrize("name", ["first_order", "top_lineitem", "ranked_pages", "top3_parts_per_brand", "fullest_doc"])
def test_group_limits_run_before_the_shuffle(plans, name):
    assert plans[name].count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["page_orders", "recent_orders", "qb_seasons", "global_search"])
def test_top_n_never_sorts_the_table(plans, name):
    assert "TakeOrderedAndProject" in plans[name]
