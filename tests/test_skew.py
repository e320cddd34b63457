"""One key holds a third or more of the rows: results must equal a plain Python computation."""

import random
from bisect import bisect_left, bisect_right
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cartulary.operators import dedup, joins, skew, windows


@pytest.fixture(scope="module")
def hot(spark):
    rng = random.Random(7)
    data = []
    for i in range(6000):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rng.randrange(900)}")
        data.append((i, key, rng.randrange(400), rng.randrange(-500, 5000)))
    return data, spark.createDataFrame(data, "id long, key string, day int, v long").repartition(8)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_numbered_is_exact(hot, levels):
    data, df = hot
    buckets = [F.floor(F.col("day") / 30), F.col("day"), F.floor(F.col("id") / 100)][:levels]
    out = skew.numbered(df, ["key"], buckets, [F.col("day"), F.col("id")], "n", "total").collect()
    want = defaultdict(list)
    for i, k, d, _ in sorted(data, key=lambda r: (r[2], r[0])):
        want[k].append(i)
    assert len(out) == len(data)
    assert all(want[r.key][r.n - 1] == r.id and r.total == len(want[r.key]) for r in out)


def test_numbered_without_keys_numbers_the_whole_table(hot):
    data, df = hot
    out = skew.numbered(df, [], F.floor(F.col("day") / 30), [F.col("day"), F.col("id")], "n").collect()
    order = [r[0] for r in sorted(data, key=lambda r: (r[2], r[0]))]
    assert sorted((r.n, r.id) for r in out) == list(enumerate(order, 1))


def test_attach_totals_takes_the_hot_path_and_keeps_every_row(hot):
    data, df = hot
    out = skew.attach_totals(df, ["key"], {"s": F.sum("v"), "m": F.min("id")}).collect()
    s, m = defaultdict(int), {}
    for i, k, _, v in data:
        s[k] += v
        m[k] = min(m.get(k, i), i)
    assert sorted(r.id for r in out) == [r[0] for r in data]
    assert all(r.s == s[r.key] and r.m == m[r.key] for r in out)


@pytest.mark.parametrize("levels", [1, 2])
def test_fill_down_crosses_buckets(hot, levels):
    data, df = hot
    buckets = [F.floor(F.col("day") / 20), F.col("day")][:levels]
    marked = df.withColumn("mark", F.when(F.col("id") % 7 == 0, F.col("id")))
    out = {r.id: r.label for r in skew.fill_down(marked, ["key"], buckets, ["day", "id"], "mark", "label").collect()}
    last = {}
    for i, k, _, _ in sorted(data, key=lambda r: (r[2], r[0])):
        if i % 7 == 0:
            last[k] = i
        assert out[i] == last.get(k)


def test_date_tolerance_matches_brute_force(hot):
    data, df = hot
    dated = df.withColumn("on", F.date_add(F.lit("2020-01-01").cast("date"), F.col("day"))).where("key IS NOT NULL")
    out = joins.date_tolerance(dated, dated, ["key"], "on", "id", 7).collect()
    days = defaultdict(list)
    for i, k, d, _ in data:
        days[k].append(d)
    for v in days.values():
        v.sort()
    assert len(out) == sum(1 for r in data if r[1] is not None)
    for r in out:
        v = days[r.key]
        assert r.n_near == bisect_right(v, r.day + 7) - bisect_left(v, r.day - 7)


def test_span_corroboration_matches_brute_force(hot, spark):
    data, df = hot
    rng = random.Random(3)
    cands = [("hot" if i % 3 == 0 else f"k{rng.randrange(900)}", i, lo, lo + rng.randrange(4)) for i in range(600) for lo in [rng.randrange(400)]]
    spans = spark.createDataFrame(cands, "key string, who long, lo int, hi int")
    out = joins.span_corroboration(df.where("key IS NOT NULL"), spans, "key", "day", "who", "lo", "hi").collect()
    by = defaultdict(list)
    for k, i, lo, hi in cands:
        by[k].append((i, lo, hi))
    for r in out:
        fit = [i for i, lo, hi in by[r.key] if lo - 1 <= r.day <= hi + 1]
        assert r.n_in_span == len(fit)
        assert r.survivor_id == (fit[0] if len(fit) == 1 else None)


def test_comparable_counts_match_brute_force(hot):
    data, df = hot
    some = df.where("key IS NOT NULL").where("id % 4 = 0")
    out = joins.comparable_counts(some, "key", "v", "id", width=300).collect()
    by = defaultdict(list)
    for i, k, _, v in data:
        if k is not None and i % 4 == 0:
            by[k].append(v)
    for r in out:
        far = [y for y in by[r.key] if abs(y - r.v) >= 100 and abs(y - r.v) * 50 >= max(y, r.v)]
        assert (r.n_below, r.n_above) == (sum(y < r.v for y in far), sum(y > r.v for y in far))


def test_shared_rank(hot):
    data, df = hot
    out = windows.shared_rank(df.groupBy("v").agg(F.count("*").alias("n")), "n").collect()
    counts = [r.n for r in out]
    assert all(r.place == 1 + sum(c > r.n for c in counts) for r in out)


def test_digest_representative_for_a_hot_copy_group(spark):
    df = spark.createDataFrame([(i, "same" if i % 2 else f"t{i}") for i in range(4000)], "id long, body string")
    out = dedup.digest_representative(df, "body", "id").collect()
    assert len(out) == 4000
    assert {(r.representative, r.n_copies) for r in out if r.id % 2} == {(1, 2000)}
    assert all(r.representative == r.id and r.n_copies == 1 for r in out if r.id % 2 == 0)


def test_top_k_limits_before_the_shuffle(hot):
    plan = skew.top_k(hot[1], ["key"], [F.col("v").desc(), F.col("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_unknown_measures_have_no_place(spark):
    df = spark.createDataFrame([(10,), (5,), (None,), (None,), (5,)], "m int")
    assert sorted(((r["m"], r["place"]) for r in windows.shared_rank(df, "m").collect()), key=str) == [(10, 1), (5, 2), (5, 2), (None, None), (None, None)]


def test_unknown_values_are_compared_with_nothing(spark):
    df = spark.createDataFrame([(1, "g", 100), (2, "g", None), (3, "g", 500)], "id int, grp string, v long")
    got = {r["id"]: (r["n_below"], r["n_above"]) for r in joins.comparable_counts(df, "grp", "v", "id").collect()}
    assert got == {1: (0, 1), 2: (None, None), 3: (1, 0)}
