"""Aggregations and windows over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import aggregates, windows
from ..operators.skew import top_k
from ..session import written
from .base import query

MONEY = "decimal(18,2)"
ID_RANGE = 65536  # rows one numbering bucket can hold, as ids are unique


def month_index(c):
    return F.year(c) * 12 + F.month(c) - 1


def nation_months(t):
    """Revenue per customer nation and month, the archive's season ledger of the test tables."""
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(month_index("o_orderdate").alias("m"), F.col("c_nationkey").alias("nation"))
            .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("revenue"), F.count("*").alias("n_orders")))


def monthly_finals(t):
    """Top two nations of each month as winner and runner-up."""
    ranked = top_k(nation_months(t), ["m"], [F.col("revenue").desc(), F.col("nation")], 2, rank_col="r")
    return ranked.groupBy("m").agg(F.max(F.when(F.col("r") == 1, F.col("nation"))).alias("winner"),
                                   F.max(F.when(F.col("r") == 2, F.col("nation"))).alias("runner_up"))


NATION_MONTHS = """nm AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m, c_nationkey AS nation,
   sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue, count(*) AS n_orders
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
FINALS = NATION_MONTHS + """,
 rk AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY revenue DESC, nation) AS r FROM nm),
 fin AS (SELECT m, max(nation) FILTER (WHERE r = 1) AS winner, max(nation) FILTER (WHERE r = 2) AS runner_up FROM rk GROUP BY m)"""


def games(t):
    """Orders 2k and 2k+1 as a contest between their customers' nations."""
    o = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .select(F.floor(F.col("o_orderkey") / 2).alias("game"), (F.col("o_orderkey") % 2).alias("side"),
                 F.year("o_orderdate").alias("season"), F.col("c_nationkey").alias("nation"),
                 F.floor(F.col("o_totalprice") / 1000).alias("score")))

    def of(side, c):
        return F.max(F.when(F.col("side") == side, F.col(c)))

    return (o.groupBy("game").agg(of(0, "season").alias("season"), of(0, "nation").alias("team_a"),
                                  of(0, "score").alias("score_a"), of(1, "nation").alias("team_b"),
                                  of(1, "score").alias("score_b")))


GAMES = """o AS (SELECT o_orderkey // 2 AS game, o_orderkey % 2 AS side, year(o_orderdate) AS season, c_nationkey AS nation,
   CAST(floor(o_totalprice / 1000) AS BIGINT) AS score FROM orders JOIN customer ON o_custkey = c_custkey),
 g AS (SELECT a.game, a.season, a.nation AS team_a, a.score AS score_a, b.nation AS team_b, b.score AS score_b
  FROM o a JOIN o b ON a.game = b.game AND a.side = 0 AND b.side = 1),
 s AS (SELECT season, team_a AS team, score_a > score_b AS won FROM g UNION ALL SELECT season, team_b, score_b > score_a FROM g),
 st AS (SELECT season, team, count(*) FILTER (WHERE won) AS wins, count(*) FILTER (WHERE NOT won) AS losses FROM s GROUP BY ALL)"""


@query("standings", f"""
WITH {GAMES}
SELECT *, CAST(row_number() OVER (PARTITION BY season ORDER BY wins / (wins + losses) DESC, wins DESC, team) AS INT) AS position FROM st
""")
def standings(t):
    return aggregates.standings_from_games(games(t), "season", "team_a", "score_a", "team_b", "score_b")


@query("precedence_totals", f"""
WITH {GAMES}, n AS (SELECT season, count(*) AS n FROM g GROUP BY season),
 x AS (SELECT year(o_orderdate) AS season, count(*) AS listed FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
 a AS (SELECT season, team, wins, 0 AS source_rank FROM st WHERE season IN (SELECT season FROM n JOIN x USING (season) WHERE 40 * n.n >= 19 * x.listed)),
 b AS (SELECT year(o_orderdate) AS season, c_nationkey AS team, count(*) AS wins, 1 AS source_rank
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
FROM a UNION ALL SELECT * FROM b WHERE season NOT IN (SELECT season FROM a)
""")
def precedence_totals(t):
    played = written(aggregates.standings_from_games(games(t), "season", "team_a", "score_a", "team_b", "score_b").select(
        "season", "team", "wins", "losses"))
    listed = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
              .groupBy(F.year("o_orderdate").alias("season"), F.col("c_nationkey").alias("team"))
              .agg(F.count("*").alias("wins")))
    sides = listed.groupBy("season").agg(F.sum("wins").alias("listed"))  # a contest has two; complete is 95 % of them
    complete = 20 * F.sum(F.col("wins") + F.col("losses")) >= 19 * F.max("listed")
    return aggregates.preferred_source([played.join(sides, "season"), listed], ["season"], [complete, None]).drop("losses", "listed")


@query("top5_lines", """
WITH b AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS game, p_brand AS team, p_name || ' ' || p_partkey AS raw, p_size > 3 AS known,
   CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_partkey END AS member, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
   l_quantity AS points FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
 m AS (SELECT game, team, raw, known, member, coalesce(member::VARCHAR, 'raw:' || raw) AS who, max(price) AS price, CAST(max(points) AS INT) AS points FROM b GROUP BY ALL),
 t5 AS (SELECT *, member IS NOT NULL AND known AS ok FROM m QUALIFY row_number() OVER (PARTITION BY game, team ORDER BY price DESC, member NULLS LAST, who) <= 5),
 w AS (SELECT * FROM t5 QUALIFY count(*) OVER (PARTITION BY game, team) = 5),
 sup AS (SELECT team, count(DISTINCT game) AS n_games, avg(ok::INT) AS share FROM w GROUP BY team HAVING count(DISTINCT game) >= 15 AND count(*) FILTER (WHERE ok) >= count(*) * 0.6),
 f AS (SELECT team, who, bool_or(ok) AS ok, count(*) AS n_starts, avg(points) AS mean_points FROM w GROUP BY ALL),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY team ORDER BY n_starts DESC, who) AS INT) AS slot FROM f QUALIFY slot <= 5)
SELECT team, who AS member, n_starts, round(mean_points, 4) AS mean_points, n_games, round(share, 6) AS resolved_share, slot,
  count(*) FILTER (WHERE ok) OVER (PARTITION BY team) AS n_resolved FROM r JOIN sup USING (team)
""")
def top5_lines(t):
    box = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
           .groupBy(month_index("o_orderdate").alias("game"), F.col("p_brand").alias("team"), F.concat_ws(" ", "p_name", "p_partkey").alias("raw"),
                    (F.col("p_size") > 3).alias("known"), F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey")).alias("member"))
           .agg(F.max(F.col("l_extendedprice").cast(MONEY)).alias("price"),
                F.max("l_quantity").cast("int").alias("points")))
    return (aggregates.inferred_lineups(box, ["game"], ["team"], "member", "price", "points", "raw", known=F.col("known"))
            .withColumns({"mean_points": F.round("mean_points", 4), "resolved_share": F.round("resolved_share", 6)}))


EVENT_TYPES = ("signup", "purchase", "error", "view", "click")


@query("type_matrix", """
SELECT strftime(ts, '%Y-%m-%d') AS day, """ + ", ".join(
    f"CAST(max(CASE WHEN event_type = '{e}' THEN CAST(value > 60 AS INT) END) AS INT) AS {e}" for e in EVENT_TYPES) + """
FROM events GROUP BY 1
""")
def type_matrix(t):
    e = t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "value")
    return aggregates.tracked_matrix(e, "day", "event_type", EVENT_TYPES, F.col("value") > 60)


@query("coverage_by_month", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
 a AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderpriority = '1-URGENT'),
 b AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_totalprice > 450000),
 c AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_discount = 0),
 e AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_quantity = 50),
 f AS (SELECT strftime(day, '%Y-%m') AS bucket, count(*) AS n_periods, count(*) FILTER (WHERE day IN (FROM a)) AS urgent,
   count(*) FILTER (WHERE day IN (FROM b)) AS big, count(*) FILTER (WHERE day IN (FROM c)) AS full_price,
   count(*) FILTER (WHERE day IN (FROM e)) AS bulk FROM d GROUP BY 1)
SELECT *, round((urgent + big + full_price + bulk) * 100 / (n_periods * 4), 1) AS coverage_pct FROM f
""")
def coverage_by_month(t):
    def days(df, c):
        return df.select(F.col(c).cast("date").alias("day"))

    return aggregates.coverage(days(t.orders, "o_orderdate"), "day", {
        "urgent": days(t.orders.where(F.col("o_orderpriority") == "1-URGENT"), "o_orderdate"),
        "big": days(t.orders.where(F.col("o_totalprice") > 450000), "o_orderdate"),
        "full_price": days(t.lineitem.where(F.col("l_discount") == 0), "l_shipdate"),
        "bulk": days(t.lineitem.where(F.col("l_quantity") == 50), "l_shipdate"),
    }, F.date_format("day", "yyyy-MM"))


@query("page_inventory", r"""
SELECT lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) AS host, count(*) AS n_captures,
  count(*) FILTER (WHERE html LIKE '%<title>%') AS n_ok, count(DISTINCT md5(html)) AS n_digests,
  count(DISTINCT nullif(regexp_extract(url, '\?([^#]*)', 1), '')) AS n_variants, min(page_id) AS first_seen, max(page_id) AS last_seen
FROM pages GROUP BY 1
""")
def page_inventory(t):
    q = F.nullif(urls.query_string("url"), F.lit(""))
    p = t.pages.withColumn("host", urls.host("url"))
    return aggregates.capture_inventory(p, ["host"], F.contains(F.col("html"), F.lit("<title>")), F.md5("html"), "page_id", q)


@query("status_histogram", """
WITH c AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_orderpriority, string_agg(o_orderstatus || '=' || n, ',' ORDER BY o_orderstatus) AS histogram FROM c GROUP BY 1
""")
def status_histogram(t):
    h = aggregates.status_histogram(t.orders, ["o_orderpriority"], "o_orderstatus")
    text = F.array_join(F.transform(F.map_entries("histogram"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return h.select("o_orderpriority", text.alias("histogram"))


@query("best_status", """
WITH sp AS (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))::DATE AS day FROM orders),
 f AS (SELECT CAST(o_orderdate AS DATE) AS day, bool_or(o_orderstatus = 'F') AS f, bool_or(o_orderstatus = 'O') AS o,
   bool_or(o_orderstatus = 'P') AS p FROM orders GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d') AS day, CASE WHEN f THEN 'finished' WHEN o THEN 'open' WHEN p THEN 'pending' ELSE 'absent' END AS status
FROM sp LEFT JOIN f USING (day)
""")
def best_status(t):
    spine = t.orders.agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("day"))
    rows = t.orders.withColumn("day", F.col("o_orderdate").cast("date"))
    s = F.col("o_orderstatus")
    return (aggregates.best_status(spine, rows, "day", [("finished", s == "F"), ("open", s == "O"), ("pending", s == "P")])
            .withColumn("day", F.date_format("day", "yyyy-MM-dd")))


@query("active_ranges", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) - DATE '1970-01-01' AS day FROM events),
 i AS (SELECT user_id, min(day) AS a, max(day) AS b FROM (SELECT *, day - row_number() OVER (PARTITION BY user_id ORDER BY day) AS g FROM d)
   GROUP BY user_id, g)
SELECT user_id, count(*) AS n_ranges, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ', ' ORDER BY a) AS ranges
FROM i GROUP BY user_id
""")
def active_ranges(t):
    days = t.events.select("user_id", F.unix_date(F.col("ts").cast("date")).alias("day"))
    return aggregates.compact_ranges(days, ["user_id"], "day")


@query("nation_titles", f"""
WITH {FINALS}, s AS (SELECT m, winner AS club, true AS won FROM fin UNION ALL SELECT m, runner_up, false FROM fin)
SELECT club, count(*) FILTER (WHERE won) AS titles, count(*) FILTER (WHERE NOT won) AS finals_lost, count(*) AS finals,
  max(m) FILTER (WHERE won) AS last_title, round(count(*) FILTER (WHERE won) * 100 / count(*), 1) AS win_pct,
  (SELECT max(m) FROM fin) - max(m) FILTER (WHERE won) AS drought
FROM s WHERE club IS NOT NULL GROUP BY club
""")
def nation_titles(t):
    return aggregates.title_summary(monthly_finals(t), "m", "winner", "runner_up")


@query("unflagged_totals", """
SELECT o_custkey, sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_returnflag <> 'R')::BIGINT AS quantity,
  count(DISTINCT year(l_shipdate)) FILTER (WHERE l_returnflag <> 'R') AS n_periods,
  min(year(l_shipdate)) FILTER (WHERE l_returnflag <> 'R') AS first_period,
  max(year(l_shipdate)) FILTER (WHERE l_returnflag <> 'R') AS last_period, count(*) FILTER (WHERE l_returnflag = 'R') AS n_flagged
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey
""")
def unflagged_totals(t):
    rows = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select("o_custkey", F.col("l_quantity").cast("long").alias("quantity"), F.year("l_shipdate").alias("season"),
                    "l_returnflag"))
    return aggregates.totals_without_flagged(rows, ["o_custkey"], F.col("l_returnflag") == "R", ["quantity"], "season")


@query("conflict_split", """
WITH l AS (SELECT l_orderkey, count(*) AS n, max(l_linenumber) AS top FROM lineitem GROUP BY 1)
SELECT o_orderstatus, CASE WHEN n = o_orderkey % 8 AND top = 7 THEN 'equal' WHEN n = o_orderkey % 8 THEN 'second_differs'
  WHEN top = 7 THEN 'first_differs' ELSE 'both_differ' END AS kind, count(*) AS n_rows
FROM orders JOIN l ON l_orderkey = o_orderkey GROUP BY ALL
""")
def conflict_split(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.max("l_linenumber").alias("top"))
    both = (t.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
            .withColumns({"n_b": F.col("o_orderkey") % 8, "top_b": F.lit(7)}))
    return aggregates.conflict_split(both, ["o_orderstatus"], ("n", "top"), ("n_b", "top_b"))


@query("leaders_by_month", """
WITH r AS (SELECT event_type, week(ts) AS wk, event_id, CAST(round(value * -100) AS BIGINT) AS rank FROM events),
 t AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY event_type, wk ORDER BY rank, event_id) <= 5)
SELECT event_type, wk, string_agg(event_id || ':' || rank, ' ' ORDER BY rank, event_id) AS leaders FROM t GROUP BY ALL
""")
def leaders_by_month(t):
    rows = t.events.select("event_type", F.weekofyear("ts").cast("long").alias("wk"), "event_id",
                           F.round(F.col("value") * -100).cast("long").alias("rank"))
    even, odd = rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")
    out = aggregates.season_leaders([even, odd], ["event_type", "wk"], "rank", "event_id", 5)
    text = F.array_join(F.transform("leaders", lambda x: F.concat_ws(":", x["event_id"], x["rank"])), " ")
    return out.select("event_type", "wk", text.alias("leaders"))


@query("source_counts", """
SELECT source, count(*) AS n_rows, count(DISTINCT lang) AS n_langs, count(DISTINCT md5(text)) AS n_contents FROM documents GROUP BY source
""")
def source_counts(t):
    d = t.documents.select("source", "lang", F.md5("text").alias("digest"))
    return aggregates.entity_counts(d, ["source"], {"n_langs": "lang", "n_contents": "digest"})


@query("order_margins", """
WITH a AS (SELECT l_orderkey, CAST(round(avg(CAST(l_quantity AS INT)), 2) AS DOUBLE) AS mean_qty FROM lineitem GROUP BY 1),
 n AS (SELECT l_orderkey, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL),
 m AS (FROM n QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, l_linestatus) = 1)
SELECT l_orderkey, m.l_linestatus AS modal_status, m.n AS n_modal, round(max(l_quantity - mean_qty), 2) AS widest_margin
FROM lineitem l JOIN a USING (l_orderkey) JOIN m USING (l_orderkey) GROUP BY ALL
""")
def order_margins(t):
    lines = t.lineitem.select("l_orderkey", "l_quantity", "l_linestatus")
    mean = lines.groupBy("l_orderkey").agg(F.round(F.avg(F.col("l_quantity").cast("int")), 2).alias("mean_qty"))
    mode = aggregates.modal_value(lines, ["l_orderkey"], "l_linestatus").withColumnRenamed("l_linestatus", "modal_status")
    wide = (aggregates.margins(lines, mean, ["l_orderkey"], "l_quantity", "mean_qty")
            .groupBy("l_orderkey").agg(F.round(F.max("margin"), 2).alias("widest_margin")))
    return wide.join(mode, "l_orderkey")


# --- windows ---------------------------------------------------------------

@query("winner_streaks", """
WITH n AS (SELECT CAST(ts AS DATE) - DATE '1970-01-01' AS day, event_type, count(*) AS n FROM events GROUP BY ALL),
 w AS (SELECT day, event_type FROM n QUALIFY row_number() OVER (PARTITION BY day ORDER BY n DESC, event_type) = 1)
SELECT event_type, min(day) AS run_start, max(day) AS run_end, count(*) AS run_length
FROM (SELECT *, day - row_number() OVER (PARTITION BY event_type ORDER BY day) AS g FROM w) GROUP BY event_type, g HAVING count(*) >= 2
""")
def winner_streaks(t):
    n = (t.events.groupBy(F.unix_date(F.col("ts").cast("date")).alias("day"), "event_type").agg(F.count("*").alias("n")))
    daily = top_k(n, ["day"], [F.col("n").desc(), F.col("event_type")])
    return (windows.consecutive_runs(daily, ["event_type"], "day")
            .select("event_type", "run_start", "run_end", "run_length"))


@query("holder_streaks", f"""
WITH {FINALS}
SELECT m, winner, CAST(row_number() OVER (PARTITION BY winner, g ORDER BY m) AS INT) AS streak
FROM (SELECT *, m - row_number() OVER (PARTITION BY winner ORDER BY m) AS g FROM fin)
""")
def holder_streaks(t):
    return windows.holder_streaks(monthly_finals(t).select("m", "winner"), [], "m", "winner")


@query("shared_rank", """
WITH c AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT o_custkey, n_orders, rank() OVER (ORDER BY n_orders DESC) AS place FROM c
""")
def shared_rank(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    return windows.shared_rank(counts, "n_orders")


@query("games_behind", f"""
WITH {GAMES}, x AS (SELECT season, team, wins, losses, row_number() OVER (PARTITION BY season ORDER BY wins DESC, losses, team) AS p FROM st),
 l AS (SELECT season, wins AS lw, losses AS ll FROM x WHERE p = 1)
SELECT season, team, wins, losses, ((lw - wins) + (losses - ll)) / 2 AS games_behind FROM x JOIN l USING (season)
""")
def games_behind(t):
    table = aggregates.standings_from_games(games(t), "season", "team_a", "score_a", "team_b", "score_b").drop("position")
    return windows.games_behind(table, ["season"], "wins", "losses",
                                [F.col("wins").desc(), F.col("losses"), F.col("team")])


@query("month_over_month", """
WITH s AS (SELECT c_mktsegment, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_mktsegment, m, CAST(revenue AS DOUBLE) AS revenue,
  CAST(revenue - lag(revenue) OVER (PARTITION BY c_mktsegment ORDER BY m) AS DOUBLE) AS change FROM s
""")
def month_over_month(t):
    s = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .groupBy("c_mktsegment", month_index("o_orderdate").alias("m"))
         .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("revenue")))
    return (windows.change_from_previous(s, ["c_mktsegment"], ["m"], {"change": "revenue"})
            .withColumns({"revenue": F.col("revenue").cast("double"), "change": F.col("change").cast("double")}))


@query("nth_order", """
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS ordinal,
  count(*) OVER (PARTITION BY o_custkey) AS n_total FROM orders
""")
def nth_order(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return windows.nth_occurrence(o, ["o_custkey"], [F.col("o_orderdate"), F.floor(F.col("o_orderkey") / ID_RANGE)],
                                  [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


@query("top3_parts_per_brand", """
SELECT p_brand, p_partkey, p_retailprice, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS INT) AS place
FROM part QUALIFY place <= 3
""")
def top3_parts_per_brand(t):
    p = t.part.select("p_brand", "p_partkey", "p_retailprice")
    return windows.top_k(p, ["p_brand"], [F.col("p_retailprice").desc(), F.col("p_partkey")], 3, rank_col="place")


@query("line_contiguity", """
WITH p AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
 g AS (SELECT l_orderkey, count(*) AS n_positions, CAST(max(l_linenumber) AS BIGINT) AS max_position,
  CAST(min(l_linenumber) AS BIGINT) AS min_position, sum(n - 1)::BIGINT AS n_duplicates FROM p GROUP BY 1)
SELECT *, CAST(n_positions = max_position AND min_position = 1 AND n_duplicates = 0 AS INT) AS contiguous FROM g
""")
def line_contiguity(t):
    return (windows.rank_contiguity(t.lineitem, ["l_orderkey"], "l_linenumber")
            .withColumn("contiguous", F.col("contiguous").cast("int")))


@query("share_of_max", """
SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 10 = 0 THEN 0.0 ELSE round(greatest(0.02, s_acctbal /
  max(CASE WHEN s_suppkey % 10 > 0 THEN s_acctbal END) OVER (PARTITION BY s_nationkey)), 6) END::DOUBLE AS share_of_max FROM supplier
""")
def share_of_max(t):
    s = t.supplier.select("s_suppkey", "s_nationkey",
                          F.when(F.col("s_suppkey") % 10 > 0, F.col("s_acctbal")).alias("balance"))
    return (windows.share_of_max(s, ["s_nationkey"], "balance")
            .select("s_suppkey", "s_nationkey", F.round("share_of_max", 6).alias("share_of_max")))


@query("share_of_order", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) AS n, round(max(pct), 4) AS share_pct FROM (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) * 100.0 / CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY l_orderkey) AS DOUBLE) AS pct
  FROM lineitem) GROUP BY ALL
""")
def share_of_order(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    shared = windows.share_of_group(lines, ["l_orderkey"], F.col("l_extendedprice").cast(MONEY).cast("decimal(18,2)"))
    return (shared.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
            .agg(F.count("*").alias("n"), F.round(F.max(F.col("share_pct").cast("double")), 4).alias("share_pct")))
