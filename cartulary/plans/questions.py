"""The archive's questions over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import questions as q
from ..operators.skew import top_k
from .base import query
from .summaries import FINALS, GAMES, MONEY, NATION_MONTHS, games, month_index, monthly_finals, nation_months


@query("winner_of_month", f"""
WITH {FINALS}, n AS (SELECT *, CAST(row_number() OVER (PARTITION BY winner ORDER BY m) AS INT) AS nth_title FROM fin)
SELECT m, winner, runner_up, nth_title FROM n WHERE m = 1998 * 12 + 5
""")
def winner_of_month(t):
    return q.champion_of(monthly_finals(t), "m", 1998 * 12 + 5, "winner", "runner_up")


@query("period_summary", f"""
WITH {FINALS}, p AS (SELECT CAST(floor(m / 12) AS BIGINT) AS bucket, winner, count(*) AS titles FROM fin GROUP BY ALL),
 s AS (SELECT bucket, count(*) AS n_winners, sum(titles)::BIGINT AS n_periods FROM p GROUP BY 1)
SELECT bucket, winner, titles, n_winners, n_periods FROM p JOIN s USING (bucket)
QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY titles DESC, winner) = 1
""")
def period_summary(t):
    return q.period_champions(monthly_finals(t), F.floor(F.col("m") / 12), "winner")


@query("days_since_last", """
SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS n_hits,
  strftime(max(ts) FILTER (WHERE event_type = 'purchase'), '%Y-%m-%d') AS last_day,
  CAST((SELECT max(ts::DATE) FROM events) - max(ts::DATE) FILTER (WHERE event_type = 'purchase') AS INT) AS days_since
FROM events GROUP BY user_id
""")
def days_since_last(t):
    out = q.since_last(t.events.select("user_id", "event_type", "ts"), ["user_id"], F.col("event_type") == "purchase", "ts")
    return out.withColumn("last_day", F.date_format("last_day", "yyyy-MM-dd"))


@query("club_drought", f"""
WITH {FINALS}, s AS (SELECT m, winner AS club, true AS won FROM fin UNION ALL SELECT m, runner_up, false FROM fin)
SELECT club, count(*) FILTER (WHERE won) AS titles, count(*) FILTER (WHERE NOT won) AS finals_lost,
  (SELECT max(m) FROM fin) - max(m) FILTER (WHERE won) AS drought FROM s WHERE club = 3 GROUP BY club
""")
def club_drought(t):
    return q.titles_and_drought(monthly_finals(t), "m", "winner", "runner_up", 3).select("club", "titles", "finals_lost", "drought")


@query("nation_pairs", f"""
WITH {GAMES}
SELECT least(team_a, team_b) AS club_1, greatest(team_a, team_b) AS club_2,
  count(*) FILTER (WHERE CASE WHEN team_a < team_b THEN score_a > score_b ELSE NOT (score_a > score_b) END) AS wins_1,
  count(*) FILTER (WHERE NOT CASE WHEN team_a < team_b THEN score_a > score_b ELSE NOT (score_a > score_b) END) AS wins_2, count(*) AS n_met
FROM g WHERE team_a <> team_b GROUP BY ALL
""")
def nation_pairs(t):
    return q.head_to_head(games(t), "team_a", "team_b", F.col("score_a") > F.col("score_b"))


@query("nation_matrix", "SELECT s_nationkey AS supplier_nation, " + ", ".join(
    f"count(*) FILTER (WHERE c_nationkey = {i}) AS n_{i}" for i in range(25)) + """
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def nation_matrix(t):
    rows = (t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("s_nationkey").alias("supplier_nation"), F.concat(F.lit("n_"), "c_nationkey").alias("customer_nation")))
    return q.meeting_matrix(rows, "supplier_nation", "customer_nation", [f"n_{i}" for i in range(25)])


@query("top_rival", f"""
WITH {GAMES}, sides AS (SELECT team_a AS club, team_b AS rival FROM g UNION ALL SELECT team_b, team_a FROM g),
 n AS (SELECT club, rival, count(*) AS n_met FROM sides WHERE club <> rival GROUP BY ALL)
FROM n QUALIFY row_number() OVER (PARTITION BY club ORDER BY n_met DESC, rival) = 1
""")
def top_rival(t):
    return q.top_rival(games(t), "team_a", "team_b")


def monthly_best_customer(t):
    per = (t.orders.groupBy(month_index("o_orderdate").alias("m"), "o_custkey")
           .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("spent")))
    return top_k(per, ["m"], [F.col("spent").desc(), F.col("o_custkey")])


@query("award_tally", """
WITH p AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m, o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM orders GROUP BY ALL),
 w AS (FROM p QUALIFY row_number() OVER (PARTITION BY m ORDER BY spent DESC, o_custkey) = 1)
SELECT o_custkey, count(*) AS n_awards, min(m) AS first_award, max(m) AS last_award FROM w GROUP BY 1
""")
def award_tally(t):
    return q.award_tally(monthly_best_customer(t), "o_custkey", "m")


@query("top_customers_total_or_mean", """
WITH c AS (SELECT o_custkey, CASE WHEN year(o_orderdate) <= 1997 THEN 'total' ELSE 'mean' END AS era, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s, count(*) AS n
  FROM orders GROUP BY ALL)
SELECT * FROM (SELECT era, o_custkey, CAST(s AS DOUBLE) AS measure FROM c WHERE era = 'total' ORDER BY measure DESC, o_custkey LIMIT 10)
UNION ALL SELECT * FROM (SELECT era, o_custkey, round(CAST(s AS DOUBLE) / n, 2) AS measure FROM c WHERE era = 'mean' AND n >= 3 ORDER BY measure DESC, o_custkey LIMIT 10)
""")
def top_customers_total_or_mean(t):
    c = (t.orders.groupBy("o_custkey", F.when(F.year("o_orderdate") <= 1997, "total").otherwise("mean").alias("era"))
         .agg(F.sum(F.col("o_totalprice").cast(MONEY)).cast("double").alias("s"), F.count("*").alias("n")))
    tie = [F.col("o_custkey")]
    total = q.leaders(c, F.col("s"), tie, 10, F.col("era") == "total")
    mean = q.leaders(c.where(F.col("n") >= 3), F.round(F.col("s") / F.col("n"), 2), tie, 10, F.col("era") == "mean")
    return total.unionByName(mean).select("era", "o_custkey", "measure")


@query("records_lookup", """
SELECT p_type, p_name, max(p_retailprice) AS record FROM part WHERE lower(p_type || ' ' || p_name) LIKE '%promo%' OR lower(p_type || ' ' || p_name) LIKE '%gear%'
GROUP BY ALL
""")
def records_lookup(t):
    records = t.part.groupBy("p_type", "p_name").agg(F.max("p_retailprice").alias("record")).withColumn("txt", F.concat_ws(" ", "p_type", "p_name"))
    return q.records_by_topic(records, "txt", ["Promo", "gear"]).drop("txt")


FOLD = "trim(regexp_replace(strip_accents(lower({c})), '[«»\"''.]', '', 'g'))"


@query("mentions", f"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array({FOLD.format(c='text')}, '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM documents),
 b AS (SELECT item_id, list_filter(regexp_split_to_array({FOLD.format(c='text')}, '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM benchmark),
 gw AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w), (VALUES (1), (2), (3)) v(k) WHERE i + k - 1 <= len(w)),
 n AS (SELECT array_to_string(w[i:i + k - 1], ' ') AS g, min(item_id) AS e FROM (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS i FROM b), (VALUES (1), (2), (3)) v(k) WHERE i + k - 1 <= len(w) GROUP BY 1),
 h AS (SELECT doc_id, g, e FROM gw JOIN n USING (g))
SELECT doc_id, count(*) AS n_names, arg_max(g, struct_pack(a := length(g), b := g)) AS longest_name, arg_max(e, struct_pack(a := length(g), b := g)) AS entity_id
FROM h GROUP BY doc_id
""")
def mentions(t):
    words = F.filter(F.split(q.search_fold("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    names = (t.benchmark.select("item_id", words.alias("w")).where(F.size("w") > 0)
             .select("item_id", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("i"))
             .select("item_id", "w", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(3), F.size("w") - F.col("i") + 1))).alias("k"))
             .select("item_id", F.array_join(F.slice("w", F.col("i"), F.col("k")), " ").alias("name")))
    return q.mentions(t.documents, "doc_id", "text", names, "name", "item_id", 3)


FRAGMENTS = ("small ring 2", "ed ring 17", "blue ring", "ring 2", "hot", "Small Bolt 1", "zzz")


@query("fragment_match", f"""
WITH f(fragment) AS (VALUES {', '.join(f"('{x.lower()}')" for x in FRAGMENTS)}),
 n AS (SELECT p_name || ' ' || split_part(p_brand, '#', 2) AS name, min(p_partkey) AS id FROM part GROUP BY 1),
 h AS (SELECT fragment, count(*) FILTER (WHERE name = fragment) AS n_exact, count(*) FILTER (WHERE starts_with(name, fragment)) AS n_prefix, count(*) AS n_inside,
   min(id) FILTER (WHERE name = fragment) AS e, min(id) FILTER (WHERE starts_with(name, fragment)) AS p, min(id) AS s
  FROM f JOIN n ON contains(name, fragment) GROUP BY 1)
SELECT fragment, n_exact, n_prefix, n_inside, CASE WHEN n_exact = 1 THEN 'exact' WHEN n_exact > 1 THEN 'ambiguous' WHEN n_prefix = 1 THEN 'prefix'
   WHEN n_inside = 1 THEN 'inside' ELSE 'ambiguous' END AS status,
  CASE WHEN n_exact = 1 THEN e WHEN n_exact > 1 THEN NULL WHEN n_prefix = 1 THEN p WHEN n_inside = 1 THEN s END AS entity_id FROM h
""")
def fragment_match(t):
    names = t.part.groupBy(F.concat(F.col("p_name"), F.lit(" "), F.substring_index("p_brand", "#", -1)).alias("name")).agg(F.min("p_partkey").alias("id"))
    return q.fragment_match(names, "name", "id", FRAGMENTS)


@query("month_detail", f"""
WITH {NATION_MONTHS}, e AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m, o_orderpriority, o_orderkey, o_totalprice FROM orders),
 tot AS (SELECT m, CAST(sum(revenue) AS DOUBLE) AS revenue, sum(n_orders)::BIGINT AS n_orders FROM nm GROUP BY m)
SELECT m, o_orderpriority, o_orderkey AS leader, revenue, n_orders FROM e JOIN tot USING (m)
QUALIFY row_number() OVER (PARTITION BY m, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1
""")
def month_detail(t):
    boards = t.orders.select(month_index("o_orderdate").alias("m"), "o_orderpriority", "o_orderkey", "o_totalprice")
    totals = nation_months(t).groupBy("m").agg(F.sum("revenue").cast("double").alias("revenue"), F.sum("n_orders").alias("n_orders"))
    return q.period_detail(boards, ["m"], "o_orderpriority", [F.col("o_totalprice").desc(), F.col("o_orderkey")], "o_orderkey", totals)


@query("on_this_day", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date, CAST(DATE '2001-12-31' - o_orderdate::DATE AS INT) AS days_since, 'day' AS match
FROM orders WHERE month(o_orderdate) = 2 AND day(o_orderdate) = 29
""")
def on_this_day(t):
    o = t.orders.select("o_orderkey", "o_orderdate")
    return (q.on_this_day(o, "o_orderdate", 2, 29, "2001-12-31", [F.col("o_orderkey")])
            .select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"), "days_since", "match"))


@query("on_this_month", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date, CAST(DATE '2001-12-31' - o_orderdate::DATE AS INT) AS days_since, 'month' AS match
FROM orders WHERE month(o_orderdate) = 2
""")
def on_this_month(t):
    o = t.orders.select("o_orderkey", "o_orderdate")
    return (q.on_this_day(o, "o_orderdate", 2, 31, "2001-12-31", [F.col("o_orderkey")])
            .select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"), "days_since", "match"))


@query("global_search", """
SELECT * FROM (SELECT 'customer' AS kind, c_custkey::VARCHAR AS ident, c_name AS label FROM customer WHERE lower(c_name) LIKE '%r#00000001%'
  UNION ALL SELECT 'nation', n_nationkey::VARCHAR, n_name FROM nation WHERE lower(n_name) LIKE '%r#00000001%'
  UNION ALL SELECT 'part', p_partkey::VARCHAR, p_name FROM part WHERE lower(p_name) LIKE '%r#00000001%'
  UNION ALL SELECT 'supplier', s_suppkey::VARCHAR, s_name FROM supplier WHERE lower(s_name) LIKE '%r#00000001%')
ORDER BY kind, label, ident LIMIT 40
""")
def global_search(t):
    return q.global_search({"customer": (t.customer, "c_custkey", "c_name"), "nation": (t.nation, "n_nationkey", "n_name"),
                            "part": (t.part, "p_partkey", "p_name"), "supplier": (t.supplier, "s_suppkey", "s_name")}, "R#00000001", 40)


def supplier_metrics(t):
    lines = t.lineitem.groupBy("l_suppkey").agg(
        F.count("*").alias("n_lines"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.max("l_discount").alias("top_discount"),
        F.count_distinct(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))).alias("n_returned"))
    return t.supplier.join(lines, F.col("s_suppkey") == F.col("l_suppkey"), "left")


SUPPLIERS = """m AS (SELECT s_suppkey, s_nationkey, s_acctbal, n_lines, quantity, top_discount, n_returned FROM supplier LEFT JOIN (
   SELECT l_suppkey, count(*) AS n_lines, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity, max(l_discount) AS top_discount,
    count(DISTINCT l_orderkey) FILTER (WHERE l_returnflag = 'R') AS n_returned FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey)"""
METRICS = ("n_lines", "quantity", "top_discount", "n_returned", "s_acctbal")


@query("compare_two", f"""
WITH {SUPPLIERS}, u AS ({' UNION ALL '.join(f"SELECT s_suppkey, '{x}' AS metric, CAST({x} AS DOUBLE) AS v FROM m" for x in METRICS)}),
 w AS (SELECT metric, max(v) FILTER (WHERE s_suppkey = 3) AS value_1, max(v) FILTER (WHERE s_suppkey = 5) AS value_2 FROM u GROUP BY 1)
SELECT *, CAST(value_1 IS NOT NULL AND value_2 IS NOT NULL AS INT) AS shared, CASE WHEN value_1 > value_2 THEN '3' WHEN value_2 > value_1 THEN '5' END AS leader FROM w
""")
def compare_two(t):
    return q.compare_entities(supplier_metrics(t), "s_suppkey", [3, 5], METRICS).withColumn("shared", F.col("shared").cast("int"))


@query("compare_score", f"""
WITH {SUPPLIERS}, u AS ({' UNION ALL '.join(f"SELECT s_suppkey, '{x}' AS metric, CAST({x} AS DOUBLE) AS v FROM m" for x in METRICS)}),
 w AS (SELECT metric, max(v) FILTER (WHERE s_suppkey = 3) AS a, max(v) FILTER (WHERE s_suppkey = 5) AS b FROM u GROUP BY 1)
SELECT CASE WHEN a IS NULL OR b IS NULL THEN 'hole' WHEN a > b THEN '3' WHEN b > a THEN '5' ELSE 'tie' END AS outcome, count(*) AS n_metrics FROM w GROUP BY 1
""")
def compare_score(t):
    return q.comparison_score(q.compare_entities(supplier_metrics(t), "s_suppkey", [3, 5], METRICS))


@query("fact_selectivity", """
WITH e AS (SELECT doc_id, lang = 'en' AS a, quality = 1 AS b, toxic = 0 AS c, n_chars > 400 AS d FROM documents LEFT JOIN labels USING (doc_id)),
 p AS (SELECT coalesce(a, true) AS pa, coalesce(b, true) AS pb, coalesce(c, true) AS pc, coalesce(d, true) AS pd, * FROM e)
SELECT 1 AS step, 'english' AS fact, count(*) FILTER (WHERE pa) AS n_possible, count(*) FILTER (WHERE a) AS n_certain, count(*) FILTER (WHERE pa) AS n_left,
  (count(*) FILTER (WHERE pa) > count(*) * 0.7)::INT AS too_broad FROM p
UNION ALL SELECT 2, 'good', count(*) FILTER (WHERE pb), count(*) FILTER (WHERE b), count(*) FILTER (WHERE pa AND pb), (count(*) FILTER (WHERE pb) > count(*) * 0.7)::INT FROM p
UNION ALL SELECT 3, 'clean', count(*) FILTER (WHERE pc), count(*) FILTER (WHERE c), count(*) FILTER (WHERE pa AND pb AND pc), (count(*) FILTER (WHERE pc) > count(*) * 0.7)::INT FROM p
UNION ALL SELECT 4, 'long', count(*) FILTER (WHERE pd), count(*) FILTER (WHERE d), count(*) FILTER (WHERE pa AND pb AND pc AND pd), (count(*) FILTER (WHERE pd) > count(*) * 0.7)::INT FROM p
""")
def fact_selectivity(t):
    d = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left")
    out = q.fact_selectivity(d, {"english": F.col("lang") == "en", "good": F.col("quality") == 1, "clean": F.col("toxic") == 0,
                                 "long": F.col("n_chars") > 400})
    return out.withColumn("too_broad", F.col("too_broad").cast("int"))


@query("supplier_rating", f"""
WITH {SUPPLIERS}
SELECT s_suppkey, round(CASE WHEN s_acctbal > 5000 THEN 10.0 ELSE 0.0 END + CASE WHEN s_nationkey < 5 THEN 5.0 ELSE 0.0 END
  + coalesce(greatest(0.0, n_lines - 590.0) * 0.5, 0.0) + coalesce(greatest(0.0, n_returned - 190.0) * 0.25, 0.0), 4)::DOUBLE AS rating FROM m
""")
def supplier_rating(t):
    out = q.composite_rating(supplier_metrics(t), {"rich": (F.col("s_acctbal") > 5000, 10), "home": (F.col("s_nationkey") < 5, 5)},
                             {"lines": (F.col("n_lines"), 590.0, 0.5), "returned": (F.col("n_returned"), 190.0, 0.25)})
    return out.select("s_suppkey", F.round("rating", 4).alias("rating"))


@query("segment_depth", """
SELECT c_mktsegment AS group_key, s AS period_key, count(DISTINCT c_custkey) AS depth FROM (
  SELECT c_custkey, c_mktsegment, unnest([o_orderstatus, o_orderpriority]) AS s FROM customer JOIN orders ON o_custkey = c_custkey)
GROUP BY ALL HAVING count(DISTINCT c_custkey) >= 240
""")
def segment_depth(t):
    rows = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
    return q.group_depth(rows, F.array("c_mktsegment"), F.array("o_orderstatus", "o_orderpriority"), "c_custkey", 240)


@query("answer_share", """
WITH c AS (SELECT c_mktsegment, o_orderpriority, o_orderstatus, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_mktsegment, o_orderpriority, o_orderstatus, n, round(n * 100 / sum(n) OVER (PARTITION BY c_mktsegment, o_orderpriority), 6) AS share_pct FROM c
""")
def answer_share(t):
    c = (t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
         .groupBy("c_mktsegment", "o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n")))
    return q.answer_share(c, ["c_mktsegment", "o_orderpriority"], "n").withColumn("share_pct", F.round("share_pct", 6))
