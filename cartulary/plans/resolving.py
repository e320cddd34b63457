"""Reconciliation and entity resolution over the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import fuzzy, merges, reconcile, resolve
from ..operators.skew import shuffled
from ..session import spread
from .base import query
from .summaries import MONEY, month_index

# --- two and three sources ---------------------------------------------------


def _headers_and_lines(t):
    """Order status and price band as the header states them, and as the lines imply them."""
    header = t.orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("state"), "o_custkey",
                             F.floor(F.col("o_totalprice") / 100000).alias("band"))
    lines = (t.lineitem.groupBy(F.col("l_orderkey").alias("order_key"))
             .agg(F.bool_and(F.col("l_linestatus") == "F").alias("done"), F.bool_and(F.col("l_linestatus") == "O").alias("open"),
                  F.floor(F.sum(F.col("l_extendedprice").cast(MONEY)) / 100000).cast("long").alias("band"))
             .select("order_key", F.when(F.col("done"), "F").when(F.col("open"), "O").otherwise("P").alias("state"), "band"))
    return header, lines


HEADER_LINES = """h AS (SELECT o_orderkey AS k, o_orderstatus AS state, CAST(floor(o_totalprice / 100000) AS BIGINT) AS band FROM orders),
 l AS (SELECT l_orderkey AS k, CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) ELSE 'P' END AS state,
   CAST(floor(sum(CAST(l_extendedprice AS DECIMAL(18,2))) / 100000) AS BIGINT) AS band FROM lineitem GROUP BY 1),
 j AS (SELECT coalesce(h.k, l.k) AS k, h.state AS state_header, l.state AS state_lines, h.band AS band_header, l.band AS band_lines,
   CASE WHEN l.k IS NULL THEN 'header_only' WHEN h.k IS NULL THEN 'lines_only'
     WHEN h.state <> l.state OR h.band <> l.band THEN 'conflict' ELSE 'agree' END AS status FROM h FULL JOIN l ON h.k = l.k)"""


@query("reconcile_totals", f"""
WITH {HEADER_LINES}
SELECT r_name AS region, count(*) AS n_orders, count(*) FILTER (WHERE status = 'agree') AS n_agree,
  count(*) FILTER (WHERE status = 'conflict') AS n_conflict, count(*) FILTER (WHERE status = 'header_only') AS n_header_only,
  count(*) FILTER (WHERE status = 'lines_only') AS n_lines_only,
  round(count(*) FILTER (WHERE status = 'conflict') / count(*), 4) AS conflict_rate
FROM j JOIN orders ON o_orderkey = k JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def reconcile_totals(t):
    header, lines = _headers_and_lines(t)
    rows = reconcile.reconcile_two(header, lines, ["order_key"], ["state", "band"], names=("header", "lines"), carry=["o_custkey"]).rows
    place = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
             .select("c_custkey", F.col("r_name").alias("region")))
    s = F.col("status")
    return (rows.join(place, F.col("o_custkey") == F.col("c_custkey")).groupBy("region")
            .agg(F.count("*").alias("n_orders"), F.count_if(s == "agree").alias("n_agree"),
                 F.count_if(s == "conflict").alias("n_conflict"), F.count_if(s == "header_only").alias("n_header_only"),
                 F.count_if(s == "lines_only").alias("n_lines_only"))
            .withColumn("conflict_rate", F.round(F.col("n_conflict") / F.col("n_orders"), 4)))


RULED = "('state', 7, 'F', 'single-source'), ('band', 100, '9', 'verified'), ('band', 101, '9', 'verified')"


@query("reconcile_rows", f"""
WITH {HEADER_LINES}, r(slot, k, v, conf) AS (VALUES {RULED}),
 x AS (SELECT j.*, rs.v AS rs, rs.conf AS rsc, rb.v AS rb, rb.conf AS rbc FROM j LEFT JOIN r rs ON rs.slot = 'state' AND rs.k = j.k
   LEFT JOIN r rb ON rb.slot = 'band' AND rb.k = j.k),
 y AS (SELECT *, state_header <> state_lines AND rsc IS NULL AND status NOT LIKE '%only' AS xs,
   band_header <> band_lines AND rbc IS NULL AND status NOT LIKE '%only' AS xb FROM x),
 z AS (SELECT *, CASE WHEN status LIKE '%only' THEN status WHEN xs OR xb THEN 'conflict' ELSE 'agree' END AS st FROM y)
SELECT k AS order_key, CASE WHEN NOT coalesce(xs, false) THEN coalesce(rs, state_header, state_lines) END AS state,
  CASE WHEN NOT coalesce(xb, false) THEN coalesce(rb, band_header::VARCHAR, band_lines::VARCHAR) END AS band,
  state_header, state_lines, band_header, band_lines, st AS status,
  CASE WHEN st = 'conflict' THEN 'disputed' WHEN st LIKE '%only' THEN 'single-source'
    WHEN rsc IS NULL AND rbc IS NULL THEN 'verified' ELSE least(coalesce(rsc, rbc), coalesce(rbc, rsc)) END AS confidence
FROM z
""")
def reconcile_rows(t):
    header, lines = _headers_and_lines(t)
    ruled = t.values(RULED, "slot, order_key, value, confidence")
    return reconcile.reconcile_two(header, lines, ["order_key"], ["state", "band"], resolutions=ruled,
                                   names=("header", "lines")).rows


@query("reconcile_conflicts", f"""
WITH {HEADER_LINES}
SELECT k AS order_key, 'state' AS slot, state_header AS value_a, state_lines AS value_b FROM j
WHERE status = 'conflict' AND state_header <> state_lines
UNION ALL SELECT k, 'band', band_header::VARCHAR, band_lines::VARCHAR FROM j WHERE status = 'conflict' AND band_header <> band_lines
""")
def reconcile_conflicts(t):
    header, lines = _headers_and_lines(t)
    return reconcile.reconcile_two(header, lines, ["order_key"], ["state", "band"], names=("header", "lines")).conflicts


@query("reconcile_three", """
WITH w(c, n) AS (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending'), ('R', 'returned'), ('A', 'accepted'), ('N', 'none')),
 a AS (SELECT o_orderkey AS k, n FROM orders JOIN w ON o_orderstatus = c),
 b AS (SELECT CASE WHEN m % 3 = 0 THEN -l_orderkey - 1 ELSE l_orderkey END AS k, n
   FROM (SELECT l_orderkey, min(l_linestatus) AS s, count(*) AS m FROM lineitem GROUP BY 1) JOIN w ON s = c),
 d AS (SELECT CASE WHEN m % 4 = 0 THEN -l_orderkey - 1 ELSE l_orderkey END AS k, n
   FROM (SELECT l_orderkey, max(l_linestatus) AS s, count(*) AS m FROM lineitem GROUP BY 1) JOIN w ON s = c),
 j AS (SELECT coalesce(a.k, b.k, d.k) AS k, a.n AS an, b.n AS bn, d.n AS dn FROM a FULL JOIN b ON a.k = b.k FULL JOIN d ON coalesce(a.k, b.k) = d.k),
 e AS (SELECT *, (an IS NOT NULL)::INT + (bn IS NOT NULL)::INT + (dn IS NOT NULL)::INT AS p FROM j)
SELECT agreement, count(*) AS n_orders FROM (SELECT CASE WHEN k IN (5, 6) THEN 'dual_metric'
  WHEN p = 1 THEN CASE WHEN an IS NOT NULL THEN 'header_only' WHEN bn IS NOT NULL THEN 'first_only' ELSE 'last_only' END
  WHEN coalesce(an <> bn, false) OR coalesce(bn <> dn, false) OR coalesce(an <> dn, false) THEN 'conflict' ELSE 'agree' END AS agreement FROM e)
GROUP BY 1
""")
def reconcile_three(t):
    words = {"F": "Finished", "O": "Open", "P": "Pending"}

    def word(c):
        return reduce(lambda e, kv: F.when(F.col(c) == kv[0], kv[1]).otherwise(e), words.items(), F.lit(None))

    def key(n):
        """The order's key, but one that nobody else has where its line count is a multiple of n."""
        return F.when(F.col("m") % n == 0, -F.col("l_orderkey") - 1).otherwise(F.col("l_orderkey")).alias("k")

    header = t.orders.select(F.col("o_orderkey").alias("k"), F.lit("header").alias("source"), F.concat(F.lit("Ana "), word("o_orderstatus")).alias("name"))
    lines = t.lineitem.groupBy("l_orderkey").agg(F.min("l_linestatus").alias("low"), F.max("l_linestatus").alias("high"), F.count("*").alias("m"))
    both = F.array(F.struct(key(3), F.lit("first").alias("source"), F.concat(F.upper(word("low")), F.lit(", Ana")).alias("name")),
                   F.struct(key(4), F.lit("last").alias("source"), F.concat(word("high"), F.lit(", Ana M.")).alias("name")))
    rows = header.unionByName(lines.select(F.explode(both).alias("r")).select("r.*"))
    out = reconcile.reconcile_named(rows, "k", ["header", "first", "last"], t.values("(5L), (6L)", "k"))
    return out.groupBy("agreement").agg(F.count("*").alias("n_orders"))


@query("lineage_edges", """
WITH e AS (SELECT n_nationkey AS src, n_regionkey * 5 AS dst, 1990 + n_nationkey AS season FROM nation)
SELECT src, dst, season, src AS franchise FROM e UNION ALL SELECT src, dst, season, dst FROM e WHERE src <> dst
""")
def lineage_edges(t):
    e = t.nation.select(F.col("n_nationkey").alias("src"), (F.col("n_regionkey") * 5).alias("dst"),
                        (F.col("n_nationkey") + 1990).alias("season"))
    return reconcile.lineage(e, "src", "dst")


# --- folds over a two-source career ledger -----------------------------------


def career(t):
    """Monthly customer totals as the first source, and a second source that repeats, alters or omits them."""
    monthly = (t.orders.groupBy("o_custkey", month_index("o_orderdate").alias("m"))
               .agg(F.count("*").alias("games"), F.sum(F.floor(F.col("o_totalprice") / 1000)).alias("points"))
               .join(t.customer, F.col("o_custkey") == F.col("c_custkey")))
    k, m = F.col("o_custkey"), F.col("m")
    seg = F.col("c_mktsegment")
    first = monthly.select(
        k.alias("id"), m.alias("m"), F.concat(F.lit("Nick"), k % 2, F.lit(", "), seg).alias("team"), "games",
        F.when(k % 11 == 0, None).otherwise(F.col("points")).alias("points"), F.lit("first").alias("source"))
    second = monthly.where(m % 4 != 3).select(
        k.alias("id"), m.alias("m"),
        F.when(k % 3 == 0, F.lower(seg)).otherwise(F.concat(F.lit("Nick0, "), seg)).alias("team"), "games",
        F.when(k % 11 == 0, F.when(m % 4 == 1, 0)).when(m % 4 == 1, F.col("points") + 1)
        .otherwise(F.col("points")).cast("long").alias("points"), F.lit("second").alias("source"))
    return first.unionByName(second)


CAREER = """mm AS (SELECT o_custkey AS id, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m, count(*) AS games,
   sum(floor(o_totalprice / 1000))::BIGINT AS points, any_value(c_mktsegment) AS seg
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
 fs AS (SELECT id, m, seg, 'Nick' || id % 2 AS fr, games, CASE WHEN id % 11 > 0 THEN points END AS points FROM mm),
 sc AS (SELECT id, m, seg, CASE WHEN id % 3 = 0 THEN '' ELSE 'Nick0' END AS fr, games,
   CASE WHEN id % 11 = 0 THEN CASE WHEN m % 4 = 1 THEN 0 END WHEN m % 4 = 1 THEN points + 1 ELSE points END AS points FROM mm WHERE m % 4 <> 3)"""


@query("fold_sources", f"""
WITH {CAREER}, tw AS (SELECT sc.*, fs.points AS base_points, sc.games = fs.games AND sc.points IS NOT DISTINCT FROM fs.points AS same
   FROM sc JOIN fs USING (id, m) WHERE sc.fr = '' OR sc.fr = fs.fr)
SELECT 'kept' AS part, (SELECT count(*) FROM fs) + (SELECT count(*) FROM sc) - (SELECT count(*) FROM tw WHERE same) AS n_rows,
  (SELECT sum(points) FROM fs)::BIGINT + (SELECT sum(points) FROM sc)::BIGINT - (SELECT sum(points) FROM tw WHERE same)::BIGINT AS points
UNION ALL SELECT 'merged', count(*), sum(points)::BIGINT FROM tw WHERE same
UNION ALL SELECT 'conflict', count(*), sum(points)::BIGINT FROM tw WHERE NOT same
""")
def fold_sources(t):
    nick = F.when(F.col("team").contains(","), F.substring_index("team", ",", 1)).otherwise("")
    f = reconcile.fold_cross_source(career(t), "id", "m", "team", ["games", "points"], "source", "second", nick)

    def part(name, df):
        return df.agg(F.count("*").alias("n_rows"), F.sum("points").alias("points")).select(F.lit(name).alias("part"), "*")

    return part("kept", f.kept).unionByName(part("merged", f.merged)).unionByName(part("conflict", f.conflicts))


@query("fold_merged_rows", f"""
WITH {CAREER}
SELECT sc.id, sc.m, sc.games, sc.points, 'Nick' || id % 2 || ', ' || fs.seg AS team_kept FROM sc JOIN fs USING (id, m)
WHERE (sc.fr = '' OR sc.fr = fs.fr) AND sc.games = fs.games AND sc.points IS NOT DISTINCT FROM fs.points
""")
def fold_merged_rows(t):
    nick = F.when(F.col("team").contains(","), F.substring_index("team", ",", 1)).otherwise("")
    f = reconcile.fold_cross_source(career(t), "id", "m", "team", ["games", "points"], "source", "second", nick)
    return f.merged.select("id", "m", "games", "points", "team_kept")


def _order_ledger(t):
    base = t.lineitem.select(F.col("l_orderkey").alias("id"), F.lit("first").alias("source"),
                             F.when(F.col("l_discount") < 0.1, F.col("l_quantity").cast("long")).alias("games"),
                             F.col("l_linenumber").cast("long").alias("points"))
    sums = (t.lineitem.groupBy(F.col("l_orderkey").alias("id"))
            .agg(F.sum(F.col("l_quantity").cast("long")).alias("games"), F.sum(F.col("l_linenumber").cast("long")).alias("points"))
            .join(t.orders.select(F.col("o_orderkey").alias("id"), "o_orderstatus"), "id")
            .select("id", F.lit("second").alias("source"),
                    F.when(F.col("o_orderstatus") == "O", F.col("games") + 1).otherwise(F.col("games")).alias("games"), "points"))
    return base.unionByName(sums)


@query("fold_sums", """
WITH b AS (SELECT l_orderkey AS id, CASE WHEN l_discount < 0.1 THEN CAST(l_quantity AS BIGINT) END AS g, CAST(l_quantity AS BIGINT) AS q,
   l_linenumber AS p FROM lineitem),
 s AS (SELECT id, sum(q)::BIGINT AS q, sum(p)::BIGINT AS p, sum(g)::BIGINT AS g, count(*) AS n, count(g) AS ng FROM b GROUP BY id)
SELECT id, q AS games, p AS points, n AS n_parts FROM s JOIN orders ON o_orderkey = id
WHERE o_orderstatus <> 'O' AND n >= 2 AND n = ng AND NOT EXISTS (FROM b WHERE b.id = s.id AND b.g = s.q AND b.p = s.p)
""")
def fold_sums(t):
    f = reconcile.fold_totals(_order_ledger(t), ["id"], ["games", "points"], "source", "first", "second")
    return f.dropped.select("id", "games", "points", "n_parts")


@query("fold_sums_kept", """
WITH b AS (SELECT l_orderkey AS id, CASE WHEN l_discount < 0.1 THEN CAST(l_quantity AS BIGINT) END AS g, CAST(l_quantity AS BIGINT) AS q,
   l_linenumber AS p FROM lineitem),
 s AS (SELECT id, sum(q)::BIGINT AS q, sum(p)::BIGINT AS p, count(*) AS n, count(g) AS ng FROM b GROUP BY id)
SELECT 'first' AS source, count(*) AS n_rows, sum(p)::BIGINT AS points FROM b
UNION ALL SELECT 'second', count(*), sum(p)::BIGINT FROM s JOIN orders ON o_orderkey = id
WHERE NOT (o_orderstatus <> 'O' AND n >= 2 AND n = ng AND NOT EXISTS (FROM b WHERE b.id = s.id AND b.g = s.q AND b.p = s.p))
""")
def fold_sums_kept(t):
    f = reconcile.fold_totals(_order_ledger(t), ["id"], ["games", "points"], "source", "first", "second")
    return f.kept.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("points").alias("points"))


@query("drop_listed", """
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity = 50 AND l_discount = 0 AND l_returnflag = 'R' AS hit FROM lineitem),
 k AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM d WHERE hit)
SELECT 'kept' AS part, (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM lineitem l SEMI JOIN k USING (l_orderkey, l_linenumber, l_partkey)
   WHERE l_returnflag = 'R') AS n_rows
UNION ALL SELECT 'dropped', count(*) FROM lineitem l SEMI JOIN k USING (l_orderkey, l_linenumber, l_partkey) WHERE l_returnflag = 'R'
UNION ALL SELECT 'stale', count(*) FROM supplier
""")
def drop_listed(t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    listed = (t.lineitem.where((F.col("l_quantity") == 50) & (F.col("l_discount") == 0) & (F.col("l_returnflag") == "R")).select(*keys)
              .unionByName(t.supplier.select((-F.col("s_suppkey") - 1).alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
                                             F.col("s_suppkey").alias("l_partkey")))
              .withColumn("evidence", F.lit("same line under another owner")))
    d = reconcile.drop_listed(t.lineitem, listed, keys, F.col("l_returnflag") == "R")

    def part(name, df):
        return df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("part"), "n_rows")

    return part("kept", d.kept).unionByName(part("dropped", d.dropped)).unionByName(part("stale", d.stale))


@query("relabel_late", """
SELECT o_orderkey, year(o_orderdate) AS season, year(o_orderdate) + 1 AS season_new FROM orders
WHERE year(o_orderdate) = 1998 AND o_orderdate >= TIMESTAMP '1998-05-01'
""")
def relabel_late(t):
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("season"), dates.capture_key("o_orderdate").alias("capture"))
    return reconcile.relabel(rows, "season", dates.relabelled_season("season", "capture", 1998, "19980501000000")).log.drop("capture")


@query("cas_overrides", """
SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL AND c_mktsegment = 'MACHINERY' THEN 'CORRECTED' ELSE c_mktsegment END AS segment,
  CASE WHEN s_suppkey IS NULL THEN 'none' WHEN c_mktsegment = 'MACHINERY' THEN 'applied' ELSE 'stale' END AS outcome
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
""")
def cas_overrides(t):
    base = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    o = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.lit("MACHINERY").alias("old_value"), F.lit("CORRECTED").alias("new_value"))
    r = reconcile.compare_and_set(base, o, "c_custkey", "segment")
    marks = (r.applied.select("c_custkey", F.lit("applied").alias("outcome"))
             .unionByName(r.stale.select("c_custkey", F.lit("stale").alias("outcome"))))
    return r.rows.join(marks, "c_custkey", "left").fillna("none", ["outcome"])


@query("overlay_repair", r"""
WITH c AS (SELECT conv_id, turn, regexp_matches(text, '[^\x00-\x7F]') AS damaged FROM conversations)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE damaged) AS n_changed, count(*) FILTER (WHERE NOT damaged) AS n_untouched,
  count(*) FILTER (WHERE damaged AND conv_id % 2 = 0) AS n_resolved_again, count(*) AS n_restored FROM c
""")
def overlay_repair(t):
    rows = (t.conversations.withColumn("original", F.col("text"))
            .withColumn("text", F.decode(F.encode("text", "utf-8"), "iso-8859-1"))
            .withColumn("who", F.when(F.col("conv_id") % 2 == 1, F.col("conv_id"))))
    r = reconcile.repair_overlay(rows, "text", "who", lambda d: d.withColumn("resolved_id", F.col("conv_id") + 1000))
    counts = r.rows.agg(F.count("*").alias("n_rows"), F.count_if(F.col("text") == F.col("original")).alias("n_restored"))
    log = r.log.agg(F.count("*").alias("n_changed"), F.count_if(F.col("id_before").isNull() & (F.col("who") > 999)).alias("n_resolved_again"))
    same = r.untouched.agg(F.count("*").alias("n_untouched"))
    return counts.select("*", log.select("n_changed").scalar().alias("n_changed"),
                         log.select("n_resolved_again").scalar().alias("n_resolved_again"), same.scalar().alias("n_untouched"))


@query("diff_two_lists", """
WITH a AS (SELECT CASE WHEN c_acctbal > -500 THEN c_custkey ELSE -c_custkey - 1 END AS k, c_mktsegment AS v FROM customer),
 b AS (SELECT o_custkey AS k, CASE WHEN max(o_totalprice) > 495000 THEN 'TOP' ELSE any_value(c_mktsegment) END AS v
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, a.v AS value_a, b.v AS value_b, CASE WHEN b.v IS NULL THEN 'only_a' WHEN a.v IS NULL THEN 'only_b' ELSE 'differs' END AS status
FROM a FULL JOIN b ON a.k = b.k WHERE a.v IS DISTINCT FROM b.v
""")
def diff_two_lists(t):
    k = F.when(F.col("c_acctbal") > -500, F.col("c_custkey")).otherwise(-F.col("c_custkey") - 1)
    a = t.customer.select(k.alias("k"), F.col("c_mktsegment").alias("v"))
    top = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("top"))
    b = (top.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .select(F.col("o_custkey").alias("k"), F.when(F.col("top") > 495000, "TOP").otherwise(F.col("c_mktsegment")).alias("v")))
    return reconcile.cross_check(a, b, ["k"], "v")


@query("overlay_facts", """
WITH b AS (SELECT l_partkey AS p_partkey, max(CAST(l_quantity AS INT)) AS p_size, list(DISTINCT year(l_shipdate) ORDER BY year(l_shipdate)) AS seasons
  FROM lineitem GROUP BY 1)
SELECT p_partkey, p_brand, coalesce(b.p_size, p.p_size) AS p_size,
  array_to_string(list_sort(list_distinct(list_concat([1994, 1997], coalesce(seasons, [])))), ',') AS seasons FROM part p LEFT JOIN b USING (p_partkey)
""")
def overlay_facts(t):
    curated = t.part.select("p_partkey", "p_brand", "p_size", F.array(F.lit(1994), F.lit(1997)).alias("seasons"))
    built = (t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey"))
             .agg(F.max(F.col("l_quantity").cast("int")).alias("p_size"), F.sort_array(F.collect_set(F.year("l_shipdate"))).alias("seasons")))
    out = reconcile.overlay_facts(curated, built, "p_partkey", ["p_size"], ["seasons"])
    return out.withColumn("seasons", F.array_join("seasons", ","))


# --- entities ----------------------------------------------------------------


@query("canonical_customer", """
WITH d AS (SELECT o_custkey AS id, arg_max(o_orderpriority, struct_pack(a := o_orderdate, b := o_orderkey)) AS priority,
   arg_min(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, struct_pack(a := o_orderdate, b := o_orderkey)) FILTER (WHERE o_orderstatus <> 'P') AS first_state
  FROM orders GROUP BY 1)
SELECT id, first_state, coalesce(c_mktsegment, priority) AS priority, (c_custkey IS NOT NULL)::INT AS has_profile
FROM d LEFT JOIN customer ON id = CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey - 1 END
""")
def canonical_customer(t):
    stamp = F.struct("o_orderdate", "o_orderkey").alias("stamp")
    directory = t.orders.select(F.col("o_custkey").alias("id"), stamp, F.col("o_orderpriority").alias("priority"),
                                F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise("").alias("first_state"))
    profiles = t.customer.select(
        F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).otherwise(-F.col("c_custkey") - 1).alias("id"), F.lit(1).alias("stamp"), F.col("c_mktsegment").alias("priority"))
    return (resolve.canonical_entities(directory, profiles, "id", "stamp", ["priority"], ["first_state"])
            .withColumn("has_profile", F.col("has_profile").cast("int")))


GIVEN = ("Ana", "Bernardo", "Carlos", "Daniela", "Ernesto", "Fabian", "Gloria", "Hector")
SECOND = ("", " Maria", " Luis", " Jose")


def people(t):
    """Customers as people: family words from segment and nation, given names by key."""
    k = F.col("c_custkey")
    pick = F.element_at(F.array(*map(F.lit, GIVEN)), (k % 8 + 1).cast("int"))
    more = F.element_at(F.array(*map(F.lit, SECOND)), (F.floor(k / 8) % 4 + 1).cast("int"))
    return (spread(t.customer).select(k.alias("id"), F.concat_ws(" ", "c_mktsegment", F.concat(F.lit("N"), "c_nationkey")).alias("apellidos"),
                              F.concat(pick, more).alias("nombre"), F.col("c_mktsegment").alias("seg"))
            .withColumn("name", F.concat_ws(", ", "apellidos", "nombre"))
            .withColumn("nickname", F.when(F.col("id") % 10 == 0, F.concat(F.lit("El "), F.lower("seg")))))


def _sql_list(xs):
    return "[" + ", ".join(f"'{x.lower()}'" for x in xs) + "]"


PEOPLE = f"""pp AS (SELECT c_custkey AS id, lower(c_mktsegment) AS pat, lower(c_mktsegment) || ' n' || c_nationkey AS fam,
   {_sql_list(GIVEN)}[c_custkey % 8 + 1] AS fst, {_sql_list(GIVEN)}[c_custkey % 8 + 1] || {_sql_list(SECOND)}[c_custkey // 8 % 4 + 1] AS giv,
   CASE WHEN c_custkey % 10 = 0 THEN 'el ' || lower(c_mktsegment) END AS nick FROM customer),
 al AS (SELECT DISTINCT id, k, a FROM (
   SELECT id, 'canonical' AS k, fam || ', ' || giv AS a FROM pp UNION ALL SELECT id, 'normalized', fam || ', ' || giv FROM pp
   UNION ALL SELECT id, 'raw', fam || ', ' || giv FROM pp UNION ALL SELECT id, 'given_family_order', giv || ' ' || fam FROM pp
   UNION ALL SELECT id, 'nickname', nick FROM pp WHERE nick IS NOT NULL
   UNION ALL SELECT id, 'nickname_surname', pat || ', ' || nick FROM pp WHERE nick IS NOT NULL
   UNION ALL SELECT id, 'paternal_surname', s || ', ' || giv FROM (SELECT id, giv, unnest([fam, pat]) AS s FROM pp)
   UNION ALL SELECT id, 'given_first_only', s || ', ' || fst FROM (SELECT id, giv, fst, unnest([fam, pat]) AS s FROM pp) WHERE fst <> giv
   UNION ALL SELECT id, 'initial', s || ', ' || fst[1] FROM (SELECT id, fst, unnest([fam, pat]) AS s FROM pp)))"""


def aliases(t):
    return resolve.alias_table(people(t), "id", "name", "apellidos", "nombre", "nickname", "nombre")


@query("alias_table", f"WITH {PEOPLE} SELECT id, k AS alias_type, a AS normalized_alias FROM al")
def alias_table(t):
    return aliases(t).select("id", "alias_type", "normalized_alias")


@query("fill_labels", """
WITH d AS (SELECT md5(text) AS h, min(doc_id) AS doc_id, min(quality) AS quality, min(toxic) FILTER (WHERE doc_id % 2 = 0) AS toxic
   FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1),
 s AS (SELECT md5(text) AS h, max(quality) AS quality, max(toxic) AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY 1)
SELECT doc_id, coalesce(d.quality, s.quality) AS quality, coalesce(d.toxic, s.toxic) AS toxic,
  coalesce(d.quality <> s.quality, false)::INT + coalesce(d.toxic <> s.toxic, false)::INT AS n_conflicts FROM d LEFT JOIN s USING (h)
""")
def fill_labels(t):
    known = t.documents.select("doc_id", F.md5("text").alias("h")).join(t.labels, "doc_id", "left")
    spine = known.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.min("quality").alias("quality"),
                                   F.min(F.when(F.col("doc_id") % 2 == 0, F.col("toxic"))).alias("toxic"))
    source = known.where(F.col("quality").isNotNull()).select("h", "quality", "toxic")
    f = resolve.fill_empty(spine, source, "h", ["quality", "toxic"])
    n = f.conflicts.groupBy("h").agg(F.count("*").cast("int").alias("n_conflicts"))
    return f.rows.join(n, "h", "left").fillna(0, ["n_conflicts"]).drop("h")


def _born(k, c):
    day = F.date_add(F.lit("1960-01-01").cast("date"), (k * 37 % 6000).cast("int"))
    return F.when(c, None).otherwise(day)


@query("enrich_mint_review", f"""
WITH {PEOPLE}, c AS (SELECT id, fam, fst, fam || ', ' || giv AS nm, CASE WHEN id % 10 = 3 THEN NULL ELSE DATE '1960-01-01' + (id * 37 % 6000)::INT END AS bd,
   CASE WHEN id % 20 = 3 THEN NULL ELSE year(DATE '1960-01-01' + (id * 37 % 6000)::INT) END AS byr FROM pp),
 s AS (SELECT s_suppkey AS sid, CASE WHEN s_suppkey % 3 = 0 THEN pat WHEN s_suppkey % 7 = 0 THEN 'unseen' ELSE fam END || ', ' ||
     CASE WHEN s_suppkey % 5 = 0 THEN fst || ' x' ELSE giv END AS nm,
   CASE WHEN s_suppkey % 3 = 0 THEN pat WHEN s_suppkey % 7 = 0 THEN 'unseen' ELSE fam END AS fam, fst,
   CASE WHEN s_suppkey % 6 = 4 THEN NULL ELSE DATE '1960-01-01' + ((s_suppkey * 11) * 37 % 6000)::INT + (s_suppkey % 4 * 3)::INT END AS bd
  FROM supplier JOIN pp ON id = s_suppkey * 11),
 y AS (SELECT *, year(bd) AS byr FROM s),
 e AS (SELECT sid, min(c.id) AS eid FROM y JOIN c ON c.nm = y.nm AND (y.byr IS NULL OR c.byr = y.byr) GROUP BY sid),
 f AS (SELECT sid, c.id, y.bd AS sbd, c.bd AS cbd, y.byr AS sy, c.byr AS cy FROM y JOIN c ON c.fst = y.fst AND
   (starts_with(c.fam || ' ', y.fam || ' ') OR starts_with(y.fam || ' ', c.fam || ' '))),
 g AS (SELECT sid, min(id) FILTER (WHERE abs(sbd - cbd) <= 7 OR ((sbd IS NULL OR cbd IS NULL) AND sy = cy)) AS fid, count(*) AS n FROM f GROUP BY sid),
 k AS (SELECT DISTINCT y.sid FROM y JOIN c ON split_part(c.fam, ' ', 1) = split_part(y.fam, ' ', 1) AND c.byr = y.byr),
 t AS (SELECT y.*, eid, fid, CASE WHEN eid IS NOT NULL THEN 'exact' WHEN fid IS NOT NULL THEN 'family_shape'
   WHEN (y.byr IS NOT NULL AND y.sid IN (FROM k)) OR (y.byr IS NULL AND coalesce(n, 0) > 0) THEN 'review' ELSE 'mint' END AS tier
  FROM y LEFT JOIN e USING (sid) LEFT JOIN g USING (sid))
SELECT sid, tier, CASE tier WHEN 'exact' THEN eid WHEN 'family_shape' THEN fid WHEN 'mint' THEN 990000 + row_number() OVER (
   PARTITION BY tier ORDER BY array_to_string(list_sort(string_split(replace(nm, ',', ''), ' ')), ' '), bd NULLS FIRST, sid) END AS id FROM t
""")
def enrich_mint_review(t):
    words = text.name_tokens("apellidos")
    k = F.col("id")
    p = people(t)
    canon = (p.withColumn("birth_date", _born(k, k % 10 == 3))
             .withColumn("birth_year", F.when(k % 20 == 3, None).otherwise(F.year(_born(k, F.lit(False)))))
             .select("id", text.token_sort_key("name").alias("name_key"), words.alias("family"),
                     F.lower(F.substring_index("nombre", " ", 1)).alias("given"), "birth_date", "birth_year"))
    s = F.col("sid")
    fam = F.when(s % 3 == 0, F.col("seg")).when(s % 7 == 0, "Unseen").otherwise(F.col("apellidos"))
    giv = F.when(s % 5 == 0, F.concat(F.substring_index("nombre", " ", 1), F.lit(" X"))).otherwise(F.col("nombre"))
    second = (t.supplier.select(F.col("s_suppkey").alias("sid"), (F.col("s_suppkey") * 11).alias("id")).join(p, "id")
              .withColumn("birth_date", F.date_add(_born(k, s % 6 == 4), (s % 4 * 3).cast("int")))
              .select("sid", text.token_sort_key(F.concat(fam, F.lit(", "), giv)).alias("name_key"),
                      text.name_tokens(fam).alias("family"), F.lower(F.substring_index("nombre", " ", 1)).alias("given"),
                      "birth_date", F.year("birth_date").alias("birth_year")))
    return resolve.enrich_mint_review(second, canon, "sid", "id", 990000).decided.select("sid", "tier", "id")


@query("extend_spans", """
WITH c AS (SELECT c_custkey AS id, c_nationkey || c_mktsegment || floor(c_acctbal / 200)::INT AS k FROM customer),
 sp AS (SELECT o_custkey AS id, min(year(o_orderdate)) AS f, max(year(o_orderdate)) AS l FROM orders GROUP BY 1),
 u AS (SELECT k, min(id) AS id FROM c GROUP BY k HAVING count(*) = 1),
 att AS (SELECT u.id, min(year(l_shipdate)) AS lo, max(year(l_shipdate)) AS hi FROM lineitem JOIN orders ON l_orderkey = o_orderkey
   JOIN c ON o_custkey = c.id JOIN u ON u.k = c.k GROUP BY 1)
SELECT id, least(f, lo) AS first_season, greatest(l, hi) AS last_season, (least(f, lo) IS DISTINCT FROM f OR greatest(l, hi) IS DISTINCT FROM l)::INT AS seeded
FROM c LEFT JOIN sp USING (id) LEFT JOIN att USING (id)
""")
def extend_spans(t):
    key = F.concat(F.col("c_nationkey"), F.col("c_mktsegment"), F.floor(F.col("c_acctbal") / 200))
    c = t.customer.select(F.col("c_custkey").alias("id"), key.alias("k"))
    spans = (t.orders.groupBy(F.col("o_custkey").alias("id"))
             .agg(F.min(F.year("o_orderdate")).alias("first_season"), F.max(F.year("o_orderdate")).alias("last_season")))
    attested = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("id"))
                .select("k", F.year("l_shipdate").alias("season")))
    out = resolve.seed_spans(c.join(spans, "id", "left"), attested, c, "id", "k", "season", "first_season", "last_season")
    return out.select("id", "first_season", "last_season", F.col("seeded").cast("int").alias("seeded"))


def observations(t):
    """Orders as observations of a name written in seven ways."""
    k = F.col("o_orderkey") % 7
    o = (spread(t.orders).select("o_orderkey", F.col("o_custkey").alias("id"), month_index("o_orderdate").alias("m"), F.col("o_orderpriority").alias("club"))
         .join(people(t), "id"))
    first = F.substring_index("nombre", " ", 1)
    raw = (F.when(k == 0, F.col("name")).when(k == 1, F.concat_ws(" ", "nombre", "apellidos"))
           .when(k == 2, F.concat_ws(", ", "seg", "nombre")).when(k == 3, F.concat(F.col("seg"), F.lit(", "), F.substring(first, 1, 1), F.lit(".")))
           .when(k == 4, F.concat(F.col("apellidos"), F.lit(", "), F.expr("left(nombre, length(nombre) - 1)")))
           .when(k == 5, F.col("seg")).otherwise(F.concat(F.col("name"), F.lit(" 'Ab"))))
    return o.select("o_orderkey", "m", "club", raw.alias("raw"))


def career_index(t):
    known = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderstatus") == "F")
    lines = (t.orders.select(F.when(known, F.col("o_custkey")).otherwise(-F.col("o_custkey") - 1).alias("id"), month_index("o_orderdate").alias("m"), F.col("o_orderpriority").alias("club")))
    spans = lines.groupBy("id").agg(F.min("m").alias("lo"), F.max("m").alias("hi"))
    return lines, spans


TOKENS = "array_to_string(list_sort(list_filter(string_split(replace({c}, ',', ''), ' '), lambda x: x <> '')), ' ')"
RESOLVE = f"""{PEOPLE}, ob AS (SELECT o_orderkey, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m, o_orderpriority AS club, o_orderkey % 7 AS v, fam, pat, giv, fst,
   CASE o_orderkey % 7 WHEN 0 THEN fam || ', ' || giv WHEN 1 THEN giv || ' ' || fam WHEN 2 THEN pat || ', ' || giv WHEN 3 THEN pat || ', ' || fst[1]
     WHEN 4 THEN fam || ', ' || giv[1:length(giv) - 1] WHEN 5 THEN pat ELSE fam || ', ' || giv || ' ab' END AS a, o_custkey
   FROM orders JOIN pp ON id = o_custkey),
 obs AS (SELECT *, {TOKENS.format(c='a')} AS tk FROM ob),
 ak AS (SELECT DISTINCT id, a FROM al), tk AS (SELECT DISTINCT id, {TOKENS.format(c='a')} AS tk FROM al),
 cr AS (SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F' THEN o_custkey ELSE -o_custkey - 1 END AS id,
   year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m, o_orderpriority AS club FROM orders),
 sp AS (SELECT id, min(m) - 1 AS lo, max(m) + 1 AS hi FROM cr GROUP BY id),
 near AS (SELECT DISTINCT id, club, unnest([m - 1, m, m + 1]) AS m FROM cr),
 tt AS (SELECT DISTINCT {TOKENS.format(c="fam || ' ' || giv")} AS tk,
   (year(o_orderdate) * 12 + month(o_orderdate) - 1) * CASE WHEN o_totalprice > 450000 THEN 1 ELSE -1 END AS m FROM orders JOIN pp ON id = o_custkey),
 c1 AS (SELECT o_orderkey, id FROM obs JOIN ak USING (a)),
 cand AS (FROM c1 UNION ALL SELECT o_orderkey, id FROM obs JOIN tk USING (tk) WHERE o_orderkey NOT IN (SELECT o_orderkey FROM c1)),
 clip AS (SELECT o_orderkey, pp.id FROM obs JOIN pp ON v = 6 AND obs.fam = pp.fam AND obs.giv = pp.giv),
 clip_all AS (SELECT DISTINCT o_orderkey, ak.id FROM obs JOIN ak ON v = 6 AND ak.a = obs.fam || ', ' || obs.giv),
 ot AS (SELECT *, string_split(CASE v WHEN 0 THEN giv WHEN 2 THEN giv WHEN 3 THEN fst[1] WHEN 4 THEN giv[1:length(giv) - 1] WHEN 6 THEN giv || ' ab' ELSE '' END, ' ') AS g,
   CASE WHEN v = 1 THEN fst ELSE pat END AS st FROM obs),
 trunc AS (SELECT DISTINCT o_orderkey, pp.id FROM ot JOIN pp ON ot.st = pp.pat WHERE g[1] <> '' AND length(g[-1]) >= 3
   AND len(g) <= len(string_split(pp.giv, ' ')) AND g[1:len(g) - 1] = string_split(pp.giv, ' ')[1:len(g) - 1]
   AND starts_with(string_split(pp.giv, ' ')[len(g)], g[-1]) AND string_split(pp.giv, ' ')[len(g)] <> g[-1]),
 sur AS (SELECT o_orderkey, pp.id FROM ot JOIN pp ON ot.st = pp.pat AND starts_with(pp.fst, ot.g[1])),
 fl AS (SELECT q.tier, q.o_orderkey, q.id, sp.id IS NOT NULL AS inspan, near.id IS NOT NULL AS club FROM (
    SELECT 'm' AS tier, * FROM cand UNION ALL SELECT 'c', * FROM clip_all UNION ALL SELECT 't', * FROM trunc UNION ALL SELECT 's', * FROM sur) q
   JOIN obs USING (o_orderkey) LEFT JOIN sp ON sp.id = q.id AND obs.m BETWEEN lo AND hi
   LEFT JOIN near ON near.id = q.id AND near.m = obs.m AND near.club = obs.club),
 st AS (SELECT o_orderkey, count(*) FILTER (WHERE tier = 'm') AS n, min(id) FILTER (WHERE tier = 'm') AS id0,
   count(*) FILTER (WHERE tier = 'm' AND inspan) AS corr, min(id) FILTER (WHERE tier = 'm' AND inspan) AS id1,
   count(*) FILTER (WHERE tier = 'm' AND club) AS nclub, min(id) FILTER (WHERE tier = 'm' AND club) AS id2,
   count(*) FILTER (WHERE tier = 'c' AND inspan) AS cc, min(id) FILTER (WHERE tier = 'c' AND inspan) AS id3,
   count(*) FILTER (WHERE tier = 't' AND inspan) AS tc, min(id) FILTER (WHERE tier = 't' AND inspan) AS id4,
   count(*) FILTER (WHERE tier = 's' AND club) AS sc, min(id) FILTER (WHERE tier = 's' AND club) AS id5 FROM fl GROUP BY 1),
 dec AS (SELECT o_orderkey, obs.m, obs.club, coalesce(n, 0) AS n_candidates, CASE WHEN corr = 1 THEN 'name+season_in_career' WHEN n = 1 AND tt.tk IS NOT NULL THEN 'name+season+title'
   WHEN corr > 1 AND nclub = 1 THEN 'name+season+club' WHEN n = 1 AND corr = 0 THEN 'unique name, season outside the known span'
   WHEN corr > 1 THEN 'several candidates in the season span' WHEN n > 0 THEN 'several candidates, none in the season span'
   WHEN cc = 1 OR tc = 1 THEN 'name+season+trunc' WHEN sc = 1 THEN 'surname+season+club' ELSE 'no canonical name match' END AS outcome,
   CASE WHEN corr = 1 THEN id1 WHEN n = 1 AND tt.tk IS NOT NULL THEN id0 WHEN corr > 1 AND nclub = 1 THEN id2 WHEN n > 0 THEN NULL
   WHEN cc = 1 THEN id3 WHEN tc = 1 THEN id4 WHEN sc = 1 THEN id5 END AS id
  FROM obs LEFT JOIN st USING (o_orderkey) LEFT JOIN tt ON tt.tk = obs.tk AND tt.m = obs.m)"""


@query("resolve_obs", f"""
WITH {RESOLVE}
SELECT o_orderkey, outcome, id, n_candidates, CASE WHEN id IS NULL THEN NULL WHEN EXISTS (FROM near WHERE near.id = dec.id AND near.m = dec.m AND near.club = dec.club) THEN 'confirms'
  WHEN EXISTS (FROM near WHERE near.id = dec.id AND near.m = dec.m) THEN 'contradicts' ELSE 'no_career_club' END AS club_check FROM dec
""")
def resolve_obs(t):
    p = people(t)
    index = resolve.candidate_index(p, aliases(t), "id", "apellidos", "nombre", "name")
    lines, spans = career_index(t)
    month = month_index("o_orderdate") * F.when(F.col("o_totalprice") > 450000, 1).otherwise(-1)
    titles = t.orders.join(p, F.col("o_custkey") == F.col("id")).select(text.token_sort_key("name").alias("name_key"), month.alias("m"))
    obs = resolve.observation_keys(observations(t), "raw")
    out = resolve.resolve_observations(obs, index, spans, lines, titles, "o_orderkey", "id", "m", "club").decided
    return out.select("o_orderkey", "outcome", "id", "n_candidates", "club_check")


@query("match_tiers", """
WITH c AS (SELECT p_partkey AS id, p_name AS fam, p_brand AS g, CASE WHEN p_size % 5 > 0 THEN 1950 + p_size END AS byr FROM part),
 o AS (SELECT p_partkey AS oid, p_name || CASE WHEN p_partkey % 3 = 0 THEN ' ' || lower(p_type) ELSE '' END AS fam, p_brand AS g,
   CASE WHEN p_partkey % 6 < 2 THEN 1950 + p_size END AS ex, CASE WHEN p_partkey % 6 IN (2, 3) THEN 1950 + p_size END AS ap FROM part),
 j AS (SELECT oid, ex, ap, count(id) AS n, count(id) FILTER (WHERE byr IS NULL) AS nb, min(id) AS lo, min(id) FILTER (WHERE byr IS NULL) AS lob,
   count(id) FILTER (WHERE byr = ex OR (ex IS NULL AND abs(byr - ap) <= 1)) AS na, min(id) FILTER (WHERE byr = ex OR (ex IS NULL AND abs(byr - ap) <= 1)) AS loa
  FROM o LEFT JOIN c ON c.g = o.g AND (starts_with(o.fam || ' ', c.fam || ' ') OR starts_with(c.fam || ' ', o.fam || ' ')) GROUP BY ALL),
 t AS (SELECT *, CASE WHEN n = 0 THEN '5_no_canonical_match' WHEN ex IS NULL AND ap IS NULL THEN CASE WHEN n = 1 THEN '3_no_birth_data_name_shape' ELSE '4_ambiguous_multi_candidate' END
   WHEN na = 1 THEN CASE WHEN ex IS NOT NULL THEN '1_exact_birth_confirmed' ELSE '2_approx_birth_confirmed' END WHEN na > 1 THEN '4_ambiguous_multi_candidate'
   WHEN nb = 1 AND n = nb THEN '3_no_birth_data_name_shape' WHEN nb > 0 THEN '4_ambiguous_multi_candidate' ELSE '5_no_canonical_match' END AS tier FROM j)
SELECT oid, tier, n AS n_candidates, CASE tier[1] WHEN '1' THEN loa WHEN '2' THEN loa WHEN '3' THEN CASE WHEN ex IS NULL AND ap IS NULL THEN lo ELSE lob END END AS candidate_id,
  CASE WHEN oid % 9 = 0 THEN 'confirmed_match' END AS disposition FROM t
""")
def match_tiers(t):
    k = F.col("p_partkey")
    year = (F.col("p_size") + 1950).cast("int")
    canon = t.part.select(k.alias("id"), text.name_tokens("p_name").alias("family"), F.col("p_brand").alias("given"),
                                            F.when(F.col("p_size") % 5 > 0, year).alias("birth_year"))
    fam = F.when(k % 3 == 0, F.concat_ws(" ", "p_name", "p_type")).otherwise(F.col("p_name"))
    obs = t.part.select(k.alias("oid"), text.name_tokens(fam).alias("family"), F.col("p_brand").alias("given"),
                                          F.when(k % 6 < 2, year).alias("exact_birth"), F.when((k % 6).isin(2, 3), year).alias("approx_birth"))
    prior = t.part.where(k % 9 == 0).select(k.alias("oid"), F.lit("confirmed_match").alias("disposition"))
    return (resolve.match_tiers(obs, canon, "oid", "id", prior)
            .select("oid", "tier", "n_candidates", "candidate_id", "disposition"))


@query("promote_rows", """
WITH m AS (SELECT l_orderkey AS season, l_partkey, min(l_suppkey) AS lo, max(l_suppkey) AS hi FROM lineitem GROUP BY ALL),
 c AS (SELECT season, l_partkey, CASE WHEN lo % 10 = 0 THEN lo + 1 ELSE lo END AS id FROM m WHERE lo <> hi),
 r AS (SELECT c.*, o_orderpriority FROM c JOIN orders ON season = CASE WHEN o_orderstatus <> 'P' THEN o_orderkey ELSE -o_orderkey - 1 END)
SELECT 'promoted' AS part, count(*) AS n_rows, sum(id)::BIGINT AS id_sum FROM r
UNION ALL SELECT 'untraced', count(*), sum(id)::BIGINT FROM c WHERE season IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT 'duplicates', count(*), NULL FROM (SELECT 1 FROM r GROUP BY id, season HAVING count(*) > 1)
""")
def promote_rows(t):
    m = (t.lineitem.groupBy(F.col("l_orderkey").alias("season"), "l_partkey")
         .agg(F.min("l_suppkey").alias("lo"), F.max("l_suppkey").alias("hi"))
         .select("season", "l_partkey", F.array("hi", "lo").alias("candidate_ids"),
                 F.when(F.col("lo") != F.col("hi"), "confirmed_match").otherwise("no_match").alias("disposition")))
    season = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).otherwise(-F.col("o_orderkey") - 1)
    raw = t.orders.select(season.alias("season"), "o_orderpriority")
    dead = t.supplier.where(F.col("s_suppkey") % 10 == 0).select(F.col("s_suppkey").alias("retired_id"), (F.col("s_suppkey") + 1).alias("survivor_id"))
    p = resolve.promote_confirmed(m, raw, ["season"], "id", ["id", "season"], dead)

    def part(name, df, total):
        return df.agg(F.count("*").alias("n_rows"), total.alias("id_sum")).select(F.lit(name).alias("part"), "*")

    return (part("promoted", p.rows, F.sum("id")).unionByName(part("untraced", p.untraced, F.sum("id")))
            .unionByName(part("duplicates", p.duplicates, F.max(F.lit(None).cast("long")))))


@query("apply_merges", """
WITH r AS (SELECT o_custkey AS old, CASE WHEN o_custkey % 20 = 7 THEN o_custkey + 1 ELSE o_custkey END AS id, year(o_orderdate) AS season, o_orderpriority AS team,
   o_orderstatus AS st FROM orders),
 held AS (SELECT DISTINCT id, season, team, st FROM r WHERE old = id),
 mv AS (SELECT *, (id, season, team, st) IN (SELECT (id, season, team, st) FROM held) AS h FROM r WHERE old <> id),
 kept AS (SELECT id, season, team, st FROM r WHERE old = id UNION ALL SELECT DISTINCT id, season, team, st FROM mv WHERE NOT h)
SELECT 'kept' AS part, season, count(*) AS n_rows, sum(id)::BIGINT AS id_sum FROM kept GROUP BY season
UNION ALL SELECT 'dropped', season, count(*) - count(DISTINCT CASE WHEN NOT h THEN (id, team, st) END), NULL FROM mv GROUP BY season
""")
def apply_merges(t):
    rows = t.orders.select(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("season"), F.col("o_orderpriority").alias("team"),
                           F.col("o_orderstatus").alias("st"))
    dead = t.customer.where(F.col("c_custkey") % 20 == 7).select(F.col("c_custkey").alias("retired_id"), (F.col("c_custkey") + 1).alias("survivor_id"))
    m = resolve.apply_merges(rows, dead, "id", ["season", "team", "st"], [F.col("team")])
    kept = m.rows.groupBy("season").agg(F.count("*").alias("n_rows"), F.sum("id").alias("id_sum")).withColumn("part", F.lit("kept"))
    gone = m.dropped.groupBy("season").agg(F.count("*").alias("n_rows")).withColumn("part", F.lit("dropped"))
    return kept.unionByName(gone, allowMissingColumns=True)


# --- one merge over all tables -----------------------------------------------------

RETIRED = """SELECT c_custkey AS k, CASE WHEN c_custkey % 400 = 12 OR c_custkey % 400 = 13 THEN c_custkey - 1 WHEN c_custkey % 400 = 11 OR c_custkey % 20 = 7 OR c_custkey % 40 = 8 THEN c_custkey + 1 END AS s FROM customer"""


def _merge_inputs(t):
    """Decisions with chains of two, cycles and a lead into one; five tables that name customers, each under another rule."""
    c, k = t.customer, F.col("c_custkey")
    decisions = c.select(k.alias("retired_id"), F.when((k % 400 == 12) | (k % 400 == 13), k - 1).when((k % 400 == 11) | (k % 20 == 7) | (k % 40 == 8), k + 1).alias("survivor_id"))
    named = c.select(k.alias("id"), F.col("c_name").alias("name"))
    alias = named.select("id", F.col("name").alias("alias"), F.lit("canonical").alias("alias_type")).unionByName(
        c.select(k.alias("id"), F.col("c_mktsegment").alias("alias"), F.lit("segment").alias("alias_type")))
    facts = t.orders.select(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("season"), F.col("o_orderpriority").alias("team"))
    roster = facts.where("id % 3 = 0 OR id % 20 = 7").distinct().select("id", "season", "team", F.lit("?").alias("name"))
    bios = c.where(k % 2 == 1).select(k.alias("id"), F.col("c_mktsegment").alias("text"))
    queue = t.orders.select("o_orderkey", F.array(F.col("o_custkey"), F.col("o_custkey") + 1, F.col("o_custkey") + 2).alias("candidates"))
    tables = {"canonical": (named, merges.Rule("canonical", "id", name="name")), "aliases": (alias, merges.Rule("alias", "id", ["alias", "alias_type"])),
              "career": (facts, merges.Rule("facts", "id", ["season", "team"])), "roster": (roster, merges.Rule("one", "id", ["season", "team"], name="name")),
              "bios": (bios, merges.Rule("one", "id")), "queue": (queue, merges.Rule("move", lists=["candidates"]))}
    return decisions, tables


MERGED = f"""
d AS ({RETIRED}), ok AS (SELECT k, s FROM d WHERE s IS NOT NULL AND k % 400 NOT IN (11, 12, 13)),
m AS (SELECT a.k, coalesce(b.s, a.s) AS s FROM ok a LEFT JOIN ok b ON b.k = a.s),
al AS (SELECT c_custkey AS id, c_name AS alias, 'canonical' AS kind FROM customer UNION ALL SELECT c_custkey, c_mktsegment, 'segment' FROM customer),
al2 AS (SELECT coalesce(s, id) AS id, alias, CASE WHEN s IS NOT NULL AND kind = 'canonical' THEN 'merged_name' ELSE kind END AS kind, s IS NOT NULL AS mv FROM al LEFT JOIN m ON k = id),
al3 AS (SELECT id FROM (SELECT *, row_number() OVER (PARTITION BY id, alias, kind ORDER BY mv) AS n FROM al2) WHERE NOT mv OR n = 1),
f AS (SELECT o_custkey AS id, year(o_orderdate) AS season, o_orderpriority AS team FROM orders),
f2 AS (SELECT coalesce(s, id) AS id, season, team, s IS NOT NULL AS mv FROM f LEFT JOIN m ON k = id),
f3 AS (SELECT id FROM (SELECT *, row_number() OVER (PARTITION BY id, season, team ORDER BY mv) AS n FROM f2) WHERE NOT mv OR n = 1),
r AS (SELECT DISTINCT id, season, team FROM f WHERE id % 3 = 0 OR id % 20 = 7),
r2 AS (SELECT coalesce(s, id) AS id, season, team, s IS NOT NULL AS mv FROM r LEFT JOIN m ON k = id),
r3 AS (SELECT *, count(*) OVER (PARTITION BY id, season, team) AS n FROM r2),
b2 AS (SELECT coalesce(s, c_custkey) AS id, s IS NOT NULL AS mv FROM customer LEFT JOIN m ON k = c_custkey WHERE c_custkey % 2 = 1),
b3 AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM b2),
q AS (SELECT o_orderkey, list_distinct(list_transform([o_custkey, o_custkey + 1, o_custkey + 2], lambda x: x)) AS l FROM orders),
q2 AS (SELECT o_orderkey, unnest(l) AS x FROM q), q3 AS (SELECT DISTINCT o_orderkey, coalesce(s, x) AS x FROM q2 LEFT JOIN m ON k = x)
"""


@query("merge_all_tables", f"""
WITH {MERGED}
SELECT 'canonical' AS part, count(*) AS n_rows, sum(c_custkey)::BIGINT AS id_sum FROM customer WHERE c_custkey NOT IN (SELECT k FROM m)
UNION ALL SELECT 'aliases', count(*), sum(id)::BIGINT FROM al3 UNION ALL SELECT 'career', count(*), sum(id)::BIGINT FROM f3
UNION ALL SELECT 'roster', count(*), sum(id)::BIGINT FROM r3 WHERE NOT mv OR n = 1 UNION ALL SELECT 'bios', count(*), sum(id)::BIGINT FROM b3 WHERE NOT mv OR n = 1
UNION ALL SELECT 'queue', count(*), sum(x)::BIGINT FROM q3
UNION ALL SELECT 'roster renamed', count(*), sum(id)::BIGINT FROM r3 WHERE mv AND n = 1
UNION ALL SELECT 'clashes', (SELECT count(*) FROM r3 WHERE mv AND n > 1) + (SELECT count(*) FROM b3 WHERE mv AND n > 1),
  ((SELECT coalesce(sum(id), 0) FROM r3 WHERE mv AND n > 1) + (SELECT coalesce(sum(id), 0) FROM b3 WHERE mv AND n > 1))::BIGINT
UNION ALL SELECT 'cyclic', count(*), sum(k)::BIGINT FROM d WHERE k % 400 IN (11, 12, 13)
UNION ALL SELECT 'dropped', (SELECT count(*) FROM al2) - (SELECT count(*) FROM al3) + (SELECT count(*) FROM f2) - (SELECT count(*) FROM f3), NULL
""")
def merge_all_tables(t):
    decisions, tables = _merge_inputs(t)
    chains = merges.resolve_chains(decisions)
    done = merges.merge_tables(tables, chains.survivors)

    def part(label, df, ident="id"):
        return df.agg(F.lit(label).alias("part"), F.count(F.lit(1)).alias("n_rows"), F.sum(ident).cast("long").alias("id_sum"))

    parts = [part(n, done.tables[n]) for n in ("canonical", "aliases", "career", "roster", "bios")]
    parts += [part("queue", done.tables["queue"].select(F.explode("candidates").alias("id"))), part("roster renamed", done.tables["roster"].where("name <> '?'")),
              part("clashes", done.clashes, "survivor_id"), part("cyclic", chains.cyclic, "retired_id"),
              done.dropped.agg(F.lit("dropped").alias("part"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.lit(None).cast("long").alias("id_sum"))]
    return reduce(DataFrame.unionByName, parts)


# --- close spellings of all names ---------------------------------------------------

SPELT = """SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN left(p_name, length(p_name) - 1) WHEN 2 THEN concat('xx', p_name)
  WHEN 3 THEN concat(chr(CAST(97 + p_partkey % 23 AS INT)), chr(CAST(97 + p_partkey % 26 AS INT)), chr(CAST(97 + p_partkey % 19 AS INT)), p_name, chr(CAST(97 + p_partkey % 17 AS INT)), chr(CAST(97 + p_partkey % 7 AS INT))) ELSE concat('johny', substr(p_name, strpos(p_name, ' '))) END AS name FROM part
  UNION ALL SELECT p_partkey, concat('johnny', substr(p_name, strpos(p_name, ' '))) FROM part WHERE p_partkey % 50 = 0 UNION ALL SELECT p_partkey, concat('pachin', substr(p_name, strpos(p_name, ' '))) FROM part WHERE p_partkey % 50 = 1
  UNION ALL SELECT p_partkey, concat('Juan', substr(p_name, strpos(p_name, ' '))) FROM part WHERE p_partkey % 50 = 2"""


@query("close_spellings", f"""
WITH n AS (SELECT lower(name) AS name FROM ({SPELT})), s AS (SELECT DISTINCT split_part(name, ' ', 1) AS g, split_part(name, ' ', -1) AS f FROM n),
p AS (SELECT a.g || ' ' || a.f AS a, b.g || ' ' || b.f AS b FROM s a JOIN s b ON a.g || ' ' || a.f < b.g || ' ' || b.f
  WHERE levenshtein(a.f, b.f) <= 1 AND (levenshtein(a.g, b.g) <= 2 OR (a.g || '>' || b.g) IN ('johny>johnny', 'johnny>johny', 'pachin>juan', 'juan>pachin', 'teo>teofilo', 'teofilo>teo'))),
e AS (SELECT a AS x, b AS y FROM p UNION ALL SELECT b, a FROM p)
SELECT g || ' ' || f AS spelling, count(y) AS n_close, min(y) AS first_close, any_value(c) AS n_members
FROM s LEFT JOIN e ON x = g || ' ' || f JOIN (SELECT split_part(name, ' ', 1) || ' ' || split_part(name, ' ', -1) AS z, count(*) AS c FROM n GROUP BY 1) ON z = g || ' ' || f GROUP BY g, f
""")
def close_spellings(t):
    t.part.createOrReplaceTempView("part")
    found = fuzzy.fuzzy_pairs(t.spark.sql(SPELT.replace("strpos(p_name, ' ')", "instr(p_name, ' ')")), "k", "name")
    ways = F.array(F.struct(F.col("a").alias("spelling"), F.col("b").alias("y")), F.struct(F.col("b").alias("spelling"), F.col("a").alias("y")))
    both = found.pairs.select(F.inline(ways))
    close = both.groupBy("spelling").agg(F.count("y").alias("n_close"), F.min("y").alias("first_close"))
    members = found.members.groupBy("spelling").agg(F.count(F.lit(1)).alias("n_members"))
    return (found.spellings.select("spelling").join(shuffled(close), "spelling", "left").join(shuffled(members), "spelling")
            .select("spelling", F.coalesce("n_close", F.lit(0).cast("long")).alias("n_close"), "first_close", "n_members"))
