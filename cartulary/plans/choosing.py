"""Scans, filters, deduplication, ordering and set operations over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text, urls
from ..operators import dedup, select, sets
from .base import query

D18 = "decimal(18,2)"


@query("scan_orders", """
SELECT o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders
""")
def scan_orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus",
                           F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))


@query("project_customers", """
SELECT c_custkey AS customer_id, nullif(replace(c_mktsegment, 'PROMO', ''), '') AS segment,
  CAST(c_acctbal AS INT) AS balance, CAST(c_acctbal < 0 AS INT) AS in_debt, nullif(substr(c_name, 1, CAST(c_custkey % 3 AS INT)), '') AS mark
FROM (SELECT c_custkey, c_mktsegment, c_name, trunc(c_acctbal) AS c_acctbal FROM customer)
""")
def project_customers(t):
    return select.project_typed(t.customer, {
        "customer_id": F.col("c_custkey"), "segment": F.replace("c_mktsegment", F.lit("PROMO"), F.lit("")),
        "balance": F.col("c_acctbal").cast("int"), "in_debt": (F.col("c_acctbal") <= -1).cast("int"),
        "mark": F.expr("substr(c_name, 1, cast(c_custkey % 3 as int))")})


@query("scoped_orders", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND year(o_orderdate) BETWEEN 1996 AND 1998
  AND o_orderdate >= TIMESTAMP '1996-01-01'
""")
def scoped_orders(t):
    scoped = (t.orders
              .where((F.col("o_orderdate") >= "1996-01-01") & (F.col("o_orderdate") < "1999-01-01"))
              .withColumns({"season": F.year("o_orderdate").cast("string"), "career": F.col("o_orderstatus") != "F",
                            "known": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "grp": F.lit(""),
                            "regular": F.lit(True)}))
    return (scoped.where(select.board_scope("season", "career", "grp", "known", "regular"))
            .select("o_orderkey", "o_custkey"))


@query("qb_seasons", """
SELECT o_orderkey, c_name, c_mktsegment, season FROM (
  SELECT o_orderkey, c_name, c_mktsegment, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE year(o_orderdate) END AS season
  FROM orders JOIN customer ON o_custkey = c_custkey)
WHERE (season IS NULL OR season BETWEEN 1997 AND 1998) AND c_mktsegment LIKE '%MACH%'
  AND lower(concat_ws(' ', o_orderkey, c_name, c_mktsegment, season)) LIKE '%#0000001%'
ORDER BY season DESC NULLS LAST, o_orderkey LIMIT 50
""")
def qb_seasons(t):
    rows = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "c_name", "c_mktsegment",
                    F.when(F.col("o_orderkey") % 11 != 0, F.year("o_orderdate")).alias("season")))
    datasets = {"orders": select.Dataset(rows, [F.col("season").desc_nulls_last(), F.col("o_orderkey")], "season", ["c_mktsegment"])}
    return select.query_named(datasets, "orders", year_from=1997, year_to=1998, club="Mach", contains="#0000001", limit=50)


@query("search_parts", """
SELECT p_partkey, p_name, p_type FROM part
WHERE lower(p_name || ' ' || p_type) LIKE '%ring%' AND lower(p_name || ' ' || p_type) LIKE '%promo%'
""")
def search_parts(t):
    return select.token_search(t.part, ["p_name", "p_type"], "Ríng  PROMO").select("p_partkey", "p_name", "p_type")


@query("facet_docs", """
SELECT doc_id, lang, source, n_chars FROM documents
WHERE (lang = 'en' OR source = 'en') AND regexp_replace(strip_accents(lower(concat_ws(' ', source, text))), '[«»"''.]', '', 'g')
  LIKE '%the th%'
""")
def facet_docs(t):
    return (select.facet_search(t.documents, F.array("lang", "source"), "en", ["source", "text"], "The th")
            .select("doc_id", "lang", "source", "n_chars"))


@query("select_pages", r"""
SELECT page_id, url FROM pages
WHERE url LIKE '%.example.com/%' AND NOT regexp_matches(url, '[?&]utm_') AND NOT regexp_matches(url, '/de/')
  AND NOT regexp_matches(url, '#top$')
""")
def select_pages(t):
    return (select.select_captures(t.pages, urls.host("url").endswith(".example.com"),
                                   [r"[?&]utm_", r"/de/", r"#top$"], "url").select("page_id", "url"))


@query("possible_vs_certain", """
SELECT lang, count(*) AS n_rows, count(*) FILTER (WHERE coalesce(quality = 1, true)) AS good_possible,
  count(*) FILTER (WHERE coalesce(quality = 1, false)) AS good_certain,
  count(*) FILTER (WHERE coalesce(toxic = 1 AND n_chars > 500, true)) AS bad_possible,
  count(*) FILTER (WHERE coalesce(toxic = 1 AND n_chars > 500, false)) AS bad_certain
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang
""")
def possible_vs_certain(t):
    known = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left")
    return select.possible_and_certain(known, ["lang"], {
        "good": F.col("quality") == 1, "bad": (F.col("toxic") == 1) & (F.col("n_chars") > 500)})


@query("supported_segments", """
SELECT lang, source, count(*) AS n_rows, round(avg(CAST(quality IS NOT NULL AS INT)), 6) AS resolved_share
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL
HAVING count(*) >= 15 AND avg(CAST(quality IS NOT NULL AS INT)) >= 0.4
""")
def supported_segments(t):
    known = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return (select.support_floor(known, ["lang", "source"], F.col("quality").isNotNull(), 15, 0.4)
            .withColumn("resolved_share", F.round("resolved_share", 6)))


# --- deduplication ---------------------------------------------------------

@query("latest_event", """
WITH e AS (SELECT user_id, event_type, ts, event_id, CAST(floor(value / 10) AS BIGINT) AS band FROM events),
 x AS (SELECT user_id, event_type, count(*) AS n_captures, count(DISTINCT band) AS n_variants,
   arg_max(band, struct_pack(ts := ts, e := event_id)) AS band, max(struct_pack(ts := ts, e := event_id)).e AS event_id
  FROM e GROUP BY ALL)
SELECT user_id, event_type, event_id, band, n_captures, n_variants,
  CASE WHEN n_variants > 1 THEN 'disputed' ELSE 'single-source' END AS confidence FROM x
""")
def latest_event(t):
    e = t.events.select("user_id", "event_type", "ts", "event_id", F.floor(F.col("value") / 10).alias("band"))
    return dedup.latest_wins(e, ["user_id", "event_type"], ["ts", "event_id"], ["band"]).latest.drop("ts")


@query("event_variants", """
SELECT user_id, event_type, CAST(floor(value / 10) AS BIGINT) AS band, count(*) AS n_captures FROM events GROUP BY ALL
""")
def event_variants(t):
    e = t.events.select("user_id", "event_type", "ts", "event_id", F.floor(F.col("value") / 10).alias("band"))
    return dedup.latest_wins(e, ["user_id", "event_type"], ["ts", "event_id"], ["band"]).variants


@query("latest_batch", """
WITH l AS (SELECT o_custkey, o_orderdate, l_orderkey, l_linenumber, l_partkey, l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date, l_orderkey, l_linenumber, l_partkey, l_quantity
FROM l QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1
""")
def latest_batch(t):
    lines = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
             .select("o_custkey", "o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"))
    return (dedup.latest_batch(lines, ["o_custkey"], "o_orderdate")
            .select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
                    "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"))


@query("first_order", """
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
""")
def first_order(t):
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return (dedup.keep_first(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
            .select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date")))


@query("fullest_doc", r"""
WITH d AS (SELECT doc_id, lang, n_chars, source,
  md5(trim(regexp_replace(strip_accents(lower(text)), '[«»"''.]', '', 'g'))) AS folded FROM documents)
SELECT lang, folded, doc_id, n_chars FROM d
QUALIFY row_number() OVER (PARTITION BY lang, folded ORDER BY n_chars DESC, doc_id) = 1
""")
def fullest_doc(t):
    d = t.documents.select("lang", F.md5(text.search_fold("text")).alias("folded"), "doc_id", "n_chars")
    return dedup.keep_fullest(d, ["lang", "folded"], [F.col("n_chars")], [F.col("doc_id")])


@query("top_lineitem", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) = 1
""")
def top_lineitem(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return dedup.best_by_measure(rows, ["l_orderkey"], F.col("l_extendedprice"),
                                 [F.col("l_linenumber"), F.col("l_partkey")])


@query("distinct_obs", """
SELECT DISTINCT src, name, season FROM (
  SELECT 'part' AS src, p_name AS name, p_size AS season FROM part
  UNION ALL SELECT 'segment', c_mktsegment, c_nationkey FROM customer
  UNION ALL SELECT 'priority', o_orderpriority, year(o_orderdate) FROM orders)
""")
def distinct_obs(t):
    return dedup.distinct_observations([
        t.part.select(F.lit("part").alias("src"), F.col("p_name").alias("name"), F.col("p_size").alias("season")),
        t.customer.select(F.lit("segment").alias("src"), F.col("c_mktsegment").alias("name"),
                          F.col("c_nationkey").alias("season")),
        t.orders.select(F.lit("priority").alias("src"), F.col("o_orderpriority").alias("name"),
                        F.year("o_orderdate").alias("season")),
    ], ["src", "name", "season"])


@query("exact_dupes", """
SELECT doc_id, sha256(text) AS digest, min(doc_id) OVER (PARTITION BY text) AS representative,
  count(*) OVER (PARTITION BY text) AS n_copies FROM documents
""")
def exact_dupes(t):
    return dedup.digest_representative(t.documents.select("doc_id", "text"), "text", "doc_id")


@query("ranked_pages", r"""
WITH p AS (SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) AS host,
  CAST(position('?' IN url) > 0 AS INT) AS q, length(html) AS n FROM pages)
SELECT host, page_id, CAST(row_number() OVER (PARTITION BY host ORDER BY q, n DESC, page_id) AS INT) AS candidate_rank
FROM p QUALIFY candidate_rank <= 3
""")
def ranked_pages(t):
    p = t.pages.select(urls.host("url").alias("host"), "page_id", urls.is_parametrised("url").cast("int").alias("q"),
                       F.length("html").alias("n"))
    return (dedup.ranked_candidates(p, ["host"], [F.col("q"), F.col("n").desc(), F.col("page_id")], 3)
            .drop("q", "n"))


@query("merged_parties", """
WITH p AS (
  SELECT c_nationkey AS nation, 1 AS pri, c_custkey AS id, c_acctbal AS bal, c_mktsegment AS segment FROM customer
  UNION ALL SELECT s_nationkey, 2, s_suppkey, s_acctbal, NULL FROM supplier),
 f AS (SELECT nation, min(struct_pack(p := pri, i := id, s := segment)) FILTER (WHERE segment IS NOT NULL) AS seg FROM p
  WHERE id % 7 > 0 GROUP BY nation)
SELECT p.nation, max(bal) AS top_balance, count(DISTINCT segment) AS n_segments, any_value(f.seg.s) AS segment,
  count(DISTINCT pri) AS n_sources
FROM p LEFT JOIN f USING (nation) GROUP BY p.nation
""")
def merged_parties(t):
    known = F.when(F.col("c_custkey") % 7 > 0, F.col("c_mktsegment"))
    both = (t.customer.select(F.col("c_nationkey").alias("nation"), F.struct(F.lit(1).alias("p"), F.col("c_custkey").alias("i")).alias("pri"),
                              F.col("c_acctbal").alias("top_balance"), known.alias("segment"),
                              F.col("c_mktsegment").alias("seg_all"), F.lit(1).alias("src"))
            .unionByName(t.supplier.select(
                F.col("s_nationkey").alias("nation"), F.struct(F.lit(2).alias("p"), F.col("s_suppkey").alias("i")).alias("pri"),
                F.col("s_acctbal").alias("top_balance"), F.lit(None).cast("string").alias("segment"),
                F.lit(None).cast("string").alias("seg_all"), F.lit(2).alias("src"))))
    return dedup.merge_sources(both, "nation", "pri", ["segment"], ["top_balance"],
                               {"n_segments": "seg_all", "n_sources": "src"})


# --- sorting and paging ----------------------------------------------------

@query("sorted_nulls", """
SELECT doc_id, quality, n_chars, row_number() OVER (ORDER BY quality ASC NULLS FIRST, n_chars DESC NULLS LAST, doc_id)
  AS position FROM documents LEFT JOIN labels USING (doc_id)
""")
def sorted_nulls(t):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    order = [select.sort_order("quality", "number"), select.sort_order("n_chars", "number", True), F.col("doc_id")]
    return select.numbered_sort(rows, order)


@query("page_orders", """
SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders) AS n_total FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 50
""")
def page_orders(t):
    return select.page(t.orders.select("o_orderkey", "o_totalprice"),
                       [F.col("o_totalprice").desc(), F.col("o_orderkey")], 50, 25)


@query("recent_orders", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders
ORDER BY o_orderdate DESC, o_orderkey LIMIT 40
""")
def recent_orders(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return (select.recent(rows, [F.col("o_orderdate").desc(), F.col("o_orderkey")], 40)
            .select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date")))


# --- set operations --------------------------------------------------------

@query("union_names", """
SELECT source_id, name, segment, brand, count(*) AS n FROM (
  SELECT 'customer' AS source_id, c_name AS name, c_mktsegment AS segment, NULL AS brand FROM customer
  UNION ALL SELECT 'part', p_name, NULL, p_brand FROM part) GROUP BY ALL
""")
def union_names(t):
    u = sets.union_sources({
        "customer": t.customer.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
        "part": t.part.select(F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))})
    return u.groupBy("source_id", "name", "segment", "brand").agg(F.count("*").alias("n"))


@query("key_spine", """
WITH d AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders),
 l AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem),
 e AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events)
SELECT day, CAST(d.day IS NOT NULL AS INT) AS has_order, CAST(l.day IS NOT NULL AS INT) AS has_line,
  CAST(e.day IS NOT NULL AS INT) AS has_event
FROM (FROM d UNION FROM l UNION FROM e) s LEFT JOIN d USING (day) LEFT JOIN l USING (day) LEFT JOIN e USING (day)
""")
def key_spine(t):
    def days(df, c, flag):
        return df.select(F.date_format(c, "yyyy-MM-dd").alias("day")).distinct().withColumn(flag, F.lit(1))

    parts = [days(t.orders, "o_orderdate", "has_order"), days(t.lineitem, "l_shipdate", "has_line"),
             days(t.events, "ts", "has_event")]
    out = sets.key_spine(parts, ["day"])
    for p in parts:
        out = out.join(p, "day", "left")
    return out.fillna(0, ["has_order", "has_line", "has_event"])


@query("diff_snapshots", """
SELECT change, count(*) AS n_keys, sum(o_orderkey) AS key_sum FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'added' WHEN o_orderkey % 10 = 1 THEN 'removed'
    WHEN o_orderkey % 10 = 2 THEN 'changed' END AS change FROM orders)
WHERE change IS NOT NULL GROUP BY change
""")
def diff_snapshots(t):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey") % 10
    old = o.where(k != 0)
    new = o.where(k != 1).withColumn("o_totalprice", F.when(k == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return (sets.snapshot_diff(old, new, ["o_orderkey"]).groupBy("change")
            .agg(F.count("*").alias("n_keys"), F.sum("o_orderkey").alias("key_sum")))


@query("fill_gaps", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderstatus ELSE o_orderpriority END AS label,
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS footnote,
  CASE WHEN o_orderstatus = 'F' THEN 'base' ELSE 'addition' END AS origin
FROM orders
""")
def fill_gaps(t):
    base = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", F.col("o_orderstatus").alias("label"))
    more = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("label"))
    return sets.fill_gaps(base, more, ["o_orderkey"], value="label")


@query("key_gaps", """
WITH l AS (SELECT DISTINCT CASE WHEN l_quantity > 25 THEN l_orderkey ELSE -l_orderkey - 1 END AS k FROM lineitem)
SELECT o_orderkey AS k, 'left_only' AS side FROM orders WHERE o_orderkey NOT IN (FROM l)
UNION ALL SELECT k, 'right_only' FROM l WHERE k NOT IN (SELECT o_orderkey FROM orders)
""")
def key_gaps(t):
    ledger = t.orders.select(F.col("o_orderkey").alias("k"))
    k = F.when(F.col("l_quantity") > 25, F.col("l_orderkey")).otherwise(-F.col("l_orderkey") - 1)
    lines = t.lineitem.select(k.alias("k")).distinct()
    return sets.key_differences(ledger, lines, ["k"])
