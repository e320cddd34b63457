"""Pages, publishing, quality checks and streams over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import quality
from ..operators.skew import fill_down
from ..session import shared_folder
from ..sources import manifests as mf
from ..sources import pages as pg
from ..sources import tables as tb
from ..streaming import ingest, state
from .base import query
from .summaries import ID_RANGE

HOST = "lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1))"


@query("pages_with_meta", f"""
WITH h AS (SELECT {HOST} AS host, count(*) AS n_pages, min(page_id) AS first_page FROM pages GROUP BY 1)
SELECT page_id, h.host, n_pages, first_page, md5(html) AS digest FROM pages JOIN h ON h.host = {HOST}
""")
def pages_with_meta(t):
    p = t.pages.withColumn("host", urls.host("url"))
    meta = p.groupBy("host").agg(F.count("*").alias("n_pages"), F.min("page_id").alias("first_page"))
    return pg.pages_with_context(p, meta, "host").select("page_id", "host", "n_pages", "first_page", F.md5("html").alias("digest"))


@query("page_elements", r"""
SELECT page_id, CAST(i - 1 AS INT) AS position, trim(regexp_replace(regexp_replace(x[i], '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))
  .replace('&lt;', '<').replace('&gt;', '>').replace('&amp;', '&') AS item
FROM (SELECT page_id, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1) AS x FROM pages))
""")
def page_elements(t):
    return pg.list_items(t.pages, "page_id", "html")


@query("page_links", r"""
SELECT page_id, CAST(i - 1 AS INT) AS position, x[i] AS link
FROM (SELECT page_id, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT page_id, list_transform(regexp_extract_all(html, '(?i)<a\s[^>]*?\bhref\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1), lambda l: regexp_replace(l, '^["'']|["'']$', '', 'g')) AS x FROM pages))
""")
def page_links(t):
    return pg.page_links(t.pages, "page_id", "html")


@query("linked_ids", r"""
SELECT page_id, count(*) AS n_links, count(DISTINCT regexp_extract(link, '^/([A-Za-z]+)$', 1)) AS n_ids
FROM (SELECT page_id, unnest(list_transform(regexp_extract_all(html, '(?i)<a\s[^>]*?\bhref\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1), lambda l: regexp_replace(l, '^["'']|["'']$', '', 'g'))) AS link FROM pages)
WHERE regexp_matches(link, '^/([A-Za-z]+)$') GROUP BY page_id
""")
def linked_ids(t):
    ids = pg.link_ids(pg.page_links(t.pages, "page_id", "html"), r"^/([A-Za-z]+)$")
    return ids.groupBy("page_id").agg(F.count("*").alias("n_links"), F.count_distinct("entity_id").alias("n_ids"))


@query("page_context", r"""
SELECT page_id, coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), '') AS page_no,
  coalesce(nullif(regexp_extract(html, '<html[^>]*lang="([a-z]+)"', 1), ''), nullif(regexp_extract(url, '://[^/]+/([a-z]{2})/', 1), '')) AS lang
FROM pages
""")
def page_context(t):
    declared = F.nullif(F.regexp_extract("html", r'<html[^>]*lang="([a-z]+)"', 1), F.lit(""))
    in_path = F.nullif(F.regexp_extract(urls.path("url"), r"^/([a-z]{2})/", 1), F.lit(""))
    return t.pages.select("page_id", F.coalesce(pg.page_parameter("url", "html", "page", ("page", "sel")), F.lit("")).alias("page_no"),
                          F.coalesce(declared, in_path).alias("lang"))


@query("page_text_stats", r"""
WITH s AS (SELECT page_id, html, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html,
   '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
   '[\s\v\x{1C}-\x{1F}\x{85}\p{Z}]+', ' ', 'g')) AS txt FROM pages)
SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title,
  length(txt) AS n_text, len(string_split(txt, ' ')) AS n_words, md5(txt) AS text_md5 FROM s
""")
def page_text_stats(t):
    s = t.pages.select("page_id", pg.page_title("html").alias("title"), pg.strip_tags("html").alias("txt"))
    return s.select("page_id", "title", F.length("txt").cast("long").alias("n_text"), F.size(F.split("txt", " ")).cast("long").alias("n_words"),
                    F.md5("txt").alias("text_md5"))


@query("route_pages", """
WITH r AS (SELECT CASE WHEN lower(html) LIKE '%<table%' THEN 'table' WHEN html LIKE '%<article%' THEN 'article' WHEN html LIKE '%<h1%' THEN 'headline'
   ELSE 'plain' END AS template, length(html) AS n FROM pages)
SELECT template, CASE template WHEN 'table' THEN 'full' WHEN 'article' THEN 'full' ELSE 'partial' END AS completeness, count(*) AS n_pages, max(n) AS longest FROM r GROUP BY ALL
""")
def route_pages(t):
    h = F.col("html")
    tpl = pg.route_template(h, [("table", F.contains(F.lower(h), F.lit("<table"))), ("article", h.contains("<article")), ("headline", h.contains("<h1"))], "plain")
    return (t.pages.select(tpl.alias("template"), F.length("html").cast("long").alias("n"))
            .withColumn("completeness", F.when(F.col("template").isin("table", "article"), "full").otherwise("partial"))
            .groupBy("template", "completeness").agg(F.count("*").alias("n_pages"), F.max("n").alias("longest")))


@query("reject_pages", r"""
WITH r AS (SELECT CASE WHEN contains(html, 'ADODB.') OR contains(html, 'BOF or EOF') OR contains(html, 'Microsoft OLE DB') THEN 'database_error'
  WHEN contains(html, 'goCaptcha') OR contains(html, 'captchacode') THEN 'challenge'
  WHEN regexp_matches(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '(?i)###|error|not found') THEN 'error_title'
  WHEN len(regexp_extract_all(html, 'href="/The"')) >= 2 THEN 'wrong_subject' END AS reject_reason FROM pages)
SELECT coalesce(reject_reason, 'kept') AS outcome, count(*) AS n_pages FROM r GROUP BY 1
""")
def reject_pages(t):
    reason = pg.reject_reason("html", r'href="/The"', 2, r"(?i)###|error|not found")
    kept, rejected = pg.split_rejected(t.pages.select("page_id", "html"), reason)
    return (kept.select(F.lit("kept").alias("outcome")).unionByName(rejected.select(F.col("reject_reason").alias("outcome")))
            .groupBy("outcome").agg(F.count("*").alias("n_pages")))


@query("coalesced_totals", """
WITH s AS (SELECT l_orderkey, CASE WHEN count(q) = count(*) THEN sum(q)::BIGINT END AS s FROM (SELECT l_orderkey, CASE WHEN l_discount < 0.1 THEN CAST(l_quantity AS BIGINT) END AS q FROM lineitem) GROUP BY 1)
SELECT o_orderkey AS order_key, CASE WHEN o_orderstatus = 'F' THEN 'stated' WHEN s IS NOT NULL THEN 'summed' ELSE 'unknown' END AS score_source,
  CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice / 10000) AS BIGINT) ELSE s END AS score
FROM orders LEFT JOIN s ON l_orderkey = o_orderkey
""")
def coalesced_totals(t):
    stated = t.orders.select(F.col("o_orderkey").alias("order_key"),
                             F.when(F.col("o_orderstatus") == "F", F.floor(F.col("o_totalprice") / 10000)).alias("total"))
    parts = t.lineitem.select(F.col("l_orderkey").alias("order_key"), F.when(F.col("l_discount") < 0.1, F.col("l_quantity").cast("long")).alias("q"))
    return pg.coalesced_score(stated, parts, "order_key", "total", "q").drop("total")


@query("fill_down_groups", """
SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS group_label FROM events
""")
def fill_down_groups(t):
    e = t.events.select("event_id", "user_id", "ts", F.when(F.col("event_type") == "signup", F.col("event_id")).alias("mark"))
    return fill_down(e, ["user_id"], [F.col("ts").cast("date"), F.date_trunc("minute", "ts")], ["ts", "event_id"], "mark", "group_label").select("event_id", "group_label")


# --- publishing and logs -----------------------------------------------------

@query("publish_customer_docs", """
WITH n AS (SELECT o_custkey, o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS pri,
   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT o_custkey, CAST((rn - 1) // 8 AS INT) AS part, '{"count":' || count(*) || ',"o_custkey":' || o_custkey || ',"part":' || (rn - 1) // 8 || ',"rows":[' ||
  string_agg('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","pri":' || CASE WHEN pri IS NULL THEN 'null' ELSE '"' || pri || '"' END || '}', ',' ORDER BY rn) || ']}' AS doc
FROM n GROUP BY o_custkey, (rn - 1) // 8
""")
def publish_customer_docs(t):
    o = t.orders.withColumn("pri", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))
    return tb.publish_entities(o, "o_custkey", ["o_orderkey", "o_orderstatus", "pri"],
                               [F.col("o_orderdate"), F.floor(F.col("o_orderkey") / ID_RANGE)],
                               [F.col("o_orderdate"), F.col("o_orderkey")], 8)


@query("upsert_orders_log", """
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'revised' ELSE o_orderstatus END AS state,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'new' ELSE 'old' END AS origin FROM orders
""")
def upsert_orders_log(t):
    old = t.orders.where(F.col("o_orderdate") < "1999-01-01").select("o_orderkey", F.col("o_orderstatus").alias("state"), F.lit("old").alias("origin"))
    new = t.orders.where(F.col("o_orderdate") >= "1998-01-01").select("o_orderkey", F.lit("revised").alias("state"), F.lit("new").alias("origin"))
    return tb.upsert_log(old, new, ["o_orderkey"])


SECTIONS = """
SELECT {e} AS entity, '{n}' AS section, CAST((rn - 1) // 50 AS INT) AS part, '{{"count":' || count(*) || ',"entity":' || {e} || ',"part":' || (rn - 1) // 50 || ',"rows":[' ||
  string_agg({row}, ',' ORDER BY rn) || ']}}' AS doc FROM ({src}) GROUP BY {e}, (rn - 1) // 50"""


@query("publish_nation_sections", SECTIONS.format(
    e="c_nationkey", n="customers", row="""'{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}'""",
    src="SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer") + " UNION ALL " + SECTIONS.format(
    e="s_nationkey", n="suppliers", row="""'{"s_suppkey":' || s_suppkey || '}'""",
    src="SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier"))
def publish_nation_sections(t):
    return tb.publish_sections({
        "customers": tb.Section(t.customer.withColumnRenamed("c_nationkey", "entity"), ["c_custkey", "c_mktsegment"],
                                F.floor(F.col("c_custkey") / ID_RANGE), [F.col("c_custkey")]),
        "suppliers": tb.Section(t.supplier.withColumnRenamed("s_nationkey", "entity"), ["s_suppkey"],
                                F.floor(F.col("s_suppkey") / ID_RANGE), [F.col("s_suppkey")]),
    }, "entity", 50)


#: Columns of all tables and how SQL writes their values: i whole numbers, s texts, d doubles, t times, a lists of floats.
LAYOUT = {
    "region": "r_name:s r_regionkey:i", "nation": "n_name:s n_nationkey:i n_regionkey:i", "customer": "c_acctbal:d c_custkey:i c_mktsegment:s c_name:s c_nationkey:i",
    "supplier": "s_acctbal:d s_name:s s_nationkey:i s_suppkey:i", "part": "p_brand:s p_name:s p_partkey:i p_retailprice:d p_size:i p_type:s",
    "orders": "o_custkey:i o_orderdate:t o_orderkey:i o_orderpriority:s o_orderstatus:s o_totalprice:d",
    "lineitem": "l_discount:d l_extendedprice:d l_linenumber:i l_linestatus:s l_orderkey:i l_partkey:i l_quantity:d l_returnflag:s l_shipdate:t l_suppkey:i l_tax:d",
    "events": "event_id:i event_type:s props:s ts:t user_id:i value:d", "documents": "doc_id:i lang:s n_chars:i source:s text:s", "embeddings": "embedding:a label:i vec_id:i",
    "pages": "html:s page_id:i url:s", "benchmark": "item_id:i text:s", "labels": "doc_id:i quality:i toxic:i", "conversations": "conv_id:i role:s text:s turn:i"}
_DOUBLE = "floor({0})::BIGINT || '.' || floor(({0} - floor({0})) * 4503599627370496)::BIGINT"
_SHOWN = {"i": "{0}::VARCHAR", "s": "{0}", "d": _DOUBLE, "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
          "a": "'[' || array_to_string(list_transform({0}, lambda y: strlen(" + _DOUBLE.format("y::DOUBLE") + ") || ':' || " + _DOUBLE.format("y::DOUBLE") + "), ',') || ']'"}


def _row(columns: str) -> str:
    parts = [(c, _SHOWN[k].format(c)) for c, k in (x.split(":") for x in columns.split())]
    return " || ".join(f"'{c}=' || CASE WHEN {c} IS NULL THEN '~' ELSE strlen({v}) || ':' || ({v}) END" for c, v in parts)


TABLE_ROWS = " UNION ALL ".join(f"""
SELECT '{x}' AS table_name, count(*) AS n_rows, bit_xor(('0x' || substr(d, 1, 15))::BIGINT) AS xor_1, sum(('0x' || substr(d, 16, 12))::BIGINT)::VARCHAR AS sum_2
FROM (SELECT sha256({_row(columns)}) AS d FROM {x})""" for x, columns in LAYOUT.items())


def manifest_of(t):
    return mf.table_manifest(mf.file_digests(t.spark, {x: f"{t.sf_dir}/{x}.parquet" for x in LAYOUT}))


@query("table_manifest", TABLE_ROWS)
def table_manifest(t):
    return manifest_of(t)


@query("archive_version", f"""
WITH m AS ({TABLE_ROWS})
SELECT sha256('rev-1|' || string_agg(table_name || ':' || n_rows || ':' || xor_1 || ':' || sum_2, '|' ORDER BY table_name)) AS version, sum(n_rows)::BIGINT AS n_rows FROM m
""")
def archive_version(t):
    return tb.version(manifest_of(t), "rev-1")


# --- checks --------------------------------------------------------------------

def _int_passed(df):
    return df.withColumn("passed", F.col("passed").cast("int"))


@query("check_unique_keys", """
SELECT 'orders key' AS check_name, count(*) AS n_checked, count(*) FILTER (WHERE n > 1) AS n_failed, (count(*) FILTER (WHERE n > 1) = 0)::INT AS passed FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)
UNION ALL SELECT 'line key', count(*), count(*) FILTER (WHERE n > 1), (count(*) FILTER (WHERE n > 1) = 0)::INT FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
""")
def check_unique_keys(t):
    return _int_passed(quality.suite(quality.check_unique(t.orders, "orders key", ["o_orderkey"]),
                                     quality.check_unique(t.lineitem, "line key", ["l_orderkey", "l_linenumber"])))


RULES = {"required": "o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND trim(o_orderstatus) <> ''", "status": "o_orderstatus IN ('F', 'O')",
         "priority": "regexp_matches(o_orderpriority, '^[1-5]-[A-Z]+$')", "price": "o_totalprice BETWEEN 0 AND 499000",
         "year": "year(o_orderdate) BETWEEN 1990 AND 2005"}


@query("check_rules", " UNION ALL ".join(f"""SELECT '{n}' AS check_name, count(*) AS n_checked, count(*) FILTER (WHERE NOT coalesce({c}, false)) AS n_failed,
  (count(*) FILTER (WHERE NOT coalesce({c}, false)) = 0)::INT AS passed FROM orders""" for n, c in RULES.items()))
def check_rules(t):
    return _int_passed(quality.check_rules(t.orders, {
        "required": quality.required("o_orderkey", "o_custkey", "o_orderstatus"), "status": F.col("o_orderstatus").isin("F", "O"),
        "priority": F.col("o_orderpriority").rlike("^[1-5]-[A-Z]+$"), "price": F.col("o_totalprice").between(0, 499000),
        "year": F.year("o_orderdate").between(1990, 2005)}))


@query("check_fk", """
SELECT check_name, n_checked, n_failed, (n_failed = 0)::INT AS passed FROM (
  SELECT 'line to order' AS check_name, count(*) AS n_checked, count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS n_failed FROM lineitem
  UNION ALL SELECT 'line to part', count(*), count(*) FILTER (WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) FROM lineitem
  UNION ALL SELECT 'line to supplier', count(*), count(*) FILTER (WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)) FROM lineitem
  UNION ALL SELECT 'order has lines', count(*), count(*) FILTER (WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) FROM orders
  UNION ALL SELECT 'no label on junk', count(*), count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM documents WHERE n_chars < 50)) FROM labels)
""")
def check_fk(t):
    junk = t.documents.where(F.col("n_chars") < 50).select("doc_id")
    return _int_passed(quality.suite(
        quality.check_references(t.lineitem, {"line to order": ("l_orderkey", t.orders, "o_orderkey"), "line to part": ("l_partkey", t.part, "p_partkey"),
                                              "line to supplier": ("l_suppkey", t.supplier, "s_suppkey")}),
        quality.check_reference(t.orders, "order has lines", "o_orderkey", t.lineitem, "l_orderkey"),
        quality.check_reference(t.labels, "no label on junk", "doc_id", junk, "doc_id", forbidden=True)))


@query("check_rates", """
SELECT 'returned' AS check_name, count(*) AS n_checked, count(*) FILTER (WHERE l_returnflag <> 'R') AS n_failed, (avg((l_returnflag = 'R')::INT) BETWEEN 0.3 AND 0.4)::INT AS passed FROM lineitem
UNION ALL SELECT 'full price', count(*), count(*) FILTER (WHERE l_discount <> 0), (avg((l_discount = 0)::INT) BETWEEN 0.5 AND 1.0)::INT FROM lineitem
""")
def check_rates(t):
    return _int_passed(quality.check_rates(t.lineitem, {"returned": (F.col("l_returnflag") == "R", 0.3, 0.4), "full price": (F.col("l_discount") == 0, 0.5, 1.0)}))


@query("check_exclusive", """
WITH a AS (SELECT DISTINCT doc_id FROM labels), b AS (SELECT DISTINCT CASE WHEN n_chars > 2000 THEN doc_id ELSE -doc_id - 1 END AS doc_id FROM documents)
SELECT 'labelled or long' AS check_name, (SELECT count(*) FROM (FROM a UNION FROM b)) AS n_checked, (SELECT count(*) FROM (FROM a INTERSECT FROM b)) AS n_failed,
  ((SELECT count(*) FROM (FROM a INTERSECT FROM b)) = 0)::INT AS passed
""")
def check_exclusive(t):
    doc = F.when(F.col("n_chars") > 2000, F.col("doc_id")).otherwise(-F.col("doc_id") - 1)
    return _int_passed(quality.check_exclusive(t.labels, t.documents.select(doc.alias("doc_id")), "labelled or long", ["doc_id"]))


@query("check_totals", """
WITH l AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT 'lines per order' AS check_name, count(*) AS n_checked, count(*) FILTER (WHERE n IS NULL OR n <> o_orderkey % 8) AS n_failed,
  (count(*) FILTER (WHERE n IS NULL OR n <> o_orderkey % 8) = 0)::INT AS passed
FROM orders FULL JOIN l ON l_orderkey = o_orderkey
""")
def check_totals(t):
    stated = t.orders.select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 8).alias("n"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("k"))
    return _int_passed(quality.check_totals(stated, lines, "lines per order", ["k"], "n", F.count("*")))


@query("check_published", """
SELECT 'orders copy' AS check_name, (SELECT count(DISTINCT (o_orderkey, o_custkey)) FROM orders) + (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS n_checked,
  2 * (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS n_failed, ((SELECT count(*) FROM orders WHERE o_orderstatus = 'P') = 0)::INT AS passed
""")
def check_published(t):
    a = t.orders.select("o_orderkey", "o_custkey")
    b = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", -F.col("o_custkey") - 1).otherwise(F.col("o_custkey")).alias("o_custkey"))
    return _int_passed(quality.check_same_rows(a, b, "orders copy"))


@query("scan_text", r"""
WITH k AS (SELECT regexp_matches(text, '\x{FFFD}|Ã[\x{80}-\x{BF}]|Â[\x{80}-\x{BF}]') AS d, regexp_matches(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]') AS c,
  regexp_matches(text, '^[^a-z]+$') AS u FROM documents)
SELECT 'text: damaged' AS check_name, count(*) AS n_checked, count(*) FILTER (WHERE d) AS n_failed, (count(*) FILTER (WHERE d) = 0)::INT AS passed FROM k
UNION ALL SELECT 'text: control', count(*), count(*) FILTER (WHERE c), (count(*) FILTER (WHERE c) = 0)::INT FROM k
UNION ALL SELECT 'text: no lower case', count(*), count(*) FILTER (WHERE u), (count(*) FILTER (WHERE u) = 0)::INT FROM k
""")
def scan_text(t):
    return _int_passed(quality.scan_text(t.documents, ["text"], {"damaged": quality.DAMAGED, "control": quality.CONTROL, "no lower case": "^[^a-z]+$"}))


@query("quality_report", """
SELECT check_name, n_checked, n_failed, (n_failed = 0)::INT AS passed FROM (
 SELECT 'customer key' AS check_name, count(DISTINCT c_custkey) AS n_checked, count(*) - count(DISTINCT c_custkey) AS n_failed FROM customer
 UNION ALL SELECT 'part price', count(*), count(*) FILTER (WHERE NOT (p_retailprice > 0)) FROM part
 UNION ALL SELECT 'order to customer', count(*), count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) FROM orders
 UNION ALL SELECT 'nation to region', count(*), count(*) FILTER (WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)) FROM nation
 UNION ALL SELECT 'text: damaged', count(*), count(*) FILTER (WHERE contains(text, chr(65533))) FROM conversations)
""")
def quality_report(t):
    return _int_passed(quality.suite(
        quality.check_unique(t.customer, "customer key", ["c_custkey"]),
        quality.check_rules(t.part, {"part price": F.col("p_retailprice") > 0}),
        quality.check_reference(t.orders, "order to customer", "o_custkey", t.customer, "c_custkey"),
        quality.check_reference(t.nation, "nation to region", "n_regionkey", t.region, "r_regionkey"),
        quality.scan_text(t.conversations, ["text"], {"damaged": quality.DAMAGED})))


REFRESH_RULES = {"priority": "regexp_matches(o_orderpriority, '^[1-5]-')", "price": "o_totalprice < 499000"}


@query("refresh_orders", """
SELECT check_name, n_checked, n_failed, (n_failed = 0)::INT AS passed FROM (
  SELECT 'rows' AS check_name, count(*) AS n_checked, 0 AS n_failed FROM orders UNION ALL
  SELECT 'unique o_orderkey', count(DISTINCT o_orderkey), 0 FROM orders UNION ALL """ + " UNION ALL ".join(
    f"SELECT '{n}', count(*), count(*) FILTER (WHERE NOT {c}) FROM orders" for n, c in REFRESH_RULES.items()) + """ UNION ALL
  SELECT 'change: added', count(*), 0 FROM orders WHERE o_orderstatus = 'P' UNION ALL
  SELECT 'change: changed', count(*), 0 FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 10 = 0)
""")
def refresh_orders(t):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    old = o.where("o_orderstatus <> 'P'").withColumn("o_totalprice", F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 10 == 0), -1.0).otherwise(F.col("o_totalprice")))
    done = quality.gated_refresh(o, f"{shared_folder(t.spark)}/refresh", ["o_orderkey"], {
        "priority": F.col("o_orderpriority").rlike("^[1-5]-"), "price": F.col("o_totalprice") < 499000}, current=old)
    changes = done.changes.groupBy("change").agg(F.count("*").alias("n_checked")).select(
        F.concat(F.lit("change: "), "change").alias("check_name"), "n_checked", F.lit(0).cast("long").alias("n_failed"), F.lit(True).alias("passed"))
    return _int_passed(done.results.unionByName(changes))


@query("decode_mixed_bytes", """
SELECT doc_id, md5(text) AS text_md5, length(text) AS n FROM documents
""")
def decode_mixed_bytes(t):
    """Every other line of a document was typed in windows-1252; a page of both is read back whole."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.when(i % 2 == 1, F.encode(x, "iso-8859-1")).otherwise(F.encode(x, "utf-8")))
    raw = F.aggregate(lines, F.lit(None).cast("binary"), lambda a, b: F.when(a.isNull(), b).otherwise(F.concat(a, F.encode(F.lit("\n"), "utf-8"), b)))
    s = t.documents.select("doc_id", pg.decode_mixed(raw).alias("x"))
    return s.select("doc_id", F.md5("x").alias("text_md5"), F.length("x").cast("long").alias("n"))


# --- streams -----------------------------------------------------------------

def _stream_folders(spark):
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    return f"{root}/ledger", f"{root}/progress"


@query("stream_dedup_events", """
WITH e AS (SELECT event_id, ts, sha256(event_type || '|' || props) AS digest FROM events)
SELECT digest, arg_min(event_id, struct_pack(a := ts, b := event_id)) AS event_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, count(*) AS n_captures
FROM e GROUP BY digest
""")
def stream_dedup_events(t):
    ledger, progress = _stream_folders(t.spark)
    s = (ingest.file_stream(t.spark, t.sf_dir, t.events.schema, "events.parquet")
         .withColumn("digest", F.sha2(F.concat_ws("|", "event_type", "props"), 256)))
    updates = state.first_updates(s, "digest", "event_id", "ts")
    state.keep_updates(updates, ledger, progress)
    out = state.answers(t.spark, ledger, ["digest"], updates.schema)
    return out.select("digest", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("first_seen"), "n_captures")


@query("stream_latest_wins", """
WITH e AS (SELECT user_id, event_type, ts, event_id, CAST(floor(value / 10) AS BIGINT) AS band FROM events)
SELECT user_id, event_type, arg_max(band, struct_pack(a := ts, b := event_id)) AS band, count(*) AS n_captures, count(DISTINCT band) AS n_variants,
  CASE WHEN count(DISTINCT band) > 1 THEN 'disputed' ELSE 'single-source' END AS confidence FROM e GROUP BY ALL
""")
def stream_latest_wins(t):
    ledger, progress = _stream_folders(t.spark)
    s = ingest.file_stream(t.spark, t.sf_dir, t.events.schema, "events.parquet").withColumn("band", F.floor(F.col("value") / 10))
    keys = ["user_id", "event_type"]
    updates = state.latest_updates(s, keys, ["band"], ["ts", "event_id"])
    state.keep_updates(updates, ledger, progress)
    out = state.answers(t.spark, ledger, keys, updates.schema)
    return out.select(*keys, "band", "n_captures", "n_variants", F.when(F.col("n_variants") > 1, "disputed").otherwise("single-source").alias("confidence"))
