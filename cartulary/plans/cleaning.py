"""Cleaning steps over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, numbers, text, urls
from .base import query

NAMES = """
SELECT 'customer' AS src, c_name AS raw FROM customer
UNION ALL SELECT 'supplier', s_name FROM supplier
UNION ALL SELECT 'part', p_name FROM part
"""


def _names(t):
    return (t.customer.select(F.lit("customer").alias("src"), F.col("c_name").alias("raw"))
            .unionAll(t.supplier.select(F.lit("supplier"), "s_name"))
            .unionAll(t.part.select(F.lit("part"), "p_name")))


@query("squish_documents", r"""
SELECT doc_id, length(s) AS n_clean, md5(s) AS clean_md5
FROM (SELECT doc_id, trim(regexp_replace(text, '[\s\v\x{1C}-\x{1F}\x{85}\p{Z}]+', ' ', 'g')) AS s FROM documents)
""")
def squish_documents(t):
    s = text.squish("text")
    return t.documents.select("doc_id", F.length(s).cast("long").alias("n_clean"), F.md5(s).alias("clean_md5"))


@query("fold_titles", r"""
SELECT page_id, strip_accents(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS folded_title FROM pages
""")
def fold_titles(t):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return t.pages.select("page_id", text.strip_accents(title).alias("folded_title"))


NORM_SQL = r"""trim(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents({c})),
  '[''`.‘’“”"]', '', 'g'), '[^a-z0-9 ,]', ' ', 'g'), '\s+', ' ', 'g'))"""


@query("normalize_names", f"""
SELECT src, {NORM_SQL.format(c='raw')} AS normalized, count(*) AS n FROM ({NAMES}) GROUP BY ALL
""")
def normalize_names(t):
    return (_names(t).groupBy("src", text.normalize_name("raw").alias("normalized"))
            .agg(F.count("*").alias("n")))


@query("token_key_parts", r"""
SELECT array_to_string(list_sort(string_split(lower(p_name), ' ')), ' ') AS token_key, count(*) AS n_parts
FROM part GROUP BY 1
""")
def token_key_parts(t):
    return t.part.groupBy(text.token_sort_key("p_name").alias("token_key")).agg(F.count("*").alias("n_parts"))


@query("fold_nation_names", r"""
SELECT n_nationkey, upper(replace(n_name || ' S.A.', '.', ' ')) AS place_raw_upper,
  trim(upper(regexp_replace(replace(n_name || ' S.A.', '.', ' '), '\s+', ' ', 'g'))) AS place_upper,
  lower(n_name || ' s.a.') AS place_lower
FROM nation
""")
def fold_nation_names(t):
    raw = F.concat("n_name", F.lit(" S.A."))
    return t.nation.select(
        "n_nationkey", F.upper(F.replace(raw, F.lit("."), F.lit(" "))).alias("place_raw_upper"),
        text.place_upper(raw).alias("place_upper"), text.place_lower(raw).alias("place_lower"))


@query("fold_search_text", r"""
SELECT doc_id, length(s) AS n_folded, md5(s) AS folded_md5 FROM (
  SELECT doc_id, trim(regexp_replace(strip_accents(lower(text)), '[«»"''.]', '', 'g')) AS s FROM documents)
""")
def fold_search_text(t):
    s = text.search_fold("text")
    return t.documents.select("doc_id", F.length(s).cast("long").alias("n_folded"), F.md5(s).alias("folded_md5"))


@query("slug_part_names", r"""
SELECT regexp_replace(lower(p_name || ' (' || p_brand || ')'), '[^a-z0-9]+', '-', 'g')
  .regexp_replace('^-+|-+$', '', 'g') AS slug, count(*) AS n_parts
FROM part GROUP BY 1
""")
def slug_part_names(t):
    raw = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))
    return t.part.groupBy(text.slugify(raw).alias("slug")).agg(F.count("*").alias("n_parts"))


@query("quoted_spans", r"""
SELECT conv_id, turn, trim(regexp_replace(regexp_extract(text, '[''‘’"]([^''‘’"]{2,})[''‘’"]?', 1), '\s+', ' ', 'g'))
  AS quoted FROM conversations
""")
def quoted_spans(t):
    return t.conversations.select("conv_id", "turn", text.extract_nickname("text").alias("quoted"))


@query("last_token", r"""
SELECT p_partkey, lower(p_type) AS city, lower(p_type) AS bare_city FROM part
""")
def last_token(t):
    named = F.concat("p_name", F.lit(", "), "p_type")
    return t.part.select("p_partkey", text.city_token(named).alias("city"),
                         text.city_token("p_type").alias("bare_city"))


@query("repair_documents", r"""
SELECT lang, count(*) AS n_docs,
  count(*) FILTER (WHERE regexp_matches(text, '[^\x00-\x7F]')) AS n_damaged,
  count(*) FILTER (WHERE NOT regexp_matches(text, '[^\x00-\x7F]') OR regexp_matches(text, '[\x{80}-\x{FF}]'))
    AS n_restored
FROM documents GROUP BY lang
""")
def repair_documents(t):
    damaged = F.decode(F.encode("text", "utf-8"), "iso-8859-1")
    return (t.documents.withColumn("damaged", damaged)
            .withColumn("repaired", text.repair_mojibake("damaged"))
            .groupBy("lang").agg(
                F.count("*").alias("n_docs"),
                F.count_if(F.col("damaged") != F.col("text")).alias("n_damaged"),
                F.count_if(F.col("repaired") == F.col("text")).alias("n_restored")))


@query("safe_ints", r"""
SELECT event_id,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE k END AS loose_int,
  CASE WHEN event_id % 5 IN (0, 1) THEN NULL ELSE k END AS strict_int
FROM (SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events)
""")
def safe_ints(t):
    k = F.get_json_object("props", "$.k")
    raw = (F.when(F.col("event_id") % 5 == 0, F.element_at(F.array(*map(F.lit, ("-", "nan", "None", "x1", ""))),
                                                          (F.floor(F.col("event_id") / 5) % 5 + 1).cast("int")))
           .when(F.col("event_id") % 5 == 1, F.concat(k, F.lit(".0"))).otherwise(k))
    return t.events.select("event_id", numbers.to_int(raw).alias("loose_int"),
                           numbers.to_int_strict(raw).alias("strict_int"))


@query("safe_floats", r"""
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE round_even(value, 1) END AS value_1 FROM events
""")
def safe_floats(t):
    raw = F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", numbers.to_float_rounded(raw, 1).alias("value_1"))


@query("duration_minutes", r"""
SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN NULL ELSE minute(ts) END AS INT) AS minutes FROM events
""")
def duration_minutes(t):
    raw = (F.when(F.col("event_id") % 3 == 0, "-")
           .when(F.col("event_id") % 3 == 1, F.date_format("ts", "m:ss"))
           .otherwise(F.date_format("ts", "m")))
    return t.events.select("event_id", numbers.to_minutes(raw).alias("minutes"))


@query("parse_order_dates", r"""
SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 2 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso_date
FROM orders
""")
def parse_order_dates(t):
    raw = (F.when(F.col("o_orderkey") % 10 == 0, "1/1/1900")
           .when(F.col("o_orderkey") % 10 == 1, "2/30/1999")
           .otherwise(F.date_format("o_orderdate", "M/d/yyyy")))
    return t.orders.select("o_orderkey", dates.to_date_mdy(raw).cast("string").alias("iso_date"))


@query("event_capture_key", r"""
SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS capture_key, strftime(ts, '%Y-%m-%d') AS capture_date,
  strftime(ts, '%Y%m%d%H%M%S') AS key_in_url FROM events
""")
def event_capture_key(t):
    key = dates.capture_key("ts")
    url = F.concat(F.lit("https://archive.example/web/"), key, F.lit("/page?id="), "event_id")
    return t.events.select("event_id", key.alias("capture_key"),
                           dates.capture_date(key).cast("string").alias("capture_date"),
                           dates.capture_key_in_url(url).alias("key_in_url"))


@query("page_url_parts", r"""
SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) AS host,
  regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) AS path,
  regexp_extract(url, '\?([^#]*)', 1) AS query_text,
  nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page_param,
  CAST(position('?' IN url) > 0 AS INT) AS has_query
FROM pages
""")
def page_url_parts(t):
    return t.pages.select("page_id", urls.host("url").alias("host"), urls.path("url").alias("path"),
                          urls.query_string("url").alias("query_text"),
                          urls.parameter("url", "page").alias("page_param"),
                          urls.is_parametrised("url").cast("int").alias("has_query"))


@query("clear_sentinels", r"""
SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 OR p_type = 'PROMO' THEN '' ELSE p_type END AS part_type FROM part
""")
def clear_sentinels(t):
    k = F.col("p_partkey") % 4
    raw = (F.when(k == 0, "  No se sabe ").when(k == 1, F.concat("p_type", F.lit(" Error 404 Not Found")))
           .otherwise(F.col("p_type")))
    return t.part.select("p_partkey", text.clear_sentinels(raw, text.FIELD_SENTINELS + ("promo",)).alias("part_type"))


@query("season_from_key", r"""
SELECT o_orderkey, year(o_orderdate) AS season,
  year(o_orderdate) || '-' || (year(o_orderdate) + 1) AS split_key, year(o_orderdate) AS split_start FROM orders
""")
def season_from_key(t):
    y = F.year("o_orderdate")
    gid = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("BS"), y, F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
                 ).otherwise(F.concat(F.lit("bs"), F.lpad((y - 1980).cast("string"), 2, "0"), F.lit("001")))
    split = dates.season_key(F.concat(F.lit(" "), y, F.lit(" - "), y + 1, F.lit(" final")))
    return t.orders.select("o_orderkey", dates.season_from_game_id(gid).alias("season"),
                           split.alias("split_key"), dates.season_start(split).alias("split_start"))


@query("split_pairs", r"""
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS qty, CAST(round(l_tax * 100) AS INT) AS tax_pct, count(*) AS n
FROM lineitem GROUP BY ALL
""")
def split_pairs(t):
    raw = F.concat(F.lit(" "), F.col("l_quantity").cast("int"), F.lit(" - "), F.round(F.col("l_tax") * 100).cast("int"))
    p = numbers.split_pair(raw, "-", ("qty", "tax_pct"))
    return (t.lineitem.select("l_orderkey", "l_linenumber", p.alias("p"))
            .groupBy("l_orderkey", "l_linenumber", "p.qty", "p.tax_pct").agg(F.count("*").alias("n")))


@query("split_part_type", r"""
SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN p_type ELSE 'CUP - ' || p_type END AS city,
  CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'CUP' ELSE '' END AS annotation,
  p_name AS head, p_brand AS tail
FROM part
""")
def split_part_type(t):
    raw = F.concat(F.lit("CUP - "), "p_type")
    part = text.split_tail(raw, 1)
    known = t.values("('SMALL'), ('LARGE')", "known")
    cell = text.split_parenthesised(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")))
    return (t.part.select("p_partkey", raw.alias("raw"), part.alias("s"), cell.alias("cell"))
            .join(F.broadcast(known), F.col("s.tail") == F.col("known"), "left")
            .select("p_partkey",
                    F.when(F.col("known").isNotNull(), F.col("s.tail")).otherwise(F.col("raw")).alias("city"),
                    F.when(F.col("known").isNotNull(), F.col("s.head")).otherwise("").alias("annotation"),
                    F.col("cell.head").alias("head"), F.col("cell.tail").alias("tail")))


@query("proper_case_segments", r"""
SELECT src, label, count(*) AS n FROM (
  SELECT 'segment' AS src, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' de ' || upper(c_mktsegment[1])
    || lower(c_mktsegment[2:]) || ' III' AS label FROM customer
  UNION ALL SELECT 'type', 'Mc' || upper(p_type[1]) || lower(p_type[2:]) || ', O''' || upper(p_type[1]) || lower(p_type[2:])
    || '-' || upper(p_type[1]) || lower(p_type[2:]) || ' Jr.' FROM part)
GROUP BY ALL
""")
def proper_case_segments(t):
    seg = F.concat("c_mktsegment", F.lit(" DE "), "c_mktsegment", F.lit(" III"))
    typ = F.concat(F.lit("MC"), "p_type", F.lit(", O'"), "p_type", F.lit("-"), "p_type", F.lit(" JR."))
    both = (t.customer.select(F.lit("segment").alias("src"), text.proper_case(seg).alias("label"))
            .unionAll(t.part.select(F.lit("type"), text.proper_case(typ))))
    return both.groupBy("src", "label").agg(F.count("*").alias("n"))


@query("display_names", r"""
SELECT p_partkey, CASE
  WHEN p_partkey % 5 = 0 THEN 'Not selected'
  WHEN p_partkey % 5 = 1 AND p_name = 'red ring' THEN 'Red Ring (override)'
  WHEN p_partkey % 5 = 1 THEN upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' '
    || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:]
  WHEN p_partkey % 5 = 2 THEN split_part(p_name, ' ', 1) || ', ' || split_part(p_name, ' ', 2) || ' ' || p_brand
  WHEN p_partkey % 5 = 3 THEN split_part(p_name, ' ', 1) || ', ' || split_part(p_name, ' ', 2) || ' ' || p_brand
  ELSE p_name END AS shown
FROM part
""")
def display_names(t):
    k = F.col("p_partkey") % 5
    first, second = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    raw = (F.when(k == 0, "NOBODY WAS CHOSEN").when(k == 1, F.upper("p_name"))
           .when(k == 2, F.concat(first, F.lit(", "), second, F.lit(" 'Qu")))
           .when(k == 3, first).otherwise(F.col("p_name")))
    overrides = t.values("('RED RING', 'Red Ring (override)')", "o_raw, o_shown")
    non_names = t.values("('NOBODY WAS CHOSEN', 'Not selected')", "x_raw, x_shown")
    canonical = F.concat(first, F.lit(", "), second, F.lit(" "), "p_brand")
    return (t.part.select("p_partkey", raw.alias("raw"), canonical.alias("canonical"))
            .join(F.broadcast(overrides), F.col("raw") == F.col("o_raw"), "left")
            .join(F.broadcast(non_names), F.col("raw") == F.col("x_raw"), "left")
            .select("p_partkey", text.display_name("raw", "canonical", "o_shown", "x_shown").alias("shown")))


@query("fuzzy_parts", r"""
SELECT damage, count(*) AS n_pairs, count(*) FILTER (WHERE
   levenshtein(split_part(a, ' ', 1), split_part(b, ' ', 1)) <= 2
     AND levenshtein(split_part(a, ' ', 2), split_part(b, ' ', 2)) <= 1) AS n_match
FROM (SELECT p_partkey % 4 AS damage, lower(p_name) AS a, CASE p_partkey % 4
   WHEN 0 THEN p_name WHEN 1 THEN p_name[1:length(p_name) - 1] WHEN 2 THEN 'xx' || p_name ELSE 'yyy' || p_name || 'z' END AS b
  FROM part) GROUP BY damage
""")
def fuzzy_parts(t):
    k = F.col("p_partkey") % 4
    b = (F.when(k == 0, F.col("p_name")).when(k == 1, F.expr("left(p_name, length(p_name) - 1)"))
         .when(k == 2, F.concat(F.lit("xx"), "p_name")).otherwise(F.concat(F.lit("yyy"), "p_name", F.lit("z"))))
    second = t.part.select(F.col("p_partkey").alias("k2"), b.alias("b"))
    return (t.part.join(second, F.col("p_partkey") == F.col("k2"))
            .groupBy(k.alias("damage"))
            .agg(F.count("*").alias("n_pairs"), F.count_if(text.fuzzy_name_match("p_name", "b")).alias("n_match")))


@query("age_at_order", r"""
SELECT o_orderkey, CAST(date_sub('year', DATE '1970-06-15', CAST(o_orderdate AS DATE)) AS INT) AS age,
  CAST(CASE WHEN year(o_orderdate) - (1900 + o_orderkey % 100) BETWEEN 14 AND 55 THEN 1900 + o_orderkey % 100
       ELSE NULL END AS INT) AS birth_year
FROM orders
""")
def age_at_order(t):
    code = (F.col("o_orderkey") % 100).cast("int")
    return t.orders.select(
        "o_orderkey", dates.whole_years(F.lit("1970-06-15"), "o_orderdate").alias("age"),
        numbers.full_birth_year(code, F.year("o_orderdate")).alias("birth_year"))


@query("orders_by_period", r"""
SELECT CAST(floor(year(o_orderdate) / 10) * 10 AS INT) AS decade, year(o_orderdate) AS season, count(*) AS n_orders
FROM orders GROUP BY ALL
""")
def orders_by_period(t):
    y = F.year("o_orderdate")
    return (t.orders.groupBy(numbers.decade(y).alias("decade"), y.alias("season"))
            .agg(F.count("*").alias("n_orders")))


TURN_PATTERNS = ((r" nicht ", "german"), (r" the ", "english"), (r" que .* la ", "romance"),
                 (r"[0-9]", "digits"), (r"\?", "question"))


@query("classify_turns", r"""
WITH c AS (SELECT role, CASE
  WHEN regexp_matches(s, '(?i) nicht ') THEN 'german' WHEN regexp_matches(s, '(?i) the ') THEN 'english'
  WHEN regexp_matches(s, '(?i) que .* la ') THEN 'romance' WHEN regexp_matches(s, '[0-9]') THEN 'digits'
  WHEN regexp_matches(s, '\?') THEN 'question' ELSE '' END AS kind
  FROM (SELECT role, regexp_replace(text, '\s+', ' ', 'g') AS s FROM conversations))
SELECT role, kind, count(*) AS n FROM c GROUP BY ALL
""")
def classify_turns(t):
    return (t.conversations.groupBy("role", text.classify("text", TURN_PATTERNS).alias("kind"))
            .agg(F.count("*").alias("n")))


@query("lineitem_check", r"""
SELECT l_returnflag, CASE WHEN l_linenumber = 7 THEN ''
   WHEN CAST(l_quantity AS INT) % 2 = 0 THEN 'ok' ELSE 'pts_mismatch' END AS box_check, count(*) AS n
FROM lineitem GROUP BY ALL
""")
def lineitem_check(t):
    q = F.col("l_quantity").cast("int")
    half = F.when(F.col("l_linenumber") != 7, F.floor(q / 2))
    check = numbers.points_check(half, F.lit(0), F.lit(0), q)
    return t.lineitem.groupBy("l_returnflag", check.alias("box_check")).agg(F.count("*").alias("n"))


@query("type_tokens", r"""
SELECT p_partkey, p_type AS first_token, CAST(p_type IN ('SMALL', 'PROMO') OR p_brand = 'Brand#1' AS INT) AS fits
FROM part
""")
def type_tokens(t):
    slots = F.concat("p_type", F.lit("/ "), "p_brand")
    return t.part.select("p_partkey", text.primary_position(slots).alias("first_token"),
                         text.fits_slot(slots, ("SMALL", "PROMO", "Brand#1")).cast("int").alias("fits"))


@query("rate_and_delta", r"""
WITH m AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_orders,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue FROM orders GROUP BY ALL),
 r AS (SELECT *, CAST(round(revenue / n_orders, 1) AS DOUBLE) AS per_order FROM m)
SELECT o_custkey, month, n_orders, per_order,
  CAST(round(per_order - lag(per_order) OVER (PARTITION BY o_custkey ORDER BY month), 1) AS DOUBLE) AS change
FROM r
""")
def rate_and_delta(t):
    from ..operators.windows import change_from_previous

    monthly = (t.orders.groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
               .agg(F.count("*").alias("n_orders"),
                    F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"))
               .withColumn("per_order", numbers.per_game(F.col("revenue").cast("double"), "n_orders")))
    return (change_from_previous(monthly, ["o_custkey"], ["month"], {"change": "per_order"})
            .withColumn("change", F.round("change", 1)).drop("revenue"))
