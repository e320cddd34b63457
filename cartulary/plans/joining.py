"""Join operators over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import joins
from .base import query


@query("nation_crosswalk", """
SELECT r_name, n_name, count(c_custkey) AS n_customers, 0 AS n_unmapped,
  (SELECT count(*) FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)) AS n_unused
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
""")
def nation_crosswalk(t):
    mapping = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
               .select(F.col("n_nationkey").alias("nation"), "n_name", "r_name"))
    x = joins.crosswalk(t.customer.withColumnRenamed("c_nationkey", "nation"), mapping, "nation")
    n_unmapped = x.unmapped.agg(F.count("*").cast("int").alias("n")).scalar()
    n_unused = x.unused.agg(F.count("*").alias("n")).scalar()
    return (x.joined.groupBy("r_name", "n_name").agg(F.count("c_custkey").alias("n_customers"))
            .withColumn("n_unmapped", n_unmapped).withColumn("n_unused", n_unused))


RATES = """('1-URGENT', 1995, 1996, 110), ('1-URGENT', 1997, NULL, 120), ('2-HIGH', 1996, 1998, 105),
 ('5-LOW', 1990, 1995, 90), ('5-LOW', 1999, 1999, 95)"""


@query("interval_rates", f"""
SELECT o_orderkey, year(o_orderdate) AS season, rate FROM orders
LEFT JOIN (VALUES {RATES}) r(pri, s, e, rate) ON o_orderpriority = pri AND year(o_orderdate) BETWEEN s AND coalesce(e, 9999)
""")
def interval_rates(t):
    ranges = t.values(RATES, "o_orderpriority, s, e, factor")
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("season"))
    return (joins.dated_override(rows, ranges, "o_orderpriority", "season", "s", "e", "factor", "rate")
            .select("o_orderkey", "season", "rate"))


@query("resolve_nation", """
WITH q AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN CAST(c_nationkey AS VARCHAR) WHEN 1 THEN 'NATION_' || c_nationkey
   WHEN 2 THEN 'Nátion_' || c_nationkey ELSE 'region ' || c_nationkey % 5 END AS raw FROM customer)
SELECT c_custkey, raw, n_nationkey AS resolved_id, CASE WHEN n_nationkey IS NULL THEN 'unresolved'
   WHEN c_custkey % 4 = 0 THEN 'code' WHEN c_custkey % 4 = 1 THEN 'name' ELSE 'folded' END AS method
FROM q LEFT JOIN nation ON raw = CAST(n_nationkey AS VARCHAR) OR strip_accents(upper(raw)) = n_name
""")
def resolve_nation(t):
    k = F.col("c_custkey") % 4
    raw = (F.when(k == 0, F.col("c_nationkey").cast("string")).when(k == 1, F.concat(F.lit("NATION_"), "c_nationkey"))
           .when(k == 2, F.concat(F.lit("Nátion_"), "c_nationkey"))
           .otherwise(F.concat(F.lit("region "), F.col("c_nationkey") % 5)))
    n = t.nation.select("n_nationkey", "n_name", F.col("n_nationkey").cast("string").alias("code"),
                        text.place_lower("n_name").alias("folded"),
                        F.concat(F.lit("region "), F.col("n_regionkey")).alias("region_name"))
    return joins.resolver_chain(t.customer.select("c_custkey", raw.alias("raw")), [
        ("code", F.col("raw"), n, "code", "n_nationkey"), ("name", F.col("raw"), n, "n_name", "n_nationkey"),
        ("folded", text.place_lower("raw"), n, "folded", "n_nationkey"),
        ("region", F.col("raw"), n, "region_name", "n_nationkey")])


@query("unique_names", """
SELECT p_name || ' ' || p_brand AS name, min(p_partkey) AS p_partkey FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) = 1
""")
def unique_names(t):
    named = t.part.select(F.concat_ws(" ", "p_name", "p_brand").alias("name"), "p_partkey")
    return joins.unique_keys(named, "name", "p_partkey")


@query("candidate_parts", """
WITH canon AS (SELECT p_partkey AS id, p_brand AS given,
   CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE p_name || ' ' || lower(p_type) END AS fam FROM part),
 obs AS (SELECT p_partkey AS obs_id, p_brand AS given,
   CASE WHEN p_partkey % 4 = 1 THEN p_name ELSE p_name || ' ' || lower(p_type) || ' jr' END AS fam FROM part)
SELECT obs_id, count(id) AS n_candidates, CASE WHEN count(id) = 1 THEN min(id) END AS candidate_id
FROM obs LEFT JOIN canon ON obs.given = canon.given AND (starts_with(obs.fam || ' ', canon.fam || ' ')
  OR starts_with(canon.fam || ' ', obs.fam || ' ')) GROUP BY obs_id
""")
def candidate_parts(t):
    words = text.name_tokens(F.col("fam"))
    long_name = F.concat_ws(" ", "p_name", F.lower("p_type"))
    k = F.col("p_partkey") % 4
    canon = (t.part
             .select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("given"),
                     F.when(k == 0, F.col("p_name")).otherwise(long_name).alias("fam"))
             .withColumn("family", words))
    obs = (t.part
           .select(F.col("p_partkey").alias("obs_id"), F.col("p_brand").alias("given"),
                   F.when(k == 1, F.col("p_name")).otherwise(F.concat(long_name, F.lit(" jr"))).alias("fam"))
           .withColumn("family", words))
    return joins.family_shape_candidates(obs, canon, "obs_id", "id").select("obs_id", "n_candidates", "candidate_id")


@query("corroborated_orders", """
WITH c AS (SELECT user_id, user_id % 40 AS k, min(ts::DATE) - 1 AS lo, max(ts::DATE) + 1 AS hi FROM events
   WHERE event_type IN ('signup', 'purchase') GROUP BY ALL)
SELECT event_id, count(c.user_id) AS n_in_span, CASE WHEN count(c.user_id) = 1 THEN min(c.user_id) END AS survivor_id
FROM events e LEFT JOIN c ON e.user_id % 40 = c.k AND e.ts::DATE BETWEEN lo AND hi WHERE event_type NOT IN ('signup', 'purchase') GROUP BY event_id
""")
def corroborated_orders(t):
    day = F.unix_date(F.col("ts").cast("date")).alias("day")
    rows = t.events.select("event_id", "user_id", "event_type", (F.col("user_id") % 40).alias("name_key"), day)
    career = F.col("event_type").isin("signup", "purchase")
    spans = (rows.where(career).groupBy("name_key", "user_id")
             .agg(F.min("day").alias("lo"), F.max("day").alias("hi")))
    obs = rows.where(~career).select("event_id", "name_key", "day")
    return (joins.span_corroboration(obs, spans, "name_key", "day", "user_id", "lo", "hi")
            .select("event_id", "n_in_span", "survivor_id"))


@query("near_month_check", """
WITH o AS (SELECT o_orderkey, o_orderstatus = 'F' AS done, o_custkey AS id, year(o_orderdate) * 12 + month(o_orderdate) AS m,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS club FROM orders),
 b AS (SELECT * FROM o WHERE done AND club IS NOT NULL)
SELECT o_orderkey, CASE WHEN club IS NULL THEN 'no_obs_club'
  WHEN EXISTS (FROM b WHERE b.id = o.id AND abs(b.m - o.m) <= 1 AND b.club = o.club) THEN 'confirms'
  WHEN EXISTS (FROM b WHERE b.id = o.id AND abs(b.m - o.m) <= 1) THEN 'contradicts' ELSE 'no_career_club' END AS club_check
FROM o WHERE NOT done
""")
def near_month_check(t):
    m = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("m")
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("id"), m,
                           F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("club"))
    return (joins.near_club_check(rows.where("o_orderstatus <> 'F'"), rows.where("o_orderstatus = 'F'"), "id", "m", "club")
            .select("o_orderkey", "club_check"))


@query("orders_within_7_days", """
SELECT a.o_orderkey, count(b.o_orderkey) - 1 AS n_others,
  CASE WHEN count(b.o_orderkey) = 2 THEN sum(b.o_orderkey)::BIGINT - a.o_orderkey END AS only_other
FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND abs(date_diff('day', a.o_orderdate, b.o_orderdate)) <= 7
GROUP BY a.o_orderkey
""")
def orders_within_7_days(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return (joins.date_tolerance(o, o, ["o_custkey"], "o_orderdate", "o_orderkey", 7)
            .select("o_orderkey", (F.col("n_near") - 1).alias("n_others"),
                    F.when(F.col("n_near") == 2, F.col("near_min") + F.col("near_max") - F.col("o_orderkey"))
                    .alias("only_other")))


@query("attach_labels", """
WITH d AS (SELECT doc_id, CASE lang WHEN 'de' THEN 'deu' ELSE lang END AS lang, source, n_chars FROM documents),
 f AS (SELECT lang, source, max(n_chars) AS longest, count(quality) AS n_labelled
   FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL),
 b AS (SELECT doc_id, f.longest, f.n_labelled FROM d JOIN f USING (lang, source)
   QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY n_chars = f.longest DESC, doc_id) = 1)
SELECT doc_id, lang, source, longest, n_labelled, 'row' AS origin FROM d LEFT JOIN b USING (doc_id)
UNION ALL SELECT NULL, lang, source, longest, n_labelled, 'fact_only' FROM f WHERE (lang, source) NOT IN (SELECT (lang, source) FROM d)
""")
def attach_labels(t):
    docs = t.documents.select("doc_id", "lang", "source", "n_chars")
    facts = (docs.join(t.labels.select("doc_id", "quality"), "doc_id", "left").groupBy("lang", "source")
             .agg(F.max("n_chars").alias("longest"), F.count("quality").alias("n_labelled")))
    listed = docs.withColumn("lang", F.when(F.col("lang") == "de", "deu").otherwise(F.col("lang")))
    return joins.attach_or_synthesise(listed, facts, ["lang", "source"], "doc_id",
                                      [F.col("n_chars") == F.col("longest")], ["longest", "n_labelled"]).drop("n_chars")


@query("unique_slugs", """
WITH p AS (SELECT p_partkey, replace(p_name, ' ', '-') AS slug, p_retailprice FROM part)
SELECT p_partkey, slug, CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY p_retailprice DESC, p_partkey) = 1 THEN slug
  ELSE slug || '-' || p_partkey END AS unique_slug, count(*) OVER (PARTITION BY slug) - 1 AS n_twins FROM p
""")
def unique_slugs(t):
    p = t.part.select("p_partkey", text.slugify("p_name").alias("slug"), "p_retailprice")
    return joins.unique_slugs(p, "slug", "p_partkey", F.col("p_retailprice")).drop("p_retailprice")


@query("redirect_ids", """
WITH s AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'shared-' || c_custkey % 200 ELSE 'c-' || c_custkey END AS slug
   FROM customer),
 x AS (SELECT c_custkey AS retired_id, c_custkey + 1 AS survivor_id FROM customer WHERE c_custkey % 7 = 0),
 r AS (SELECT retired_id, survivor_id, o.slug AS old_slug, n.slug AS new_slug FROM x JOIN s o ON o.id = retired_id
   JOIN s n ON n.id = survivor_id WHERE o.slug <> n.slug),
 live AS (SELECT DISTINCT slug FROM s WHERE id NOT IN (SELECT retired_id FROM x))
SELECT *, CAST(old_slug IN (FROM live) AS INT) AS clash FROM r
""")
def redirect_ids(t):
    k = F.col("c_custkey")
    slugs = t.customer.select(k.alias("id"), F.when(k % 3 == 0, F.concat(F.lit("shared-"), k % 200))
                              .otherwise(F.concat(F.lit("c-"), k)).alias("slug"))
    dead = t.customer.where(k % 7 == 0).select(k.alias("retired_id"), (k + 1).alias("survivor_id"))
    r = joins.redirects(dead, slugs, "retired_id", "survivor_id", "id", "slug")
    return r.redirects.withColumn("clash", F.lit(0)).unionByName(r.clashes.withColumn("clash", F.lit(1)))


@query("conflict_rows", """
WITH p AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 5 THEN NULL ELSE l_quantity END AS q FROM lineitem),
 n AS (SELECT l_orderkey, l_linenumber, q, count(*) AS n_matches FROM p GROUP BY ALL)
SELECT o_orderkey, coalesce(n_matches, 0) AS n_matches, CAST(coalesce(n_matches, 0) = 1 AS INT) AS ok
FROM orders LEFT JOIN n ON l_orderkey = o_orderkey AND l_linenumber = 6 AND q IS NULL
""")
def conflict_rows(t):
    published = t.lineitem.select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line"),
                                  F.when(F.col("l_linenumber") <= 5, F.col("l_quantity")).alias("q"))
    sides = t.orders.select(F.col("o_orderkey").alias("key"), F.lit(6).alias("line"), F.lit(None).cast("double").alias("q"))
    return (joins.match_counts(sides, published, ["key", "line", "q"])
            .select(F.col("key").alias("o_orderkey"), "n_matches", F.col("ok").cast("int").alias("ok")))


@query("criteria_grid", """
WITH e AS (SELECT c_custkey, any_value(c_mktsegment) AS seg, any_value(c_acctbal) AS bal, bool_or(o_orderstatus = 'F') AS f,
  bool_or(o_orderpriority = '1-URGENT') AS u, max(o_totalprice) > 400000 AS big
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey),
 r AS (SELECT c_custkey, seg AS row_criterion FROM e WHERE seg IN ('MACHINERY', 'BUILDING') UNION ALL
   SELECT c_custkey, 'in_debt' FROM e WHERE bal < 0),
 c AS (SELECT c_custkey, 'finished' AS col_criterion FROM e WHERE f UNION ALL SELECT c_custkey, 'urgent' FROM e WHERE u
   UNION ALL SELECT c_custkey, 'big_order' FROM e WHERE big)
SELECT row_criterion, col_criterion, count(*) AS n_entities FROM r JOIN c USING (c_custkey) GROUP BY ALL
""")
def criteria_grid(t):
    facts = t.orders.groupBy("o_custkey").agg(
        F.bool_or(F.col("o_orderstatus") == "F").alias("f"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("u"),
        (F.max("o_totalprice") > 400000).alias("big"))
    e = t.customer.join(facts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joins.criteria_grid(
        e, {"MACHINERY": F.col("c_mktsegment") == "MACHINERY", "BUILDING": F.col("c_mktsegment") == "BUILDING",
            "in_debt": F.col("c_acctbal") < 0},
        {"finished": F.col("f"), "urgent": F.col("u"), "big_order": F.col("big")}, "c_custkey")


COMPARABLE = """
WITH c AS (SELECT {k}, {n} AS nation, CAST(round({v} * 100) AS BIGINT) AS cents FROM {t})
SELECT a.{k}, a.nation, a.cents,
  count(b.cents) FILTER (WHERE a.cents > b.cents AND a.cents - b.cents >= 100 AND (a.cents - b.cents) * 50 >= a.cents) AS n_below,
  count(b.cents) FILTER (WHERE b.cents > a.cents AND b.cents - a.cents >= 100 AND (b.cents - a.cents) * 50 >= b.cents) AS n_above
FROM c a JOIN c b USING (nation) GROUP BY ALL
"""


def _comparable(df, ident, nation, balance):
    c = df.select(ident, F.col(nation).alias("nation"), F.round(F.col(balance) * 100).cast("long").alias("cents"))
    return joins.comparable_counts(c, "nation", "cents", ident)


@query("comparable_suppliers", COMPARABLE.format(k="s_suppkey", n="s_nationkey", v="s_acctbal", t="supplier"))
def comparable_suppliers(t):
    return _comparable(t.supplier, "s_suppkey", "s_nationkey", "s_acctbal")


@query("comparable_customers", COMPARABLE.format(k="c_custkey", n="c_nationkey", v="c_acctbal", t="customer"))
def comparable_customers(t):
    return _comparable(t.customer, "c_custkey", "c_nationkey", "c_acctbal")


LISTED = """o AS (SELECT o_custkey, count(*) AS games, sum(CAST(o_totalprice * 100 AS BIGINT))::BIGINT AS cents FROM orders GROUP BY 1),
 a AS (SELECT c_custkey, c_nationkey, cents, games, round(cents / games, 1) + CASE WHEN c_custkey % 13 = 0 THEN 0.3 ELSE 0 END AS rate FROM customer JOIN o ON o_custkey = c_custkey),
 x AS (SELECT c_custkey, c_nationkey AS nation, CASE WHEN abs(cents / games - rate) <= 0.15 THEN cents END AS v FROM a)"""


@query("comparable_totals", f"""
WITH {LISTED}, d AS (SELECT *, v - greatest(100, ceil(v * 2 / 100))::BIGINT AS lo, greatest(v + 100, CASE WHEN v > 0 THEN ceil(v * 50 / 49)::BIGINT ELSE v + 100 END) AS hi FROM x)
SELECT c_custkey, nation, CASE WHEN v IS NOT NULL THEN (SELECT count(*) FROM x b WHERE b.nation = d.nation AND b.v <= d.lo) END AS n_below,
  CASE WHEN v IS NOT NULL THEN (SELECT count(*) FROM x b WHERE b.nation = d.nation AND b.v >= d.hi) END AS n_above FROM d
""")
def comparable_totals(t):
    per = t.orders.groupBy("o_custkey").agg(F.count("*").alias("games"), F.sum((F.col("o_totalprice") * 100).cast("decimal(18,0)")).cast("long").alias("cents"))
    off = F.when(F.col("c_custkey") % 13 == 0, 0.3).otherwise(0.0)
    rows = (t.customer.join(per, F.col("o_custkey") == F.col("c_custkey"))
            .select("c_custkey", F.col("c_nationkey").alias("nation"), "cents", "games", (F.round(F.col("cents") / F.col("games"), 1) + off).alias("rate")))
    return joins.comparable_counts(rows, "nation", "cents", "c_custkey", agrees=joins.rate_agrees("cents", "games", "rate")).select("c_custkey", "nation", "n_below", "n_above")


@query("customers_with_urgent", """
SELECT c_custkey, CAST(EXISTS (FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS INT) AS has_urgent FROM customer
""")
def customers_with_urgent(t):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return (joins.flag_semi(t.customer.select("c_custkey"), urgent, "c_custkey", "has_urgent")
            .withColumn("has_urgent", F.col("has_urgent").cast("int")))


@query("missing_days", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT strftime(day, '%Y-%m-%d') AS day FROM (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM d)
WHERE day NOT IN (FROM d)
""")
def missing_days(t):
    return joins.missing_periods(t.orders, "o_orderdate").select(F.date_format("day", "yyyy-MM-dd").alias("day"))
