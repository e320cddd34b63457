"""The corpus operators over their whole tables, with production parameters, in the columns of their contracts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, dac, iblt, langid, mixing, neardup, packing, phrases, quality, sharding, toxicity, warc, whitening
from .common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return (packed.rows("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64("text").alias("__tie"))
    return sharding.shard(rows, 40, ["doc_id", "__tie"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = dac.round_trip(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return read.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(langid.fold() % 5 == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(spark, table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
     r AS (SELECT d, max(page_id) AS newest FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < newest THEN newest END AS refers_to
FROM p LEFT JOIN r ON p.d = r.d AND p.n >= 1000
"""


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(langid.fold() % 4 == 2, F.lit(False))
    content = langid.dictionaries(docs.where(~held_out).select("doc_id", "text", "lang"))
    return langid.predict(docs.select("doc_id", "text"), content).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op8_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    parts = iblt.parts_of(docs)
    rows = iblt.with_next(docs, parts=parts).withColumn("edited", iblt.edited(F.col("text"), F.col("next_text")))
    keys = rows.select("bucket", "row", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       "own", iblt.digests(F.col("edited")).alias("other"), "next", F.size("next").alias("n_next"))
    compared = iblt.with_differences(keys, {"changed": ("own", "other"), "apart": ("own", "next")}, parts, whole=False)
    return compared.select(
        "doc_id", "n_chars", "edited_sha256", iblt.fingerprint("own").alias("fingerprint"),
        iblt.fingerprint("other").alias("edited_fingerprint"),
        iblt.likeness("own", "other", F.col("changed")).alias("near_edited"), iblt.likeness(F.size("own"), F.col("n_next"), F.col("apart")).alias("near_next"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


OP9_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 4 THEN [array_to_string(t, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(t) - 3), lambda i: array_to_string(t[i:i + 3], ' '))) END AS g
  FROM w),
k AS (SELECT min(doc_id) AS doc_id, g FROM (SELECT doc_id, list_sort(g) AS g FROM s) GROUP BY g),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM k),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS node, doc_id AS label FROM k UNION SELECT l.b, r.label FROM r JOIN l ON l.a = r.node AND l.b > r.label),
c AS (SELECT node, min(label) AS label FROM r GROUP BY node)
SELECT s.doc_id, len(s.g) AS n_shingles, CASE WHEN len(s.g) = 0 THEN s.doc_id ELSE c.label END AS component_id,
       len(s.g) = 0 OR c.label = s.doc_id AS kept
FROM s JOIN k ON list_sort(s.g) = k.g JOIN c ON c.node = k.doc_id
"""


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = mixed.taken.groupBy("row").agg(F.sum("words").alias("taken"))
    return (mixed.documents.join(taken, "row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, error, _ = whitening.whiten(table(spark, sf_dir, "embeddings"), wanted=8)
    return rows.select(F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation AS long)").alias("deviation"), "whitened", "explained",
                       F.lit(error).alias("identity_error"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, covered_percent=50)
    return phrases.top(found, 2000).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP13_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS t FROM p),
o AS (SELECT lang, t, k, unnest(generate_series(1, len(t) - k + 1)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k)),
f AS (SELECT lang, t[i:i + k - 1] AS g, k, count(*)::HUGEINT AS n FROM o GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
halves AS (
  SELECT lang, g, n AS a, k1, g[1:k1] AS gl, g[k1 + 1:] AS gr FROM (SELECT lang, g, n, unnest(generate_series(1, k - 1)) AS k1 FROM f WHERE k > 1 AND n >= 10)),
cut AS (
  SELECT h.lang, h.g, h.a, h.k1, x.n AS l, y.n AS r, (1000000 * h.a * h.a) // (x.n * y.n) AS score
  FROM halves h JOIN f x ON x.lang = h.lang AND x.g = h.gl JOIN f y ON y.lang = h.lang AND y.g = h.gr),
weakest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k1) = 1),
longer AS (
  SELECT lang, s AS g, max(n) AS n FROM (SELECT lang, unnest([g[1:2], g[2:3]]) AS s, n FROM f WHERE k = 3 AND n >= 10) GROUP BY lang, s),
ranked AS (
  SELECT c.lang, array_to_string(c.g, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, array_to_string(c.g, ' ')) AS rank
  FROM weakest c LEFT JOIN longer b ON b.lang = c.lang AND b.g = c.g
  WHERE b.n IS NULL OR 100 * b.n < 50 * a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, total.n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing, "op2_sharding": op2_sharding, "op3_token_codes": op3_token_codes, "op4_toxicity": op4_toxicity, "op5_neighbours": op5_neighbours, "op6_warc": op6_warc,
    "op7_language": op7_language, "op8_paragraph_sketch": op8_paragraph_sketch,
    "op9_near_duplicates": op9_near_duplicates, "op10_mixing": op10_mixing, "op11_quality": op11_quality, "op12_whitening": op12_whitening, "op13_phrases": op13_phrases,
}
ORACLES: dict[str, str] = {"op6_warc": OP6_SQL, "op9_near_duplicates": OP9_SQL, "op13_phrases": OP13_SQL}
