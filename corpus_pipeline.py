"""From raw documents to packed training sequences, stage by stage over written tables.

Language and toxicity only drop the documents they reject; one document of each group of near duplicates
stays; the mix repeats or leaves out whole documents, as the blocks of their sources are scheduled; packing
returns where every piece of every document lies. Rows with NULL ids are kept by the first three stages (a
NULL id is nobody's duplicate); documents without words take no part in the mix. Extra columns go through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartulary.llm import langid, mixing, neardup, packing, toxicity
from cartulary.llm.common import keep, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin."""
    learning = docs.where("lang is not null").where(F.coalesce(langid.fold() % 4 != 2, F.lit(False)))
    told = langid.predict(docs, langid.dictionaries(learning.select("doc_id", "text", "lang")), prefix="__language_")
    return told.where("not __language_rejected").select(*docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model, "__toxicity").where("__toxicity < 0.5").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.8, the document of the smallest id (a repeated row once)."""
    found = neardup.near_duplicates(docs.select("doc_id", "text"), words=5, percent=80)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    same = Window.partitionBy("doc_id", "__text").orderBy("doc_id")
    once = (docs.join(kept, "doc_id", "left_semi").withColumn("__text", F.xxhash64("text")).withColumn("__n", F.row_number().over(same))
            .where("__n = 1").select(*docs.columns))
    return once.unionByName(docs.where("doc_id is null"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the block of its first word is scheduled."""
    marked = docs.withColumn("__text", F.xxhash64("text"))
    mixed = mixing.mix(marked.select("doc_id", "source", "text", "__text"), carry=("doc_id", "source", "__text"))
    times = (mixed.taken.where(F.col("from") == 0).groupBy("row", "doc_id", "__text").agg(F.count(F.lit(1)).alias("n"))
             .groupBy(F.col("doc_id").alias("__id"), F.col("__text").alias("__same")).agg(F.max("n").cast("int").alias("__times")))
    taken = marked.join(times, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__same")))
    return taken.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece's place; the ids themselves are in the packer's table of pieces."""
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.rows("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("mixing", mix), ("packing", pack),
]

#: Compression, language models, signatures and tokenizers are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each reading what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
