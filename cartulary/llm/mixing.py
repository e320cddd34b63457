"""Mixing sources to target weights on a low-discrepancy schedule.

Each source's documents are laid end to end in a shuffled order and cut into blocks of equally many words.
The mix is a list of slots, each taking one block; a source wraps around when its target exceeds its words.
Slot i of the schedule is the van der Corput point of i, mapped through the cumulative slot counts of the
sources, so every stretch of the mix has nearly the weights of the whole. How many of the first i points
fall below a bound has a closed form, so a slot's rank within its source, and with it its block, is computed
where the slot is made: nothing is sorted or counted, and the hot source is spread like any other.

The list of sources with their sizes and targets is on the driver, as mixture weights are: it grows with
the number of sources, not of documents.

Defined results: NULL text has no words and is taken 0 times; NULL sources are one source, last in order;
repeated rows are separate documents; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, arrow_rows, keep, running_start

WEIGHTS = (5, 2, 1)


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = 2.0) -> list[float]:
    """Shares of `total` by weight; none above `most` times its size, the excess shared again by weight."""
    out, open_ = [0.0] * len(sizes), [i for i in range(len(sizes)) if sizes[i]]
    left = float(total)
    while open_:
        share = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if share * weights[i] >= most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = share * weights[i]
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        open_ = [i for i in open_ if i not in full]
    return out


def reversed_bits(i: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros_like(i)
    for k in range(bits):
        out |= ((i >> k) & 1) << (bits - 1 - k)
    return out


def below(i: np.ndarray, bound: np.ndarray, bits: int) -> np.ndarray:
    """How many of the points of 0..i-1 are smaller than `bound`, digit by digit of i."""
    count = np.zeros_like(i)
    for k in range(bits + 1):  # a run of 2**k numbers from p: equally spaced points
        has = (i >> k) & 1 == 1
        p = (i >> (k + 1)) << (k + 1)
        step = 1 << (bits - k)
        inside = (bound - reversed_bits(p, bits) + step - 1) // step
        count += np.where(has, np.clip(inside, 0, 1 << k), 0)
    return count


@dataclass
class Mix:
    sources: list[dict]  # source, size, weight, target, words (the target in whole words), slots
    documents: DataFrame  # carried columns, size, row (its number), source_no, source_size, target, start (in its source's stream)
    taken: DataFrame  # slot, epoch, `from` (first word taken from the document), words, and the document's columns


def mix(docs: DataFrame, block_words: int = 512, total_share: float = 1.5, most: float = 2.0,
        weights: Sequence[float] = WEIGHTS, seed: int = 7, carry: Sequence[str] = ("doc_id", "source")) -> Mix:
    """The mix as rows (slot, document, words taken), and the documents it refers to, with the columns in `carry`."""
    sized = docs.select(
        *carry, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id").alias("__at"), F.xxhash64("text").alias("__tie"))
    laid = keep(running_start(sized, ["source", "__at", "doc_id", "__tie"],
                              {"row": F.lit(1).cast("long"), "__start": F.col("size")}).drop("__at", "__tie"))
    listed = {r["source"]: r["size"] for r in laid.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    in_rows = sorted(listed, key=lambda s: (s is not None, s or ""))  # as Spark orders them: NULL first, then code points
    by_name = in_rows[1:] + in_rows[:1] if in_rows[:1] == [None] else in_rows
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(by_name)}
    goal = targets([listed[s] for s in in_rows], [weight[s] for s in in_rows], total_share * sum(listed.values()), most)
    sources, start = [], 0
    for s, target in zip(in_rows, goal, strict=True):
        size = listed[s]
        words = min(round(target), int(most * size))
        rounds, rest = divmod(words, size) if size else (0, 0)
        blocks = -(-size // block_words)
        sources.append({"source": s, "size": size, "weight": weight[s], "target": target, "words": words, "start": start,
                        "blocks": blocks, "slots": rounds * blocks + -(-rest // block_words), "rounds": rounds, "rest": rest})
        start += size
    known = docs.sparkSession.createDataFrame(
        [(s["source"], i, s["size"], s["target"], s["start"]) for i, s in enumerate(sources)],
        "__s string, source_no int, source_size long, target double, __first long")
    documents = (laid.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("__s")))  # one row for each source
                 .withColumn("start", F.col("__start") - F.col("__first")).drop("__s", "__start", "__first"))
    return Mix(sources, documents, _taken(documents, slots(docs.sparkSession, sources, block_words), block_words))


def slots(spark: SparkSession, sources: Sequence[dict], block_words: int) -> DataFrame:
    """The schedule: (slot, source_no, epoch, block, words to take from the block's start)."""
    counts = np.array([s["slots"] for s in sources], np.int64)
    ends = np.cumsum(counts)
    total = int(counts.sum())
    bits = max(1, (total - 1).bit_length())
    column = {k: np.array([s[k] for s in sources], np.int64) for k in ("blocks", "rounds", "rest")}

    def work(batch: pa.RecordBatch):
        i = batch.column(0).to_numpy().astype(np.int64)
        point = reversed_bits(i, bits)
        i, point = i[point < total], point[point < total]
        no = np.searchsorted(ends, point, "right")
        low = below(i, ends[no] - counts[no], bits)
        rank = below(i, ends[no], bits) - low
        epoch, block = np.divmod(rank, np.maximum(column["blocks"][no], 1))
        words = np.where(epoch < column["rounds"][no], block_words, np.minimum(block_words, column["rest"][no] - block * block_words))
        yield {"slot": below(i, np.full_like(i, total), bits), "source_no": no, "epoch": epoch, "block": block, "words": words}

    return arrow_rows(spark.range(1 << bits if total else 0), work,
                      "slot long, source_no int, epoch long, block long, words long", 1 << 16)


def _taken(documents: DataFrame, schedule: DataFrame, block_words: int) -> DataFrame:
    """Slots joined with the parts of documents that lie in their blocks."""
    parts = (documents.where("size > 0")
             .withColumn("block", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})"))))
    here = F.col("block") * block_words
    first = F.greatest(F.col("start"), here)
    last = F.least(F.col("start") + F.col("size"), here + F.col("words"))
    return (schedule.join(parts, ["source_no", "block"]).withColumn("from", first - F.col("start")).withColumn("words", last - first)
            .where("words > 0"))
