"""Sequence packing over the length histogram, shortest pack first.

Documents are tokenised once into pieces of at most `room` ids and kept. The histogram of piece lengths
has at most `room` rows whatever the table's size, so the packing itself runs on the driver over counts:
lengths go longest first, each into the emptiest packs, and whole groups of equal packs change at once.
The result is a list of patterns with counts. Pieces ordered by (length, piece) have a global position,
and each span of positions belongs to one place of one pattern, so a piece finds its sequence by rank.

Defined results: NULL or empty text is a document of the end id alone; repeated rows are separate pieces;
an empty table gives no piece; columns of the input other than the named ones are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, keep, running_start
from .tokens import END_ID, encoder, texts_of

Pattern = tuple[tuple[int, ...], int]


def pieces(docs: DataFrame, tokenizer: str, room: int = 2048, id_col: str = "doc_id", text_col: str = "text",
           end_id: int = END_ID) -> DataFrame:
    """Pieces of at most `room` ids: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit), piece."""

    def work(batch: pa.RecordBatch):
        end = np.uint32(end_id).tobytes()
        out = {n: [] for n in ("doc_id", "start", "length", "doc_tokens", "ids")}
        for doc, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode(texts_of(batch.column(1))), strict=True):
            ids += end
            for at in range(0, len(ids), 4 * room):
                part = ids[at:at + 4 * room]
                for n, v in zip(out, (doc, at // 4, len(part) // 4, len(ids) // 4, part), strict=True):
                    out[n].append(v)
        yield out

    cut = arrow_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), work,
                     "doc_id long, start long, length long, doc_tokens long, ids binary")
    return keep(cut.withColumn("piece", F.monotonically_increasing_id()))


def patterns(histogram: Mapping[int, int], room: int = 2048) -> list[Pattern]:
    """Shortest pack first: (lengths in a pack, how many such packs)."""
    open_packs: dict[int, list[Pattern]] = {}
    emptiest: list[int] = []  # free space, negated, of packs that can still take something
    done: list[Pattern] = []

    def put(lengths: tuple[int, ...], count: int) -> None:
        free = room - sum(lengths)
        if not free:
            done.append((lengths, count))
            return
        if free not in open_packs:
            open_packs[free] = []
            heapq.heappush(emptiest, -free)
        open_packs[free].append((lengths, count))

    for length in sorted(histogram, reverse=True):
        left, grown = histogram[length], []
        while left:
            free = -emptiest[0] if emptiest else 0
            if free < length:
                grown.append(((length,), left))
                break
            lengths, count = open_packs[free].pop()
            used = min(count, left)
            if used < count:
                open_packs[free].append((lengths, count - used))
            elif not open_packs[free]:
                del open_packs[free]
                heapq.heappop(emptiest)
            put((*lengths, length), used)
            left -= used
        for g in grown:
            put(*g)
    return done + [p for free in sorted(open_packs) for p in open_packs[free]]


@dataclass
class Packed:
    pieces: DataFrame  # doc_id, start, length, doc_tokens, ids, piece
    places: DataFrame  # piece, sequence_id, offset
    patterns: list[Pattern]

    def rows(self, *columns) -> DataFrame:
        """Pieces with their places; give expressions over the pieces to move less than whole ids."""
        some = self.pieces.select("piece", *(columns or [c for c in self.pieces.columns if c != "piece"]))
        return some.join(self.places, "piece").drop("piece")


def pack(docs: DataFrame, tokenizer: str, room: int = 2048, **columns: str) -> Packed:
    """Every id of every document in exactly one place of one sequence."""
    cut = pieces(docs, tokenizer, room, **columns)
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `room` rows
    plan = patterns(histogram, room)

    at = dict(zip(sorted(histogram), np.cumsum([0] + [histogram[n] for n in sorted(histogram)]).tolist(), strict=False))
    spans, sequence = [], 0
    for lengths, count in plan:
        offset = 0
        for n in lengths:
            spans.append((at[n], sequence, offset))
            at[n] += count
            offset += n
        sequence += count
    first, sequences, offsets = (np.array(sorted(spans), np.int64).reshape(-1, 3)[:, i] for i in range(3))

    @F.pandas_udf("sequence_id long, offset long")
    def place(position: pd.Series) -> pd.DataFrame:
        p = position.to_numpy(np.int64)
        i = np.searchsorted(first, p, "right") - 1
        return pd.DataFrame({"sequence_id": sequences[i] + p - first[i], "offset": offsets[i]})

    ranked = running_start(cut.select("length", "piece"), ["length", "piece"], {"position": F.lit(1).cast("long")})
    places = ranked.select("piece", place("position").alias("at")).select("piece", "at.sequence_id", "at.offset")
    return Packed(cut, places, plan)
