"""Token ids in files of directly addressable codes.

A file holds the documents of a span of the id order. Ids are renumbered by how often the file uses them,
so that frequent ones are small; the renumbering is in the file. Each number is split into chunks of
`WIDTHS` bits: level 0 has the lowest chunk of every token, and a bitmap bit that says whether the token
goes on; level 1 has the next chunk of just those that do, and so on. A rank directory holds the number of
set bits before every 512th, so token i is found at level k by k rank look-ups: three small reads, and no
block is decoded on the way.

Layout: magic, length of the header (4 bytes), header (JSON: counts and offsets), then sections: document
ids, their NULL marks, document starts, renumbering, and per level chunks, bitmap, directory.

Defined results: NULL or empty text is a document of the end id alone; repeated ids keep all their rows, in
the order of their texts; NULL ids come first; an empty table gives no file.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ARROW_ROWS, keep, new_path, read_file, write_file
from .tokens import END_ID, encoder, texts_of

MAGIC = b"DACTOK01"
WIDTHS = (8, 8, 16)  # bits of a chunk, level by level; together 32
RANK = 512  # bits between two entries of a rank directory


def pack_file(doc_ids: Sequence[int | None], token_lists: Sequence[bytes]) -> bytes:
    """One file of documents, each a string of little-endian unsigned 32-bit ids."""
    tokens = np.frombuffer(b"".join(token_lists), "<u4")
    used, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    by_use = np.lexsort((used, -counts))
    place = np.empty(len(used), np.uint32)
    place[by_use] = np.arange(len(used), dtype=np.uint32)
    values = place[inverse] if len(tokens) else tokens
    sections = {
        "ids": np.array([0 if d is None else d for d in doc_ids], "<i8"),
        "nulls": np.array([d is None for d in doc_ids], "u1"),
        "starts": np.cumsum([0] + [len(t) // 4 for t in token_lists]).astype("<i8"),
        "names": used[by_use].astype("<u4"),
    }
    levels = 0
    for k, width in enumerate(WIDTHS):
        more = values >> width if width < 32 else np.zeros_like(values)
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        ones = np.concatenate([[0], np.cumsum(np.add.reduceat(goes_on, np.arange(0, len(goes_on), RANK)))]) if len(values) else np.zeros(1)
        sections |= {f"chunks{k}": (values & ((1 << width) - 1)).astype("u1" if width <= 8 else "<u2"), f"bits{k}": bits,
                     f"ranks{k}": ones.astype("<u4")}
        values, levels = more[goes_on], k + 1
        if not len(values):
            break
    header = {"documents": len(doc_ids), "tokens": len(tokens), "levels": levels, "widths": WIDTHS, "sections": {}}
    at = 0
    for name, data in sections.items():
        header["sections"][name] = [at, data.nbytes]
        at += data.nbytes
    head = json.dumps(header).encode()
    return MAGIC + len(head).to_bytes(4, "little") + head + b"".join(d.tobytes() for d in sections.values())


class TokenFile:
    """Random access to a file's tokens and documents; `data` may be a memory map."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        size = int.from_bytes(data[8:12], "little")
        self.header, base = json.loads(data[12:12 + size]), 12 + size
        kinds = {"ids": "<i8", "starts": "<i8", "names": "<u4", "ranks": "<u4", "chunks0": "u1", "chunks1": "u1", "chunks2": "<u2"}

        def section(name: str) -> np.ndarray:
            at, length = self.header["sections"][name]
            kind = kinds.get(name) or kinds.get(name.rstrip("0123456789"), "u1")
            return np.frombuffer(data, kind, length // np.dtype(kind).itemsize, base + at)

        self.ids, self.nulls, self.starts, self.names = (section(n) for n in ("ids", "nulls", "starts", "names"))
        self.levels = [tuple(section(f"{n}{k}") for n in ("chunks", "bits", "ranks")) for k in range(self.header["levels"])]

    def _rank(self, level: int, i: int) -> int:
        """Set bits before position i: one directory entry and at most 64 bytes."""
        _, bits, ranks = self.levels[level]
        block = i // RANK
        some = np.unpackbits(bits[block * RANK // 8:(i + 7) // 8], bitorder="little")[:i - block * RANK]
        return int(ranks[block]) + int(some.sum())

    def tokens(self, first: int, last: int) -> np.ndarray:
        """Ids of the positions first..last-1."""
        out = np.zeros(last - first, np.uint32)
        at, shift, low, high = np.arange(last - first), 0, first, last
        for k, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks[low:high].astype(np.uint32) << np.uint32(shift)
            goes_on = np.unpackbits(bits[low // 8:(high + 7) // 8], bitorder="little")[low % 8:low % 8 + high - low].astype(bool)
            at = at[goes_on]
            if not len(at):
                break
            low = self._rank(k, low)
            high, shift = low + len(at), shift + WIDTHS[k]
        return self.names[out]

    def token(self, i: int) -> int:
        return int(self.tokens(i, i + 1)[0])

    def document(self, n: int) -> np.ndarray:
        return self.tokens(int(self.starts[n]), int(self.starts[n + 1]))


def write(docs: DataFrame, tokenizer: str, folder: str, file_tokens: int = 1 << 22, end_id: int = END_ID) -> DataFrame:
    """Encode all documents in ascending id order; the kept manifest: part, seq, file, documents, tokens, bytes.

    The texts are dealt into ranges of the id (one shuffle), encoded where they land and written at once.
    """
    ranged = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
              .sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id()))
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, ids, lists, held, seq, part = np.uint32(end_id).tobytes(), [], [], 0, 0, 0

        def roll() -> pa.RecordBatch:
            nonlocal ids, lists, held, seq
            data = pack_file(ids, lists)
            name = f"{folder}/tokens-{part:06d}-{seq:05d}.dac"
            write_file(name, data)
            row = {"part": part, "seq": seq, "file": name, "documents": len(ids), "tokens": held, "bytes": len(data)}
            ids, lists, held, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for whole in batches:
            for at in range(0, whole.num_rows, ARROW_ROWS):
                batch = whole.slice(at, ARROW_ROWS)
                part = batch.column(2)[0].as_py()
                for doc, tokens in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode(texts_of(batch.column(1))), strict=True):
                    ids.append(doc)
                    lists.append(tokens + end)
                    held += len(tokens) // 4 + 1
                    if held >= file_tokens:
                        yield roll()
        if ids:
            yield roll()

    return keep(ranged.mapInArrow(run, "part int, seq int, file string, documents long, tokens long, bytes long"))


def read(manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), ids (little-endian unsigned 32-bit)."""
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("in_part"))  # one row for each range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("first"))
    files = (manifest.join(F.broadcast(first), "part")
             .select("file", (F.col("first") + F.coalesce(F.sum("tokens").over(earlier), F.lit(0))).alias("first")))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                f = TokenFile(read_file(name))
                for at in range(0, len(f.ids), 256):
                    some = range(at, min(at + 256, len(f.ids)))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([None if f.nulls[n] else int(f.ids[n]) for n in some], pa.int64()),
                        pa.array([start + int(f.starts[n]) for n in some], pa.int64()),
                        pa.array([f.document(n).astype("<u4").tobytes() for n in some], pa.binary())], schema=schema)

    return files.repartition(max(1, manifest.count()), "file").mapInArrow(run, "doc_id long, start long, ids binary")


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, **limits: int) -> DataFrame:
    """Write to a new shared folder and read back."""
    return read(write(docs, tokenizer, new_path(spark, "tokens"), **limits))
