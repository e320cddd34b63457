"""Near duplicates: a multi-index Hamming join of b-bit MinHash signatures, confirmed on full sets.

A text's set holds its distinct shingles of `words` words. Its signature has `chunks` * `chunk_symbols`
symbols of 16 bits, each from one random order of the shingles; two sets of similarity s differ in each
symbol with probability 1 - s. Signatures within `distance()` = chunks * (errors + 1) - 1 differing symbols
must, by the pigeonhole principle, have a chunk with at most `errors` of them, so each chunk gives one key for
every choice of `errors` symbols left out, and all pairs within the distance share a key. With the defaults
(10 chunks of 4, one error: 19 of 40) a pair of similarity 0.8 is beyond it once in about 100,000.

Nothing emits the pairs of a group. Equal texts are one entry. Every key's entries meet its smallest entry
only; pairs within the distance make clusters, and whatever two clusters still share a key is compared and,
where within the distance, merges them. So all pairs within the distance lie inside a cluster. A cluster is
cut into tiles of bounded size; tasks on pairs of tiles confirm links on full shingle sets, skip what is
already connected, and return a forest. Joins on hot keys are left to Spark's skew splitting: they carry
a few numbers a row. Components are found by alternating stars in kept tables, nothing on the driver.

Defined results: NULL or empty text, or text without words, has an empty set and is linked with nothing; a
text of fewer words than a shingle is one shingle; rows with one id count as one document; a row without id
is linked with nothing; repeated rows are equal texts; an empty table gives no row.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, keep

TILE = 2048


def shingles(text: str | None, words: int) -> tuple[np.ndarray, bytes]:
    """The distinct shingles as sorted 64-bit hashes, and a digest of the word sequence. Only A-Z are lower-cased."""
    tokens = (text or "").encode().lower().split()
    digest = xxhash.xxh128_digest(b" ".join(tokens))
    if not tokens:
        return np.zeros(0, np.uint64), digest
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    n = max(len(each) - words + 1, 1)
    mixed = np.full(n, len(each) if len(each) < words else words, np.uint64)
    for i in range(min(words, len(each))):
        mixed = (mixed ^ each[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed), digest


class Signer:
    def __init__(self, symbols: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.flip = rng.integers(0, 1 << 63, symbols, dtype=np.uint64)
        self.times = rng.integers(0, 1 << 63, symbols, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(self, hashes: np.ndarray) -> np.ndarray:
        """16-bit symbols: a mix of the shingle that comes first in each order."""
        least = np.full(len(self.flip), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(hashes), 4096):
            some = (hashes[at:at + 4096, None] ^ self.flip) * self.times
            least = np.minimum(least, (some ^ (some >> np.uint64(32))).min(axis=0))
        return (least * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(48)).astype(np.uint16)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of (a, b): the smallest node it can reach, by alternating large and small stars."""
    known = keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    seen = None
    while True:
        state = known.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        if state == seen:
            return known.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                known.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        seen = state
        both = known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a")
        known = keep(small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(lower.select("a", F.col("m").alias("b"))).distinct())


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, chunks: int = 10, chunk_symbols: int = 4, errors: int = 1,
                    tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links of `percent` similarity or more) of each row."""
    symbols = chunks * chunk_symbols
    distance = chunks * (errors + 1) - 1
    chosen = [(c, kept) for c in range(chunks) for kept in combinations(range(c * chunk_symbols, (c + 1) * chunk_symbols), chunk_symbols - errors)]
    signer = Signer(symbols)

    def sign(batch: pa.RecordBatch):
        sets = [shingles(t, words) for t in batch.column(1).to_pylist()]
        yield {"doc_id": batch.column(0), "digest": [d for _, d in sets], "n": [len(s) for s, _ in sets],
               "signature": [signer.sign(s).tobytes() if len(s) else None for s, _ in sets]}

    signed = keep(arrow_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), sign,
                             "doc_id long, digest binary, n long, signature binary", 512))
    entries = keep(signed.where("n > 0 and doc_id is not null").groupBy("digest")
                   .agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("signature").alias("signature")))

    def index(batch: pa.RecordBatch):
        """The keys of each entry: 16 bits for which chunk and choice, the rest from the symbols kept."""
        s = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, symbols)
        keys = np.empty((len(s), len(chosen)), np.int64)
        for i, (_, kept) in enumerate(chosen):
            k = np.full(len(s), i, np.uint64)
            for at in kept:
                k = ((k ^ s[:, at]) * np.uint64(0x9E3779B97F4A7C15)) if len(kept) > 3 else (k << np.uint64(16)) | s[:, at]
            keys[:, i] = k.view(np.int64)
        yield {"key": keys.ravel(), "node": np.repeat(batch.column("node").to_numpy(), len(chosen)), "n": np.repeat(batch.column("n").to_numpy(), len(chosen))}

    keys = keep(arrow_rows(entries.select("node", "n", "signature"), index, "key long, node long, n long"))

    def sizes_fit(a: str, b: str) -> Column:
        return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)

    def close() -> Column:
        """Signatures `s` and `t` differ in at most `distance` symbols."""
        return sum(((F.substring("s", 2 * i + 1, 2) == F.substring("t", 2 * i + 1, 2)).cast("int") for i in range(symbols)), F.lit(0)) >= symbols - distance

    def within(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose signatures differ in at most `distance` symbols."""
        s = entries.select("node", "signature")
        return (pairs.join(s.select(F.col("node").alias("a"), F.col("signature").alias("s")), "a")
                .join(s.select(F.col("node").alias("b"), F.col("signature").alias("t")), "b")
                .where(close()).select("a", "b"))

    first = keys.groupBy("key").agg(F.min(F.struct("node", "n")).alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    stars = (keys.join(first.select("key", F.col("first.node").alias("b"), F.col("first.n").alias("m")), "key")
             .where((F.col("node") != F.col("b")) & sizes_fit("n", "m")).select(F.col("node").alias("a"), "b").distinct())
    edges = keep(within(stars))
    clusters = keep(components(edges))

    # keys that still hold entries of several clusters: compare across them
    placed = (keys.join(first.select("key"), "key", "left_semi").join(clusters, "node", "left")
              .select("key", "node", "n", F.coalesce("label", "node").alias("label")))
    open_keys = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    left = keep(placed.join(open_keys, "key", "left_semi").join(entries.select("node", F.col("signature").alias("s")), "node"))
    right = left.select("key", F.col("node").alias("b"), F.col("n").alias("m"), F.col("label").alias("other"), F.col("s").alias("t"))
    merged = keep(left.join(right, (left["key"] == right["key"]) & (F.col("node") > F.col("b")) & (F.col("label") != F.col("other")) & sizes_fit("n", "m") & close())
                  .select(F.col("node").alias("a"), "b").distinct())
    if not merged.isEmpty():
        clusters = keep(components(edges.unionByName(merged)))

    links = keep(_confirmed(docs, clusters, signer, words, percent, symbols - distance, tile))
    final = components(links)
    named = entries.select("digest", "node").join(final, "node", "left").select("digest", F.coalesce("label", "node").alias("label"))
    return (signed.select("doc_id", "digest", "n").join(named, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).otherwise(F.col("doc_id")).alias("component_id")))


def _confirmed(docs: DataFrame, clusters: DataFrame, signer: Signer, words: int, percent: int, least_equal: int, tile: int) -> DataFrame:
    """Links (a, b) between entries of one cluster, enough to connect whatever is connected."""

    def sets(batch: pa.RecordBatch):
        made = [shingles(t, words) for t in batch.column("text").to_pylist()]
        yield {"node": batch.column("node"), "label": batch.column("label"), "digest": [d for _, d in made], "shingles": [s.tobytes() for s, _ in made],
               "signature": [signer.sign(s).tobytes() if len(s) else None for s, _ in made]}

    tiles = clusters.groupBy("label").agg(F.expr(f"cast((count(1) + {tile - 1}) div {tile} as int)").alias("tiles"))
    members = arrow_rows(docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(clusters, "node").select("node", "label", "text"), sets,
                         "node long, label long, digest binary, shingles binary, signature binary", 512)
    at = F.when(F.col("tiles") == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    dealt = (members.where("signature is not null").join(tiles, "label").withColumn("tile", at)
             .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
             .withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other"))
             .select("label", "i", "j", "tile", "node", "digest", "shingles", "signature"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def confirm(rows: pa.Table) -> pa.Table:
        first = {}
        for i, key in enumerate(zip(rows.column("node").to_pylist(), rows.column("digest").to_pylist(), strict=True)):
            first.setdefault(key, i)
        rows = rows.take(list(first.values())).sort_by([("node", "ascending")])
        node, side = rows.column("node").to_numpy(), rows.column("tile").to_numpy()
        own, n = rows.column("i")[0].as_py() == rows.column("j")[0].as_py(), rows.num_rows
        each = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
        size = np.array([len(s) for s in each])
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        names, flat = np.unique(np.concatenate(each), return_inverse=True)
        signature = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint16).reshape(n, -1)
        group, out, mark = np.arange(n), [], np.zeros(len(names), bool)
        for x in range(n - 1):
            rest = np.arange(x + 1, n)
            rest = rest[(group[rest] != group[x]) & (own | (side[rest] != side[x]))]
            rest = rest[np.minimum(size[rest], size[x]) * 100 >= np.maximum(size[rest], size[x]) * percent]
            rest = rest[(signature[rest] == signature[x]).sum(axis=1) >= least_equal]
            if not len(rest):
                continue
            mine = flat[starts[x]:starts[x] + size[x]]
            mark[mine] = True
            common = np.array([np.count_nonzero(mark[flat[starts[y]:starts[y] + size[y]]]) for y in rest])
            mark[mine] = False
            linked = rest[common * 100 >= percent * (size[rest] + size[x] - common)]
            for y in linked:
                if group[y] != group[x]:
                    out.append((int(node[x]), int(node[y])))
                    group[group == group[y]] = group[x]
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())}, schema=schema)

    return dealt.groupBy("label", "i", "j").applyInArrow(confirm, "a long, b long")
