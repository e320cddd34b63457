"""Nearest neighbours by shifted space-filling curves.

Each curve projects the vectors on a few random orthogonal directions, shifts and scales them into a grid,
and orders them along the Hilbert curve of that grid. Every curve's order is cut into `ranges` of nearly
equal counts, and a query meets all vectors of its own range and of the `reach` ranges on either side; the
windows of all curves are merged and ranked by exact distance in double precision. The share of the table a
window covers is the same at every size. The higher the inner dimension of the data, the larger it must be:
vectors without structure leave any ordering little to go by, and then the windows together read most rows.

The directions need no data. Shift, scale and range borders come from a bounded sample of `sample_rows`
vectors; every row is indexed. Ranges are cut into tiles of bounded size on both sides, so no task holds more
than two tiles. Equal vectors are one entry of the index with the `k` + 1 smallest ids, more of which no answer can hold.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do
those of another length than most (ties: the longer); a repeated id counts once for each of its vectors;
an empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, keep

BITS = 10


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of cells (n, dimensions), each coordinate below 2**bits.

    Gray-code form: from the top bit down, a set bit of a coordinate flips the lower bits of the first
    coordinate, a clear one swaps them with it.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


@dataclass
class Curves:
    directions: np.ndarray  # (curves, axes, length)
    low: np.ndarray  # (curves, axes), shifted
    width: np.ndarray

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """(n, curves)"""
        out = []
        for d, low, width in zip(self.directions, self.low, self.width, strict=True):
            cells = np.clip((vectors @ d.T - low) / width * (1 << BITS), 0, (1 << BITS) - 1)
            out.append(hilbert(cells, BITS))
        return np.stack(out, 1) if out else np.zeros((len(vectors), 0), np.int64)


def directions(length: int, curves: int, axes: int, seed: int) -> np.ndarray:
    """Orthogonal axes, across curves too as far as the length allows."""
    rng = np.random.default_rng(seed)
    rows: list[np.ndarray] = []
    while len(rows) < curves * axes:
        rows += list(np.linalg.qr(rng.standard_normal((length, length)))[0].T)
    return np.array(rows[:curves * axes]).reshape(curves, axes, length)


def fit(vectors: DataFrame, length: int, curves: int = 10, axes: int = 4, ranges: int = 16, sample_rows: int = 10_000, seed: int = 11) -> tuple[Curves, np.ndarray]:
    """Curves and, for each, the inner borders of its ranges, from the `sample_rows` vectors of the smallest hash."""
    sample = np.array([r[0] for r in vectors.orderBy(F.xxhash64("vector")).limit(sample_rows).select("vector").collect()], float)
    axis = directions(length, curves, axes, seed)
    if not len(sample):
        return Curves(axis, np.zeros(axis.shape[:2]), np.ones(axis.shape[:2])), np.zeros((curves, 0), np.int64)
    at = np.einsum("nd,cad->nca", sample, axis)
    low, high = np.quantile(at, (0.001, 0.999), axis=0)
    span = np.maximum(high - low, 1e-300)
    shift = np.random.default_rng(seed + 1).random(low.shape) * span / 4  # the grid is a quarter wider than the data
    made = Curves(axis, low - shift, span * 1.25)
    borders = np.quantile(made.keys(sample), np.arange(1, ranges) / ranges, axis=0, method="lower").T
    return made, borders


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1) for c in chunks if len(c)] or [np.zeros((0, 1))])


def valid(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, vector) of the vectors that take part, and their length."""
    v = F.col(vector_col)
    usable = (df.where(F.col(id_col).isNotNull() & F.forall(v, _finite) & F.exists(v, lambda x: x != 0))
              .select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vector")))
    lengths = usable.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    length = lengths[0]["n"] if lengths else 1
    return usable.where(F.size("vector") == length), length


def _finite(x: Column) -> Column:
    return F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))


def search(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, curves: int = 10, axes: int = 4,
           ranges: int = 16, reach: int = 1, tile_rows: int = 4096, tile_queries: int = 1024, seed: int = 11) -> DataFrame:
    """The k nearest found of each query: query_id, rank, vec_id, score. `is_query` is a condition on `id`."""
    rows, length = valid(df, id_col, vector_col)
    rows = keep(rows)
    made, borders = fit(rows, length, curves, axes, ranges, seed=seed)

    smallest = Window.partitionBy("vector").orderBy("id")
    index = keep(rows.distinct().withColumn("__n", F.row_number().over(smallest)).where(F.col("__n") <= k + 1)
                 .groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("entry", F.element_at("ids", 1)))
    asked = keep(rows.where(is_query).select("id", "vector").distinct())
    probes = keep(asked.groupBy("vector").agg(F.min("id").alias("probe")))
    tiles = 1 + index.count() // (ranges * tile_rows)
    query_tiles = 1 + probes.count() * (2 * reach + 1) // (ranges * tile_queries)

    def placed(batch: pa.RecordBatch):
        """Adds each vector's range on every curve."""
        keys = made.keys(_matrix(batch.column("vector")))
        spans = np.stack([np.searchsorted(borders[c], keys[:, c], "right") for c in range(curves)], 1)
        yield {n: batch.column(n) for n in batch.schema.names} | {"span": spans.tolist()}

    entries = arrow_rows(index.select("entry", "ids", "vector"), placed, "entry long, ids array<long>, vector array<double>, span array<int>")
    probing = arrow_rows(probes, placed, "vector array<double>, probe long, span array<int>")
    one = F.sequence(F.lit(0), F.lit(query_tiles - 1))
    cells = (entries.select("*", F.posexplode("span").alias("curve", "range"))
             .select("entry", "ids", "vector", "curve", "range", F.pmod(F.xxhash64("entry"), F.lit(tiles)).cast("int").alias("tile"), F.explode(one).alias("part")))
    near = F.sequence(F.greatest(F.col("at") - reach, F.lit(0)), F.least(F.col("at") + reach, F.lit(ranges - 1)))
    asks = (probing.select("*", F.posexplode("span").alias("curve", "at"))
            .select("probe", "vector", "curve", F.explode(near).alias("range"), F.pmod(F.xxhash64("probe"), F.lit(query_tiles)).cast("int").alias("part"))
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile")))
    schema = pa.schema([("probe", pa.int64()), ("entry", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])

    def nearest(queries: pa.Table, some: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and some.num_rows:
            vectors = _matrix(some.column("vector"))
            entry, ids = some.column("entry").to_numpy(), some.column("ids").to_pylist()
            for probe, q in zip(queries.column("probe").to_pylist(), _matrix(queries.column("vector")), strict=True):
                score = np.sqrt(((vectors - q) ** 2).sum(axis=1))
                best = np.lexsort((entry, score))[:k + 1]
                out += [{"probe": probe, "entry": int(entry[i]), "ids": ids[i], "score": float(score[i])} for i in best]
        return pa.Table.from_pylist(out, schema=schema)

    at = ["curve", "range", "tile", "part"]
    found = (asks.groupBy(*at).cogroup(cells.groupBy(*at)).applyInArrow(nearest, "probe long, entry long, ids array<long>, score double")
             .dropDuplicates(["probe", "entry"]).select("probe", "score", F.explode("ids").alias("vec_id")))
    by_nearness = Window.partitionBy("probe").orderBy("score", "vec_id")
    best = found.withColumn("__n", F.row_number().over(by_nearness)).where(F.col("__n") <= k + 1)
    answered = (asked.join(probes, "vector").select(F.col("id").alias("query_id"), "probe").join(best, "probe").where("query_id != vec_id"))
    ranked = answered.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
