"""Embedding whitening on the leading eigenvectors of the covariance, by a block Jacobi-Davidson method.

The covariance is never formed. A product with it is one pass over the vectors: every task centres its rows, projects
them on the block of directions and returns the sums, so a pass costs as much as its directions, whatever the rows.
The search space grows by corrections t of the leading unfinished Ritz vectors u (value e), which solve
(I - QQ')(V - eI)(I - QQ')t = -r, Q holding the locked vectors and u. A few MINRES steps solve all of a block's
equations at once, one pass a step. Rayleigh-Ritz in the space gives the next Ritz vectors; a vector whose residual is
at the rounding error of the pass is locked, in falling order of the values, until all asked for are. A full space
shrinks to its leading Ritz vectors. Directions, sums and the projected problem are on the driver: columns times
`MOST` numbers, however many rows there are.

Entries become whole numbers, floor(1024 c) + 100000 of c as double; all sums of these are exact. Vectors are kept as
blocks of whole numbers in the shared folder, so a lost executor costs one block's reading.

Defined results: rows whose vector is NULL, empty or holds NULL or non-finite entries take no part, nor do vectors
whose number of entries is not the commonest one (of several, the largest); NULL ids and repeated rows count each;
components whose value is not above rounding (a table of one vector has none) are left out, and so are all rows when none
is left; a deviation is exact at any size (a decimal of 38 digits). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

SCALE, SHIFT = 1024, 100_000  # fixed values: how entries become whole numbers
BLOCK_ROWS = 4096
MOST = 64  # directions in the search space
INNER = 3  # MINRES steps for a correction
PASSES = 400  # passes after which the method gives up
EPS = float(np.finfo(float).eps)


@dataclass
class Fit:
    n: int
    sums: list[int]  # exact sum of each dimension
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a column each
    trace: float
    passes: int


def blocks(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Kept: ids, x (int64, row by row), d of at most BLOCK_ROWS vectors of the commonest length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def out(d):
            ids, x = held.pop(d)
            return pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([len(ids)]), pa.array([ids], pa.list_(pa.int64())),
                                               pa.array([np.concatenate(x).tobytes()])], names=["d", "rows", "ids", "x"])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not v.is_valid or not len(v.values) or v.values.null_count:
                    continue
                c = v.values.to_numpy().astype(float)
                if not np.isfinite(c).all():
                    continue
                ids, x = held.setdefault(len(c), ([], []))
                ids.append(i)
                x.append(np.floor(SCALE * c).astype(np.int64) + SHIFT)
                if len(ids) == BLOCK_ROWS:
                    yield out(len(c))
        for d in list(held):
            yield out(d)

    rows = vectors.select(F.col(key).cast("long"), F.col(vector).cast("array<double>"))
    held = keep(rows.mapInArrow(run, "d int, rows long, ids array<long>, x binary"))
    usual = held.groupBy("d").agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), F.desc("d")).first()
    return held.where(F.col("d") == (usual["d"] if usual else 0))


def _summed(held: DataFrame, work: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sums over all blocks of what `work` makes of a block's rows: as many numbers as it returns, whatever the rows."""

    def run(batches):
        total = None
        for batch in batches:
            for d, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = work(np.frombuffer(x.as_buffer(), np.int64).reshape(-1, d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "value"])

    sums = (held.select("d", "x").mapInArrow(run, f"at long, value {kind}")
            .groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)") if kind == "long" else F.col("value")).alias("value"))
            .toArrow().sort_by("at"))
    return np.array(sums["value"].to_pylist())


def _minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """Minimal residual solutions of one symmetric system a column, in step, from their Lanczos bases."""
    d, k = b.shape
    size = np.linalg.norm(b, axis=0)
    basis = [b / np.where(size > 0, size, 1)]
    t = np.zeros((k, steps + 1, steps))
    for j in range(steps):
        w = apply(basis[j])
        for _ in range(2):  # twice is enough
            for i, v in enumerate(basis):
                h = (v * w).sum(axis=0)
                t[:, i, j] += h
                w = w - v * h
        h = np.linalg.norm(w, axis=0)
        t[:, j + 1, j] = h
        basis.append(w / np.where(h > 0, h, 1))
    out = np.zeros_like(b)
    for c in range(k):
        y = np.linalg.lstsq(t[c], np.r_[size[c], np.zeros(steps)], rcond=None)[0]
        out[:, c] = sum(basis[j][:, c] * y[j] for j in range(steps))
    return out


def _outside(t: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Orthonormal columns for what of `t` lies outside the others; directions that are only rounding go."""
    for _ in range(2):
        for q in others:
            t = t - q @ (q.T @ t)
        t = t / np.maximum(np.linalg.norm(t, axis=0), np.finfo(float).tiny)
    u, s, _ = np.linalg.svd(t, full_matrices=False)
    t = u[:, s > 1e-8 * max(s.max(initial=0), 1e-8)]
    for q in others:
        t = t - q @ (q.T @ t)
    return np.linalg.qr(t)[0] if t.shape[1] else t


def leading(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, norm: float, most: int = MOST, inner: int = INNER, passes: int = PASSES):
    """(values, vectors) of the `wanted` largest eigenvalues of a symmetric operator that is only known by its products.

    `norm` bounds the largest value (a trace does). Residuals are told from zero by the rounding error of a product.
    """
    spent = 0

    def times(w):
        nonlocal spent
        spent += 1
        return product(w)

    block, most = min(d, 2 * wanted), max(most, 4 * wanted)
    rng = np.random.default_rng(11)
    locked, values = np.zeros((d, 0)), []
    space = np.linalg.qr(rng.standard_normal((d, block)))[0]
    image = times(space)
    best = np.inf
    while len(values) < wanted:
        h = space.T @ image
        e, s = np.linalg.eigh((h + h.T) / 2)
        e, s = e[::-1], s[:, ::-1]
        u, au = space @ s, image @ s
        r = au - u * e
        r -= locked @ (locked.T @ r)
        error = np.linalg.norm(r, axis=0)
        level = 8 * EPS * max(abs(e[0]), values[0] if values else 0.0) * np.sqrt(d)
        done = 0
        while done < len(e) and len(values) + done < wanted and error[done] <= level:
            done += 1
        if done:
            locked, values = np.c_[locked, u[:, :done]], [*values, *e[:done]]
            space, image, u, au, r, e, error, best = u[:, done:], au[:, done:], u[:, done:], au[:, done:], r[:, done:], e[done:], error[done:], np.inf
        if len(values) == wanted:
            break
        if spent >= passes:
            raise RuntimeError(f"residual {error[0]} after {spent} passes")
        full = space.shape[1] + locked.shape[1] >= d
        if full and error[0] >= best / 2:  # no direction is missing and rounding is all that is left
            level = max(level, 64 * EPS * norm)
            if error[0] <= level:
                locked, values = np.c_[locked, u[:, :1]], [*values, e[0]]
                space, image, best = u[:, 1:], au[:, 1:], np.inf
                continue
        best = min(best, error[0])
        if full or space.shape[1] + block > most:  # thick restart, with products of the new directions themselves
            space = _outside(u[:, :min(max(2 * block, wanted), len(e))], locked)
            image = times(space)
            if full:
                rest = _outside(rng.standard_normal((d, d)), locked, space) if space.shape[1] + locked.shape[1] < d else None
                if rest is not None and rest.shape[1]:
                    space, image = np.c_[space, rest], np.c_[image, times(rest)]
            continue
        some = np.arange(min(block, len(e)))
        some = some[error[some] > level][:block]
        x, shift = u[:, some], e[some]

        def inside(w, x=x):
            w = w - locked @ (locked.T @ w)
            return w - x * (x * w).sum(axis=0)

        t = _minres(lambda w, shift=shift, inside=inside: inside(times(inside(w)) - inside(w) * shift), -inside(r[:, some]), inner) if inner else -r[:, some]
        t = _outside(t, locked, space)
        if not t.shape[1]:
            t = _outside(rng.standard_normal((d, block)), locked, space)
        space, image = np.c_[space, t], np.c_[image, times(t)]
    order = np.argsort(values)[::-1]
    return np.array(values)[order], locked[:, order], spent


def fit(held: DataFrame, wanted: int = 8) -> Fit:
    """Exact sums, then the leading eigenvectors of the covariance (divisor n) of all vectors."""
    size = held.agg(F.sum("rows").alias("n"), F.max("d").alias("d")).first()
    n, d = size["n"] or 0, size["d"] or 0
    if not n:
        return Fit(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0)
    sums = [int(s) for s in _summed(held, lambda x: x.sum(axis=0), "long")]
    centre = _centre(n, sums)
    trace = float(_summed(held, lambda x: np.array([(centre(x) ** 2).sum() / n]))[0])

    def product(w):
        def work(x):
            c = centre(x)
            return c.T @ (c @ w) / n
        return _summed(held, work).reshape(w.shape)

    if not trace:
        return Fit(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0, 0)
    values, vectors, spent = leading(product, d, min(wanted, d), trace)
    real = values > 64 * EPS * d * values[0]
    return Fit(n, sums, values[real], vectors[:, real], trace, spent)


def _centre(n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """x - S / n with one rounding: the whole part of S / n is taken off as a whole number."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([float(s % n) / n for s in sums])
    return lambda x: (x - whole) - rest


def _deviations(n: int, sums: list[int]) -> Callable[[np.ndarray], list[int]]:
    """Exact sums of (n x - S)^2, in 64 bits while they fit and in Python's whole numbers beyond."""
    small = n < 1 << 40 and max(map(abs, sums), default=0) < 1 << 62

    def work(x: np.ndarray) -> list[int]:
        if small and (not x.size or int(np.abs(x).max()) * n < 1 << 62):
            away = n * x - np.array(sums, np.int64)
            if int(np.abs(away).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
                return (away * away).sum(axis=1).tolist()
        away = x.astype(object) * n - np.array(sums, object)
        return [int(v) for v in (away * away).sum(axis=1)]

    return work


def whitened(held: DataFrame, model: Fit) -> tuple[DataFrame, float]:
    """(id, component, n, deviation, whitened, explained of every vector and component; the identity error of them all)."""
    schema = "id long, component int, n long, deviation decimal(38,0), whitened double, explained double"
    if not len(model.values):
        return held.sparkSession.createDataFrame([], schema), 0.0
    centre, deviation = _centre(model.n, model.sums), _deviations(model.n, model.sums)
    to = model.vectors / np.sqrt(model.values)
    n, k, share = model.n, len(model.values), model.values / model.trace
    mean = _summed(held, lambda x: (centre(x) @ to).sum(axis=0) / n)

    def spread(x):
        c = centre(x) @ to - mean
        return c.T @ c / n

    error = float(np.abs(_summed(held, spread).reshape(k, k) - np.eye(k)).max())

    def run(batches):
        for batch in batches:
            for d, ids, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                x = np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, d)
                w, away = centre(x) @ to, pa.array([Decimal(v) for v in deviation(x)], pa.decimal128(38, 0))
                row = np.repeat(np.arange(len(ids)), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()).take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids))),
                     pa.array(np.full(len(row), n)), away.take(pa.array(row)), pa.array(w.ravel()), pa.array(np.tile(share, len(ids)))],
                    names=["id", "component", "n", "deviation", "whitened", "explained"])

    return held.select("d", "ids", "x").mapInArrow(run, schema), error


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", wanted: int = 8) -> tuple[DataFrame, float, Fit]:
    held = blocks(vectors, key, vector)
    model = fit(held, wanted)
    rows, error = whitened(held, model)
    return rows, error, model
