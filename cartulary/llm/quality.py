"""Quality by gradient-boosted trees over document statistics, with a fixed base rule in front.

Every whole text becomes one row of statistics. The trees are grown on a bounded sample of labelled texts: log loss,
Newton steps, splits between quantile bins, and a sign for chosen features that every split must keep (`SIGNS`: more
symbols, repeated lines or repeated words never raise a score). Leaves of the two sides of such a split are held apart
by the middle of their values, so the whole sum keeps the sign. All trees are flattened into a few arrays of nodes, and
a batch of texts walks down all of them at once, a level at a time.

The sample is the `SAMPLE_ROWS` labelled texts of smallest id hash; labels, ids, languages and sources are never
features. Everything else reads all rows and whole texts.

Defined results: NULL and empty text have no words and fail the base rule; without labels of both classes every text is
kept that passes the base rule; labels that disagree for one id count as low; NULL ids and labels are nobody's label;
repeated rows are judged alike; a text of any length is one row of statistics; an empty table gives no rows; columns other
than id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows

SYMBOLS = b"#*$%&|<>"  # fixed value: what the contract counts as symbols
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"  # fixed value: what parts words
MARKS = ".,;:!?"
SAMPLE_ROWS = 20_000  # labelled texts the trees are grown on, at most
TREES, DEPTH, RATE, BINS, RIDGE, LEAST_WEIGHT = 80, 4, 0.15, 64, 1.0, 1.0

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features and the sign a larger value must have in the score (0: none).
SIGNS = {"log_words": 0, "word_length": 0, "symbols": -1, "duplicate_lines": -1, "repeated_words": -1, "upper": 0, "digits": 0, "marks": 0,
         "letters": 0, "distinct_words": 0, "commonest_word": 0, "words_a_line": 0, "shouts": 0}
_KINDS = np.array([1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c in MARKS else 0 for c in map(chr, range(1 << 16))], np.uint8)


def _repeated(ids: np.ndarray) -> int:
    """Words that lie in a window of three words found twice or more."""
    n = len(ids) - 2
    if n < 2:
        return 0
    pairs = ids[:-1] * (int(ids.max()) + 1) + ids[1:]
    if int(pairs.max()) >= 1 << 31:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, at, times = np.unique(pairs[:-1] * (int(ids.max()) + 1) + ids[2:], return_inverse=True, return_counts=True)
    found = np.zeros(len(ids) + 1, np.int64)
    some = np.flatnonzero(times[at] > 1)
    np.add.at(found, some, 1)
    np.add.at(found, np.minimum(some + 3, len(ids)), -1)
    return int((np.cumsum(found[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The contract's counts and the features of one whole text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    lines = [line for line in data.split(b"\n") if line.strip(BLANKS)]
    chars = len(text) - (len(data) - len(data.translate(None, BLANKS)))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    repeated, duplicate = _repeated(ids), len(lines) - len(set(lines))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    upper, lower, digits, marks = np.bincount(_KINDS[np.minimum(points, (1 << 16) - 1)], minlength=5)[1:].tolist()
    some, inside = max(n, 1), max(chars, 1)
    features = [np.log1p(n), chars / some, symbols / inside, duplicate / max(len(lines), 1), repeated / some, upper / max(upper + lower, 1), digits / inside,
                marks / inside, (upper + lower) / inside, len(known) / some, int(np.bincount(ids).max()) / some if n else 0.0, n / max(len(lines), 1),
                data.count(b"!") / some]
    return [n, chars, symbols, duplicate, repeated], features


@dataclass
class Trees:
    """Nodes of all trees: where a row goes on, or (a leaf goes to itself) what it adds to the score."""

    start: float
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    limit: np.ndarray = field(default_factory=lambda: np.zeros(0))
    low: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    high: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    depth: int = 0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of high quality of each row."""
        margin = np.full(len(x), self.start)
        if len(x) and len(self.roots):
            at, row = np.tile(self.roots, (len(x), 1)), np.arange(len(x))[:, None]
            for _ in range(self.depth):
                at = np.where(x[row, self.feature[at]] <= self.limit[at], self.low[at], self.high[at])
            margin += self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def grow(x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boosted trees of log loss on the rows `x`; `signs` holds -1, 0 or 1 for each feature."""
    if len(set(y.tolist())) < 2:
        return Trees(500.0)  # nothing to tell apart: all are kept
    mean = y.mean()
    model = Trees(float(np.log(mean / (1 - mean))), depth=depth)
    limits = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins = np.stack([np.searchsorted(cut, c) for cut, c in zip(limits, x.T, strict=True)], axis=1)
    nodes: list[list] = []  # feature, limit, low, high, value
    roots, margin = [], np.full(len(x), model.start)

    def leaf(g: float, h: float, least: float, most: float) -> float:
        return float(np.clip(-g / (h + RIDGE), least, most))

    def loss(g, h, w):
        return g * w + 0.5 * (h + RIDGE) * w * w

    def best(rows: np.ndarray, g: np.ndarray, h: np.ndarray, least: float, most: float):
        """(gain, feature, bin, value of the low side, of the high side) of the best split that keeps the signs."""
        found = (1e-9, 0, 0, 0.0, 0.0)
        gs, hs = g[rows].sum(), h[rows].sum()
        now = loss(gs, hs, leaf(gs, hs, least, most))
        for j, cut in enumerate(limits):
            if not len(cut):
                continue
            b = bins[rows, j]
            gl = np.cumsum(np.bincount(b, g[rows], len(cut) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[rows], len(cut) + 1))[:-1]
            wl, wr = (np.clip(-a / (c + RIDGE), least, most) for a, c in ((gl, hl), (gs - gl, hs - hl)))
            gain = now - loss(gl, hl, wl) - loss(gs - gl, hs - hl, wr)
            gain[(hl < LEAST_WEIGHT) | (hs - hl < LEAST_WEIGHT) | (signs[j] * (wr - wl) < 0)] = -np.inf
            i = int(gain.argmax())
            if gain[i] > found[0]:
                found = (float(gain[i]), j, i, float(wl[i]), float(wr[i]))
        return found

    def build(rows: np.ndarray, g: np.ndarray, h: np.ndarray, left: int, least: float, most: float) -> int:
        at = len(nodes)
        nodes.append([0, 0.0, at, at, 0.0])
        gain, j, i, wl, wr = best(rows, g, h, least, most) if left else (0.0, 0, 0, 0.0, 0.0)
        if not left or gain <= 1e-9:
            nodes[at][4] = rate * leaf(g[rows].sum(), h[rows].sum(), least, most)
            margin[rows] += nodes[at][4]
            return at
        middle = (wl + wr) / 2
        under, over = ((least, middle), (middle, most)) if signs[j] > 0 else ((middle, most), (least, middle)) if signs[j] < 0 else ((least, most),) * 2
        side = bins[rows, j] <= i
        low, high = build(rows[side], g, h, left - 1, *under), build(rows[~side], g, h, left - 1, *over)
        nodes[at][:4] = [j, float(limits[j][i]), low, high]
        return at

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(build(np.arange(len(x)), p - y, p * (1 - p), depth, -np.inf, np.inf))
    columns = list(zip(*nodes, strict=True))
    model.feature, model.low, model.high = (np.array(columns[i], np.int64) for i in (0, 2, 3))
    model.limit, model.value, model.roots = np.array(columns[1]), np.array(columns[4]), np.array(roots)
    return model


def _measured(rows: DataFrame, model: Trees | None = None) -> DataFrame:
    """id, the counts, the features, and the score when there is a model."""
    held = rows.sparkSession.sparkContext.broadcast(model)  # a few thousand nodes

    def work(batch: pa.RecordBatch):
        told = [statistics(t) for t in batch.column(1).to_pylist()]
        counts = np.array([t[0] for t in told], np.int64).reshape(-1, len(COUNTS))
        features = np.array([t[1] for t in told], float).reshape(-1, len(SIGNS))
        score = held.value.score(features) if held.value is not None else np.zeros(len(told))
        yield {"id": batch.column(0), **dict(zip(COUNTS, counts.T, strict=True)), "features": list(features), "score": score}

    return arrow_rows(rows, work, f"id long, {', '.join(f'{c} long' for c in COUNTS)}, features array<double>, score double")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Trees from the `sample_rows` labelled texts of smallest id hash; their statistics alone reach the driver."""
    known = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("__id"))
             .agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("__id"), "__id").limit(sample_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").join(F.broadcast(known.select("__id")), "__id", "left_semi")  # sample_rows ids
    rows = (_measured(texts).select(F.col("id").alias("__id"), "features").join(known, "__id")
            .orderBy(F.xxhash64("__id"), "features", "quality").limit(sample_rows).select("features", "quality").toArrow())
    x = np.array(rows["features"].to_pylist(), float).reshape(-1, len(SIGNS))
    return grow(x, (rows["quality"].to_numpy() > 0).astype(float), np.array(list(SIGNS.values())))


def judge(docs: DataFrame, model: Trees, least_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """(doc_id, the counts, base_failed, score, kept) of every text."""
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return (_measured(docs.select(F.col("doc_id").cast("long"), "text"), model)
            .select(F.col("id").alias("doc_id"), *COUNTS, failed.alias("base_failed"), "score", (~failed & (F.col("score") >= 0.5)).alias("kept")))
