"""Toxicity by class-conditional Kneser-Ney models of words.

For each class the probability of a word is its discounted share of the class's words, backed off to counts
both classes share: in how many contexts a word follows (Kneser-Ney's continuation count) and a floor of
`FLOOR` counts, so that an expression seen a few times in one class speaks for it only a little. A text's
evidence is the difference of the two log-likelihoods divided by the number of words, for the whole text and
for its strongest word; a logistic curve over the two, fitted on labelled texts that
the counts have not seen, turns them into a score.

Words are counted once a text, over all labelled texts of the learning folds, by their 64-bit hash, in a
written table that grows with the vocabulary. A continuation count is the exact number of distinct (previous
word, word) pairs. The at most `HOT` words that most texts hold go to every worker; a text's other words are
joined to the table. Ratios are fixed-point numbers, so sums do not depend on the order of the rows. Labels
join the texts by id; a bitmap of fixed size drops most unlabelled texts before they are shuffled.

Defined results: NULL or empty text has no evidence and gets the curve's value at 0; without labels of both
classes every score is 0; repeated rows are scored alike; labels that disagree for one id count as toxic.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, keep

WORDS = re.compile(r"[^\W_]+")
FLOOR, SHARED, DISCOUNT = 10.0, 0.02, 0.9
HOT = 1 << 17  # words whose ratios every worker holds, at most
SCALE = 1 << 24  # of a ratio as a whole number
FLUSH_WORDS = 1 << 20  # words a worker holds before it hands their counts on
FITTED_ROWS = 20_000  # labelled texts the curve is fitted on, at most: a bounded sample
FILTER_BITS = 1 << 23


def hashed(text: str | None) -> np.ndarray:
    words = WORDS.findall((text or "").lower())
    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words)).view(np.int64)


@dataclass
class Model:
    hot: np.ndarray  # hashes of the words that most texts hold, sorted
    ratio: np.ndarray  # their log-likelihood ratios, as whole numbers of 1 / SCALE
    rest: DataFrame | None  # (word, ratio) of all other words, if there are any
    curve: np.ndarray | None  # constant, weight of the text, weight of the strongest word

    def known(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ratio of each word, 0 for those that are not hot, and whether it is hot."""
        if not len(self.hot):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
        found = self.hot[at] == words
        return np.where(found, self.ratio[at], 0), found


def labelled_words(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Kept: fold, toxic, text of every labelled text outside the held-out fold."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).cast("int")
    filled = (known.select(bit.alias("b")).groupBy(F.expr("b div 64").cast("int").alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, b % 64)")).alias("bits")).toArrow())  # at most FILTER_BITS / 64 rows
    bitmap = np.zeros(FILTER_BITS // 64, np.uint64)
    bitmap[filled["at"].to_numpy()] = filled["bits"].to_numpy().view(np.uint64)

    def work(batch: pa.RecordBatch):
        i = batch.column("bit").to_numpy().astype(np.int64)
        some = batch.filter(pa.array((bitmap[i // 64] >> (i % 64).astype(np.uint64)) & np.uint64(1) == 1))
        yield {"doc_id": some.column("doc_id"), "fold": some.column("fold"), "text": some.column("text")}

    fold = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds).cast("int")
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", fold.alias("fold"), bit.alias("bit"))
    some = arrow_rows(texts.where(F.col("fold") != held_out), work, "doc_id long, fold int, text string")
    return keep(some.join(known, "doc_id").select("fold", (F.col("toxic") > 0).cast("int").alias("toxic"), "text"))


def counts(rows: DataFrame) -> DataFrame:
    """(word, ordinary, toxic, contexts): texts of each class that hold a word, and its distinct previous words."""
    schema = "word long, before long, ordinary long, toxic long"

    def count(batches):
        """Words, and pairs without counts, each once for every so many words."""
        once, pairs, held = ([], []), [], 0

        def out():
            (w, n0), (v, n1) = (np.unique(np.concatenate(o or [np.empty(0, np.int64)]), return_counts=True) for o in once)
            p = np.concatenate(pairs or [np.empty((0, 2), np.int64)])
            p = p[np.lexsort((p[:, 1], p[:, 0]))]
            p = p[np.r_[True, (p[1:] != p[:-1]).any(axis=1)]] if len(p) else p
            word, none = np.concatenate([w, v, p[:, 1]]), len(w) + len(v)
            zero = np.zeros(len(word), np.int64)
            ordinary, toxic = zero.copy(), zero
            ordinary[:len(w)], toxic[len(w):none] = n0, n1
            before = pa.array(np.r_[np.zeros(none, np.int64), p[:, 0]], mask=np.arange(len(word)) < none)
            for i in range(0, len(word), 1 << 16):
                part = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(word[part]), before[part], pa.array(ordinary[part]), pa.array(toxic[part])],
                                                 names=["word", "before", "ordinary", "toxic"])

        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = hashed(text)
                once[toxic].append(np.unique(words))
                pairs.append(np.c_[words[:-1], words[1:]])
                held += len(words)
                if held >= FLUSH_WORDS:
                    yield from out()
                    once, pairs, held = ([], []), [], 0
        yield from out()

    return (rows.select("toxic", "text").mapInArrow(count, schema)
            .groupBy("word", "before").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
            .groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"), F.count("before").alias("contexts")))


def _key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _evidence(texts: DataFrame, model: Model) -> DataFrame:
    """Mean log-likelihood ratio a word of each different text and of its strongest word: (key, whole, top)."""
    known = texts.sparkSession.sparkContext.broadcast(Model(model.hot, model.ratio, None, None))  # HOT numbers
    least = -(1 << 62)

    def work(batch: pa.RecordBatch):
        n, whole, top, words, times = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            w, c = np.unique(hashed(text), return_counts=True)
            ratio, found = known.value.known(w)
            n.append(int(c.sum()))
            whole.append(int((ratio * c).sum()))
            top.append(int(ratio[found].max()) if found.any() else least)
            words.append(w[~found])
            times.append(c[~found])
        yield {"key": batch.column(0), "n": n, "whole": whole, "top": top, "words": words, "times": times}

    part = arrow_rows(texts.select("key", "text"), work, "key long, n long, whole long, top long, words array<long>, times array<long>")
    if model.rest is None:
        part = part.select("key", "n", "whole", "top", F.size("words").alias("others")).distinct().withColumns({"more": F.lit(0), "best": F.lit(least), "met": F.lit(0)})
    else:
        part = keep(part.dropDuplicates(["key"]))
        met = (part.select("key", F.explode(F.arrays_zip("words", "times")).alias("x")).select("key", "x.words", "x.times")
               .join(model.rest, F.col("words") == F.col("word"))
               .groupBy("key").agg(F.sum(F.col("times") * F.col("ratio")).alias("more"), F.max("ratio").alias("best"), F.count(F.lit(1)).alias("met")))
        part = part.select("key", "n", "whole", "top", F.size("words").alias("others")).join(met, "key", "left").na.fill(0, ["more", "met"])
    top = F.greatest("top", "best", F.when(F.col("others") > F.col("met"), 0))  # a word nobody has labelled speaks for neither class
    empty = F.col("n") == 0
    return part.select("key", F.when(empty, 0.0).otherwise((F.col("whole") + F.col("more")) / SCALE / F.col("n")).alias("whole"),
                       F.when(empty, 0.0).otherwise(top / SCALE).alias("top"))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> Model:
    """Counts from all learning folds but the last, the curve from that last one."""
    rows = labelled_words(docs, labels, folds, held_out)
    last = max(f for f in range(folds) if f != held_out)
    counted = keep(counts(rows.where(F.col("fold") != last)))
    none = np.empty(0, np.int64)
    total = counted.agg(*[F.sum(c).alias(c) for c in ("ordinary", "toxic", "contexts")]).first()
    if not total["ordinary"] or not total["toxic"]:
        return Model(none, none, None, None)
    shared = F.col("contexts") * (SHARED / max(total["contexts"], 1)) + FLOOR / (total["ordinary"] + total["toxic"])
    toxic, ordinary = (F.log(F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / total[c] + shared) for c in ("toxic", "ordinary"))
    seen = F.col("ordinary") + F.col("toxic")
    table = counted.select("word", F.round((toxic - ordinary) * SCALE).cast("long").alias("ratio"), seen.alias("seen"))
    floor, hot, left = 1 << 62, 0, False  # words in at least `floor` texts are hot
    for r in table.groupBy("seen").count().orderBy(F.desc("seen")).toLocalIterator():  # one row for each count that occurs
        if hot + r["count"] > HOT:
            left = True
            break
        floor, hot = r["seen"], hot + r["count"]
    found = table.where(F.col("seen") >= floor).select("word", "ratio").orderBy("word").toArrow()  # at most HOT rows
    rest = keep(table.where(F.col("seen") < floor).select("word", "ratio")) if left else None
    model = Model(found["word"].to_numpy(), found["ratio"].to_numpy(), rest, None)

    fitted = rows.where(F.col("fold") == last).withColumn("key", _key("text"))
    sample = fitted.select("key", "toxic").orderBy("key", "toxic").limit(FITTED_ROWS).toArrow()
    if not sample.num_rows:
        return model
    keys = sample["key"].to_numpy()
    told = _evidence(fitted.where(F.col("key") <= int(keys.max())).select("key", "text"), model).toArrow().sort_by("key")  # one row for each key
    at = np.searchsorted(told["key"].to_numpy(), keys)
    x = np.c_[told["whole"].to_numpy()[at], told["top"].to_numpy()[at]]
    return Model(model.hot, model.ratio, rest, _curve(x, sample["toxic"].to_numpy().astype(float)))


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray | None:
    """Logistic regression with a slight ridge, by Newton steps."""
    if len(set(y)) < 2:
        return None
    a, w = np.c_[np.ones(len(x)), x], np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(3), a.T @ (y - p) - 1e-2 * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Adds the score of every whole text."""
    if model.curve is None:
        return docs.withColumn(name, F.lit(0.0))
    a, b, c = (float(x) for x in model.curve)
    if model.rest is not None:
        z = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.lit(a) + b * F.col("whole") + c * F.col("top")))
        scored = _evidence(docs.select(_key("text").alias("key"), "text"), model).select(F.col("key").alias("__key"), (1 / (1 + F.exp(-z))).alias(name))
        return docs.withColumn("__key", _key("text")).join(scored, "__key").select(*docs.columns, name)
    known = docs.sparkSession.sparkContext.broadcast(model)  # HOT numbers

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            words = hashed(text)
            ratio, _ = known.value.known(words)
            whole, top = (int(ratio.sum()) / SCALE / len(words), int(ratio.max()) / SCALE) if len(words) else (0.0, 0.0)
            out.append(float(1 / (1 + np.exp(-np.clip(a + b * whole + c * top, -500, 500)))))
        return pd.Series(out, dtype=float)

    return docs.withColumn(name, of("text"))
