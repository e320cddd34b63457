"""Phrase collocations from FM-indexes over word ids, one index a shard.

A shard holds some documents of one language: its own vocabulary and their words as ids, pieces parted by id 0.
Over each shard stands a bidirectional index: its rows sorted by the words that follow (`ahead`) and by those
that went before (`behind`), each with the Burrows-Wheeler column and the last-to-first step. A phrase is one
interval in either half; putting a word after it narrows the interval in `behind` and moves the one in `ahead`,
putting one before it does the reverse, and the length of the interval is the count. Rows are sorted by as many
words as the longest phrase has, which is all that intervals of such phrases need.

Each shard grows its phrases word by word, each level only from phrases that are frequent in the whole language:
words, then longer ones. Counts are summed over the shards. What is frequent goes to the shards as a bitmap of
hashed keys of at most `FILTER_BITS` bits; a bit set by two keys only lets rows through that the sums then drop,
so counts are exact at every size. Words are keyed by a 64-bit hash that is checked to be different for all words of
a language; should two share one, the shards are counted again under another seed.

A shard is kept as two blobs that Python has compressed, in groups of rows of a few megabytes: the JVM never holds
more of them at once, however many shards one file or task has.

Defined results: NULL text is empty; NULL language is `und`; repeated rows count each; texts are read whole and no
shard ends inside one (a text longer than a shard makes a longer shard); an empty table gives no rows; other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import shuffled
from .common import LARGE_ROWS, give_back, keep

BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"  # fixed value: where pieces end
SHARD_WORDS = 1 << 21  # words a worker holds before it hands its shards on
FILTER_BITS = 1 << 25
BATCH_ROWS = 1 << 16

_FOLD = bytearray(range(256))
_FOLD[65:91] = bytes(range(97, 123))
for _mark in BREAKS:
    _FOLD[_mark] = BREAKS[0]
_FOLD = bytes(_FOLD)
_BREAK = BREAKS[:1]


def _packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(blob: bytes) -> pa.Buffer:
    return pa.decompress(memoryview(blob)[8:], int.from_bytes(blob[:8], "little"), codec="zstd")


def _shards_of(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """Language, vocabulary and ids of each shard; one at a time is unpacked."""
    for lang, words, ids in zip(batch.column("lang"), batch.column("words"), batch.column("ids"), strict=True):
        yield lang.as_py(), _unpacked(words.as_py()).to_pybytes().split(b"\n"), np.frombuffer(_unpacked(ids.as_py()), np.int32)


def shards(docs: DataFrame) -> DataFrame:
    """Kept: lang, words (the vocabulary, one a line; the first entry stands for the end of a piece), ids (int32, one a word, 0 at both ends), both packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[dict, list]] = {}
        size = 0

        def out():
            for lang in list(held):
                known, ids = held.pop(lang)
                text = np.concatenate([np.zeros(1, np.int32), *ids]).tobytes()
                del ids
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (lang, _packed(b"\n".join(known)), _packed(text))], names=["lang", "words", "ids"])
                del known, text
            pa.default_memory_pool().release_unused()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = text.encode("utf-8", "surrogatepass").translate(_FOLD).replace(_BREAK, b" " + _BREAK + b" ").split()
                words.append(_BREAK)
                if lang not in held:
                    known = defaultdict(count().__next__)
                    held[lang] = (known, [])
                    known[_BREAK]  # id 0
                known, ids = held[lang]
                ids.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= SHARD_WORDS:
                    yield from out()
                    size = 0
        yield from out()
        give_back()

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return keep(rows.mapInArrow(run, "lang string, words binary, ids binary"), LARGE_ROWS)


class Half:
    """Rows of a sequence sorted by their next `depth` ids; `before` is the id that precedes a row, `step` the row it starts at."""

    def __init__(self, ids: np.ndarray, depth: int):
        n, width = len(ids), max(int(ids.max()).bit_length(), 1)
        key, bits = ids.astype(np.int64), width
        for i in range(1, depth):
            if bits + width > 63:
                key, bits = np.unique(key, return_inverse=True)[1], n.bit_length()
            key = key << width | np.roll(ids, -i)
            bits += width
        order = np.argsort(key)
        del key
        self.before = ids[order - 1]
        del order
        self.step = np.empty(n, np.int32)  # as everywhere below: a shard has far fewer than 2^31 words
        self.step[np.argsort(self.before, kind="stable")] = np.arange(n, dtype=np.int32)


class Phrases:
    """Intervals of all phrases of one length: the words (one column each), where they start in either half, and their counts."""

    def __init__(self, words: np.ndarray, ahead: np.ndarray, behind: np.ndarray, n: np.ndarray):
        self.words, self.ahead, self.behind, self.n = words, ahead, behind, n

    def where(self, some: np.ndarray) -> Phrases:
        return Phrases(self.words[some], self.ahead[some], self.behind[some], self.n[some])


class Index:
    """Bidirectional FM-index of one shard, for phrases of at most `depth` words."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.ahead, self.behind = Half(ids, depth), Half(ids[::-1], depth)
        times = np.bincount(ids).astype(np.int32)
        first = np.cumsum(times, dtype=np.int32) - times
        self.size = len(ids)
        self.words = Phrases(np.arange(1, len(times), dtype=np.int32)[:, None], first[1:], first[1:], times[1:])

    def after(self, phrases: Phrases) -> Phrases:
        """Every phrase with every word that follows it somewhere."""
        words, behind, ahead, n = self._grown(self.behind, phrases.behind, phrases.ahead, phrases.n)
        return Phrases(np.c_[phrases.words[words[0]], words[1]], ahead, behind, n)

    def ahead_of(self, phrases: Phrases) -> Phrases:
        """Every phrase with every word that goes before it somewhere."""
        words, ahead, behind, n = self._grown(self.ahead, phrases.ahead, phrases.behind, phrases.n)
        return Phrases(np.c_[words[1], phrases.words[words[0]]], ahead, behind, n)

    def _grown(self, half: Half, start: np.ndarray, other: np.ndarray, n: np.ndarray):
        """((parent, word), start in this half, start in the other, count) of every extension by one word.

        All rows of a phrase take their step at once. Where they land, rows of one word and one phrase lie side by
        side: that run is the new interval. In the other half the extensions of a phrase divide its interval in the
        order of the words, the end of a piece first.
        """
        parent = np.repeat(np.arange(len(n), dtype=np.int32), n)
        rows = np.arange(len(parent), dtype=np.int32) + np.repeat(start - (np.cumsum(n, dtype=np.int32) - n), n)
        owner = np.full(self.size + 1, -1, np.int32)
        word = np.zeros(self.size + 1, half.before.dtype)
        at = half.step[rows]
        owner[at], word[at] = parent, half.before[rows]
        del parent, rows, at
        border = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (word[1:] != word[:-1])]).astype(np.int32)
        length = np.diff(np.r_[border, np.int32(self.size + 1)])
        real = owner[border] >= 0
        begin, length, owner, word = border[real], length[real], owner[border[real]], word[border[real]]
        del border, real
        by_parent = np.lexsort((word, owner))
        total = np.cumsum(length[by_parent], dtype=np.int32) - length[by_parent]
        new = np.r_[True, np.diff(owner[by_parent]) != 0][:len(by_parent)]
        inside = np.empty(len(by_parent), np.int32)
        inside[by_parent] = total - np.repeat(total[new], np.diff(np.r_[np.flatnonzero(new), len(by_parent)]))
        some = word > 0
        return (owner[some], word[some]), begin[some], other[owner[some]] + inside[some], length[some]


def _bits(keys: np.ndarray, size: int) -> np.ndarray:
    """Bit of each row of word hashes, whatever the number of words."""
    mixed = np.zeros(len(keys), np.uint64)
    for column in keys.T:
        mixed = (mixed * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64)) ^ (mixed >> np.uint64(29))
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(32)) & np.uint64(size - 1)).astype(np.int64)


def _bitmap(frequent: DataFrame, length: int, rows: int) -> np.ndarray:
    """Bits of all frequent phrases of one length, ORed together in Spark: at most FILTER_BITS, whatever the table's size."""
    size = min(max(1 << 16, 1 << (32 * rows).bit_length()), FILTER_BITS)

    def run(batches):
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(length)], axis=1).view(np.uint64)
            bit = np.unique(_bits(keys, size))
            at, first = np.unique(bit >> 6, return_index=True)
            word = np.bitwise_or.reduceat(np.uint64(1) << (bit & 63).astype(np.uint64), first) if len(bit) else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(word.view(np.int64))], names=["at", "bits"])

    found = (frequent.select(*[f"h{i}" for i in range(length)]).mapInArrow(run, "at long, bits long")
             .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())
    bitmap = np.zeros(size >> 6, np.uint64)
    bitmap[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bitmap


def _known(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = _bits(keys, len(bitmap) << 6)
    return (bitmap[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1


def _hashes(lang: str, words: list[bytes], seed: int) -> np.ndarray:
    """Hash of each word in its language, so that one bitmap serves all languages."""
    start = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), seed)
    return np.fromiter((xxhash.xxh64_intdigest(w, start) for w in words), np.uint64, len(words))


def _words(held: DataFrame, seed: int) -> DataFrame:
    """Kept: lang, h0, word, n of every word of every language."""

    def run(batches):
        for batch in batches:
            for lang, words, ids in _shards_of(batch):
                h, n = _hashes(lang, words, seed).view(np.int64), np.bincount(ids, minlength=len(words))
                for i in range(1, len(words), BATCH_ROWS):
                    part = slice(i, i + BATCH_ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(words[part])), pa.array(h[part]), pa.array(words[part], pa.binary()), pa.array(n[part])],
                        names=["lang", "h0", "word", "n"])

    return keep(held.mapInArrow(run, "lang string, h0 long, word binary, n long").groupBy("lang", "h0", "word").agg(F.sum("n").alias("n")))


def _grown(held: DataFrame, length: int, depth: int, bitmaps: list[np.ndarray], seed: int) -> DataFrame:
    """(lang, h0.., n) summed over the shards, of phrases of `length` words whose shorter parts may all be frequent."""
    known = held.sparkSession.sparkContext.broadcast(bitmaps)  # FILTER_BITS each
    names = [f"h{i}" for i in range(length)]

    def run(batches):
        words = known.value[0]
        for batch in batches:
            for lang, vocabulary, ids in _shards_of(batch):
                h = _hashes(lang, vocabulary, seed)
                frequent = _known(words, h[:, None])
                frequent[0] = False
                new = np.where(frequent, np.cumsum(frequent), 0)  # other words end a piece: no frequent phrase holds one
                text = new.astype(np.int32)[ids]
                text = text[np.r_[True, (text[1:] != 0) | (text[:-1] != 0)]]
                h = np.r_[np.zeros(1, np.uint64), h[frequent]]
                if len(h) == 1:
                    continue
                index = Index(text, depth)
                phrases = index.after(index.words)
                for size in range(3, length + 1):  # by turns to the left and to the right
                    phrases = phrases.where(_known(known.value[size - 2], h[phrases.words]))
                    phrases = index.ahead_of(phrases) if size % 2 else index.after(phrases)
                    fresh = phrases.words[:, :size - 1] if size % 2 else phrases.words[:, 1:]
                    phrases = phrases.where(_known(known.value[size - 2], h[fresh]))
                keys = h[phrases.words].view(np.int64)
                for i in range(0, len(keys), BATCH_ROWS):
                    part = slice(i, i + BATCH_ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(keys[part])), *[pa.array(np.ascontiguousarray(k)) for k in keys[part].T], pa.array(phrases.n[part].astype(np.int64))],
                        names=["lang", *names, "n"])
                del index, phrases, keys
            pa.default_memory_pool().release_unused()
        give_back()

    rows = held.mapInArrow(run, f"lang string, {', '.join(f'{h} long' for h in names)}, n long")
    return rows.repartition("lang", *names).groupBy("lang", *names).agg(F.sum("n").alias("n"))  # a shard names a phrase once


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(words of all languages; lang and n, all its words; for each length the phrases found at least `least` times).

    Phrases have columns lang, h0.. (hashes of their words) and n; those of one word also have word.
    """
    held, seed = shards(docs), 0
    while True:
        words = _words(held, seed)
        if words.groupBy("lang", "h0").count().where("count > 1").isEmpty():
            break
        seed += 1
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = [keep(words.where(F.col("n") >= least))]
    bitmaps: list[np.ndarray] = []
    for length in range(2, longest + 1):
        bitmaps.append(_bitmap(frequent[-1], length - 1, frequent[-1].count()))
        frequent.append(keep(_grown(held, length, longest, bitmaps, seed).where(F.col("n") >= least)))
    return words, totals, frequent


def _share(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in whole numbers of up to 38 digits."""
    wide = [c.cast("decimal(38,0)") for c in (a, left, right)]
    return F.call_function("div", (wide[0] * wide[0]).cast("decimal(32,0)") * F.lit(1000000).cast("decimal(7,0)"), wide[1] * wide[2])


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, covered_percent: int = 50) -> DataFrame:
    """(lang, words, phrase, a, l, r, n, score) of every phrase of 2 to `longest` words that no longer one covers.

    The score is that of the weakest cut in two (ties: the first cut); a phrase is covered when its words lie inside
    a longer frequent phrase that has at least `covered_percent` of its count. Frequent phrases grow with the rows, and
    their hashes need far more memory than their files: they are joined by a shuffle, never broadcast.
    """
    _, totals, frequent = phrase_counts(docs, longest, least)
    names = [f"h{i}" for i in range(longest)]

    def part(phrase: DataFrame, at: int, size: int, name: str) -> DataFrame:
        """Count of the words [at, at + size) of each phrase; they are as frequent as the phrase, so they are in the tables."""
        keys = frequent[size - 1].select(F.col("lang").alias("__lang"), *[F.col(f"h{i}").alias(f"__{at + i}") for i in range(size)], F.col("n").alias(name))
        same = [F.col("lang") == F.col("__lang"), *[F.col(f"h{at + i}") == F.col(f"__{at + i}") for i in range(size)]]
        return phrase.join(shuffled(keys), reduce(Column.__and__, same)).drop("__lang", *[f"__{at + i}" for i in range(size)])

    scored = []
    for size in range(2, longest + 1):
        rows = frequent[size - 1].withColumnRenamed("n", "a")
        cuts = []
        for k in range(1, size):
            rows = part(part(rows, 0, k, f"__l{k}"), k, size - k, f"__r{k}")
            cuts.append(F.struct(_share(F.col("a"), F.col(f"__l{k}"), F.col(f"__r{k}")).alias("score"), F.lit(k).alias("k"),
                                 F.col(f"__l{k}").alias("l"), F.col(f"__r{k}").alias("r")))
        weakest = (F.least(*cuts) if len(cuts) > 1 else cuts[0]).alias("weakest")
        rows = rows.select("lang", *names[:size], "a", weakest).select("lang", *names[:size], "a", "weakest.l", "weakest.r", "weakest.score")
        longer = [frequent[bigger - 1].select("lang", *[F.col(f"h{at + i}").alias(f"h{i}") for i in range(size)], F.col("n").alias("__n"))
                  for bigger in range(size + 1, longest + 1) for at in range(bigger - size + 1)]
        if longer:
            most = reduce(DataFrame.unionAll, longer).groupBy("lang", *names[:size]).agg(F.max("__n").alias("__n"))
            rows = (rows.join(shuffled(most), ["lang", *names[:size]], "left")
                    .where(F.coalesce(100 * F.col("__n") < covered_percent * F.col("a"), F.lit(True))).drop("__n"))
        for i in range(size):
            word = frequent[0].select("lang", F.col("h0").alias(f"h{i}"), F.decode("word", "UTF-8").alias(f"w{i}"))
            rows = rows.join(shuffled(word), ["lang", f"h{i}"])
        scored.append(rows.select("lang", F.array(*[f"w{i}" for i in range(size)]).alias("words"), "a", "l", "r", "score"))
    return (reduce(DataFrame.unionAll, scored).join(totals, "lang")
            .select("lang", "words", F.array_join("words", " ").alias("phrase"), "a", "l", "r", "n", "score"))


def top(found: DataFrame, most: int = 2000) -> DataFrame:
    """The first `most` phrases of each language by score, count and phrase: a report, limited on the map side."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
