"""The index against plain counting, and the phrases of small tables against a plain version of the contract."""

import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from cartulary.llm import common, phrases


def grams(ids, size):
    found = Counter(tuple(ids[i:i + size]) for i in range(len(ids) - size + 1))
    return {g: n for g, n in found.items() if 0 not in g}


@pytest.mark.parametrize("depth", [2, 3, 4])
@pytest.mark.parametrize("words", [1, 3, 50, 5000])
def test_intervals(depth, words):
    ids = np.random.default_rng(words).integers(0, words + 1, 2000).astype(np.int32)
    ids[[0, -1]] = 0
    index = phrases.Index(ids, depth)
    for turns in range(2 ** (depth - 1)):
        found = index.words
        for i in range(depth - 1):
            found = index.after(found) if turns >> i & 1 else index.ahead_of(found)
            assert {tuple(w): n for w, n in zip(found.words.tolist(), found.n.tolist(), strict=True)} == grams(ids.tolist(), i + 2)


def plain(rows, longest, least, covered):
    counts, totals = {}, Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang or "und", Counter())[tuple(words[i:i + k])] += 1
    out = set()
    for lang, f in counts.items():
        some = {g: n for g, n in f.items() if len(g) > 1 and n >= least}
        for g, a in some.items():
            if any(len(h) > len(g) and 100 * n >= covered * a and any(h[i:i + len(g)] == g for i in range(len(h))) for h, n in some.items()):
                continue
            score, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            out.add((lang, " ".join(g), a, f[g[:k]], f[g[k:]], totals[lang], score))
    return out


ROWS = [("en", "New York is New york; new YORK! York new\tnew york"), (None, "a b c a b c a b c"), (None, None), ("fr", ""), ("fr", "..."),
        ("en", "a b c d e a b c d x a b c d. a b"), ("en", "a b c d e a b c d x a b c d. a b"), ("fr", "été là été là été là était"), ("en", "the of " * 4000), ("en", "x" * 50000)]


@pytest.mark.parametrize("longest, least, held", [(3, 2, 1 << 21), (4, 2, 5), (2, 3, 1 << 21), (3, 1, 20)])
def test_small_tables(spark, monkeypatch, longest, least, held):
    common.ship(spark)
    monkeypatch.setattr(phrases, "SHARD_WORDS", held)
    docs = spark.createDataFrame([(*r, 1, "q") for r in ROWS], "lang string, text string, n long, phrase string").repartition(3)
    got = phrases.collocations(docs, longest, least)
    assert {(r["lang"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got.collect()} == plain(ROWS, longest, least, 50)
    assert phrases.collocations(docs.limit(0), longest, least).count() == 0


def test_a_narrow_filter_changes_nothing(spark, monkeypatch):
    common.ship(spark)
    rng = np.random.default_rng(2)
    rows = [("en", " ".join(f"w{i}" for i in rng.zipf(1.3, 300) % 400)) for _ in range(60)]
    monkeypatch.setattr(phrases, "FILTER_BITS", 1 << 7)
    got = phrases.collocations(spark.createDataFrame(rows, "lang string, text string"), 3, 5)
    assert {(r["lang"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got.collect()} == plain(rows, 3, 5, 50)


def test_shards_are_read_in_short_groups_of_rows(spark, monkeypatch):
    """Forty shards of 0.6 MB from one task: no reader is given all of them at once."""
    common.ship(spark)
    monkeypatch.setattr(phrases, "SHARD_WORDS", 1 << 17)
    docs = spark.range(0, 2560, 1, 1).selectExpr("'en' AS lang", "array_join(transform(sequence(1, 2048), i -> hex(xxhash64(id, i) & 1048575)), ' ') AS text")
    held = phrases.shards(docs)
    files = [pq.ParquetFile(f.removeprefix("file://")) for f in held.inputFiles()]
    groups = [f.metadata.row_group(i) for f in files for i in range(f.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 40 and max(g.total_byte_size for g in groups) <= 10 << 20
    words = phrases._words(held, 0)
    assert words.selectExpr("sum(n)").first()[0] == 2560 * 2048


def test_frequent_phrases_are_never_broadcast(spark):
    common.ship(spark)
    found = phrases.collocations(spark.createDataFrame(ROWS, "lang string, text string"), 3, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 10 and plan.count("BroadcastHashJoin") <= 1  # the totals: one row for each language
