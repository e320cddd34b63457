"""Chains and cycles of decisions, merges of many tables, and close spellings against brute force."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartulary.operators import fuzzy, merges


def chains(spark, pairs):
    return merges.resolve_chains(spark.createDataFrame(pairs, "retired_id long, survivor_id long"))


def test_chains_are_followed_and_cycles_reported(spark):
    c = chains(spark, [(1, 2), (2, 3), (3, 4), (4, 5), (10, 11), (11, 10), (12, 11), (20, 20), (30, 31), (30, 31), (40, 41), (40, 42), (50, 40), (None, 1), (60, None)])
    assert rows(c.survivors) == [(1, 5), (2, 5), (3, 5), (4, 5), (30, 31)]
    assert rows(c.cyclic) == [(10, 11), (11, 10), (12, 11), (20, 20)]
    assert rows(c.ambiguous) == [(40, 2)]


@pytest.mark.parametrize("n", [0, 1, 2, 300])
def test_long_chains(spark, n):
    ids = list(range(n + 1))
    random.Random(n).shuffle(ids)
    c = chains(spark, list(zip(ids, ids[1:], strict=False)))
    assert rows(c.survivors) == sorted((i, ids[-1]) for i in ids[:-1]) and c.cyclic.count() == 0


def tables(spark):
    frame = spark.createDataFrame
    canonical = frame([(1, "Ana"), (2, "Ann"), (3, "Eva"), (4, "Ev"), (5, "Luz")], "id long, name string")
    aliases = frame([(1, "Ana", "canonical"), (2, "Ann", "canonical"), (2, "A.", "short"), (1, "A.", "short"), (4, "E", "short"), (4, "E", "short"), (3, "x", "s"), (3, "x", "s")],
                    "id long, alias string, alias_type string")
    box = frame([(2, "Ann", 10), (5, "Luz", 1), (None, None, 2)], "id long, name string, pts int")
    bios = frame([(1, "b1"), (2, "b2"), (4, "b4"), (5, "b5")], "id long, text string")
    roster = frame([(1, 2000), (2, 2000), (2, 2001), (4, 2000)], "id long, season int")
    career = frame([(1, 2000, 5), (2, 2000, 5), (2, 2001, None), (4, 2001, 1), (4, 2001, 1), (5, 1, 1), (5, 1, 1)], "id long, season int, pts int")
    queue = frame([("q1", [2, 5, 1]), ("q2", [5]), ("q3", []), ("q4", None), ("q5", [4, 3])], "q string, ids array<long>")
    r = merges.Rule
    return {"canonical": (canonical, r("canonical", "id", name="name")), "aliases": (aliases, r("alias", "id", ["alias", "alias_type"])), "box": (box, r("move", "id", name="name")),
            "bios": (bios, r("one", "id")), "roster": (roster, r("one", "id", ["season"])), "career": (career, r("facts", "id", ["season", "pts"])), "queue": (queue, r("move", lists=["ids"]))}


def test_every_table_follows_one_map(spark):
    survivors = spark.createDataFrame([(2, 1), (4, 3), (9, 99)], "retired_id long, survivor_id long")
    before = tables(spark)
    m = merges.merge_tables(before, survivors)
    assert rows(m.tables["canonical"]) == [(1, "Ana"), (3, "Eva"), (5, "Luz")]
    assert rows(m.tables["aliases"]) == [(1, "A.", "short"), (1, "Ana", "canonical"), (1, "Ann", "merged_name"), (3, "E", "short"), (3, "x", "s"), (3, "x", "s")]
    assert rows(m.tables["box"]) == [(None, None, 2), (1, "Ana", 10), (5, "Luz", 1)]
    assert rows(m.tables["bios"]) == [(1, "b1"), (3, "b4"), (5, "b5")]
    assert rows(m.tables["roster"]) == [(1, 2000), (1, 2001), (3, 2000)]
    assert rows(m.tables["career"]) == [(1, 2000, 5), (1, 2001, None), (3, 2001, 1), (5, 1, 1), (5, 1, 1)]
    assert rows(m.tables["queue"]) == [("q1", [1, 5]), ("q2", [5]), ("q3", []), ("q4", None), ("q5", [3])]
    assert rows(m.clashes, "table", "survivor_id", "retired_id") == [("bios", 1, 2), ("canonical", 99, 9), ("roster", 1, 2)]
    assert rows(m.dropped) == [("aliases", 1, 2, 1), ("aliases", 3, 4, 1), ("career", 1, 2, 1), ("career", 3, 4, 1)]
    again = merges.merge_tables({n: (m.tables[n], before[n][1]) for n in before}, survivors)
    assert all(rows(again.tables[n]) == rows(m.tables[n]) for n in before)
    assert again.dropped.count() == 0 and rows(again.clashes, "table") == [("canonical",)] and again.moved.count() == 0


def test_without_decisions_nothing_changes(spark):
    before = tables(spark)
    m = merges.merge_tables(before, spark.createDataFrame([], "retired_id long, survivor_id long"))
    assert all(rows(m.tables[n]) == rows(before[n][0]) for n in before) and m.clashes.count() == m.dropped.count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_close_spellings_equal_brute_force(spark):
    rng = random.Random(3)
    names = [" ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(2)) for _ in range(150)]
    names += ["teo cruz", "teofilo cruz", "Teófilo  Cruz", "juan paz", "pachin pas", "solo", "sola", "", None, "a b c d"]
    found = fuzzy.fuzzy_pairs(spark.createDataFrame([(i, n, "x") for i, n in enumerate(names)], "id long, name string, given string"), "id", "name")
    nick = {frozenset(p) for p in fuzzy.NICKNAMES.items()}
    spelt = sorted({" ".join((w[0], w[-1])) for n in names if n and (w := n.lower().replace("ó", "o").split())})
    want = []
    for i, a in enumerate(spelt):
        for b in spelt[i + 1:]:
            (ga, sa), (gb, sb) = a.split(), b.split()
            if distance(sa, sb) <= 1 and (distance(ga, gb) <= 2 or frozenset((ga, gb)) in nick):
                want.append((a, b))
    assert rows(found.pairs) == want and rows(found.spellings, "spelling") == [(s,) for s in spelt]
    assert found.members.count() == len([n for n in names if n])


def test_deletions(evaluate):
    got = evaluate(lambda c: F.array_sort(fuzzy.deletions(c, 2)), ["abc", "a", ""])
    assert got == [["a", "ab", "abc", "ac", "b", "bc", "c"], ["", "a"], [""]]
