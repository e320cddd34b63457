"""Entity resolution on made-up people: nobody is matched by name alone."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from cartulary.functions import text
from cartulary.operators import joins, resolve

PEOPLE = [(1, "Paz Luna, Juan Jose", "Paz Luna", "Juan Jose", None), (2, "Paz, Juan", "Paz", "Juan", "Pipo"),
          (3, "Sosa, Ana", "Sosa", "Ana", None), (4, "Sosa, Ana", "Sosa", "Ana", None), (5, "Vega Rey, Luis", "Vega Rey", "Luis", None),
          (6, "Rivas, Victor Manuel", "Rivas", "Victor Manuel", None), (7, "Cruz, Elias", "Cruz", "Elias", None), (8, "Mora, Eva", "Mora", "Eva", None)]


@pytest.fixture(scope="module")
def canon(spark):
    return spark.createDataFrame(PEOPLE, "id long, name string, family string, given string, nickname string")


@pytest.fixture(scope="module")
def aliases(canon):
    return resolve.alias_table(canon, "id", "name", "family", "given", "nickname", "given")


def test_alias_kinds(aliases):
    got = rows(aliases.where("id = 2"), "alias_type", "normalized_alias")
    assert got == sorted([("canonical", "paz, juan"), ("given_family_order", "juan paz"), ("initial", "paz, j"), ("nickname", "pipo"),
                          ("nickname_surname", "paz, pipo"), ("normalized", "paz, juan"), ("paternal_surname", "paz, juan"), ("raw", "paz, juan")])
    assert ("given_first_only", "paz, juan") in rows(aliases.where("id = 1"), "alias_type", "normalized_alias")
    assert aliases.count() == aliases.dropDuplicates(["id", "normalized_alias", "alias_type"]).count()


OBS = [
    (1, "Paz Luna, Juan Jose", 1995, "rio", ("name+season_in_career", 1)),
    (2, "Sosa, Ana", 1990, "rio", ("name+season_in_career", 3)),             # only 3 was active then
    (3, "Sosa, Ana", 2001, "mar", ("name+season+club", 4)),                  # both active, the club picks one
    (4, "Sosa, Ana", 2001, "sol", ("several candidates in the season span", None)),
    (5, "Sosa, Ana", 1950, "rio", ("several candidates, none in the season span", None)),
    (6, "Vega Rey, Luis", 1950, "rio", ("unique name, season outside the known span", None)),
    (7, "Vega Rey, Luis", 1960, "rio", ("name+season+title", 5)),
    (8, "Rivas, Victor Man", 1999, "rio", ("name+season+trunc", 6)),
    (9, "Cruz, Elias 'Lar", 1980, "rio", ("name+season+trunc", 7)),
    (10, "Mora", 1970, "sol", ("surname+season+club", 8)),
    (11, "Mora", 1970, "rio", ("no canonical name match", None)),
    (12, "Nadie, Nunca", 1970, "rio", ("no canonical name match", None)),
    (13, "Eva Mora", 1971, "mar", ("name+season_in_career", 8)),
    (14, "EL PIPO FALSO", 1995, "rio", ("name+season_in_career", 2)),        # curated override, still needs the season
]
CAREER = [(1, 1994, "rio"), (1, 1996, "mar"), (2, 1995, "rio"), (3, 1989, "rio"), (3, 2001, "rio"), (4, 2000, "mar"), (4, 2002, "mar"),
          (5, 1970, "rio"), (6, 1999, "mar"), (7, 1981, "sol"), (8, 1970, "sol")]


@pytest.fixture(scope="module")
def resolved(spark, canon, aliases):
    def run(order):
        obs = spark.createDataFrame([o[:4] for o in order], "oid int, raw string, season int, club string")
        career = spark.createDataFrame(CAREER, "id long, season int, club string")
        spans = career.groupBy("id").agg(F.min("season").alias("lo"), F.max("season").alias("hi"))
        titles = spark.createDataFrame([("Vega Rey, Luis", 1960)], "n string, season int").select(text.token_sort_key("n").alias("name_key"), "season")
        over = spark.createDataFrame([(2, "el pipo falso")], "id long, alias_key string")
        index = resolve.candidate_index(canon, aliases, "id", "family", "given", "name", over)
        return resolve.resolve_observations(resolve.observation_keys(obs, "raw"), index, spans, career, titles, "oid", "id", "season", "club")
    return run


def test_every_tier(resolved):
    r = resolved(OBS)
    got = {x.oid: (x.outcome, x.id) for x in r.decided.collect()}
    assert got == {o[0]: o[4] for o in OBS}
    assert r.mapped.count() + r.review.count() == len(OBS)
    assert {x.oid: x.club_check for x in r.mapped.collect()}[13] == "contradicts"


def test_order_of_observations_does_not_matter(resolved):
    other = OBS[:]
    random.Random(2).shuffle(other)
    assert rows(resolved(OBS).decided, "oid", "outcome", "id") == rows(resolved(other).decided, "oid", "outcome", "id")


def person(i, name, fam, giv, born, year=None):
    return (i, " ".join(sorted(name.lower().replace(",", "").split())), fam.lower().split(), giv.lower(), born, born.year if born else year)


PERSON = "{} long, name_key string, family array<string>, given string, birth_date date, birth_year int"


def test_enrich_mint_review(spark):
    d = dt.date
    canon = [person(1, "Paz Luna, Juan", "Paz Luna", "Juan", d(1970, 5, 1)), person(2, "Sosa, Ana", "Sosa", "Ana", d(1960, 1, 1)),
             person(3, "Rey, Luis", "Rey", "Luis", None, 1980), person(4, "Vega, Eva", "Vega", "Eva", None)]
    second = [person(10, "Paz Luna, Juan", "Paz Luna", "Juan", d(1970, 9, 9)),   # exact name and year
              person(11, "Paz, Juan", "Paz", "Juan", d(1970, 5, 6)),             # surname prefix, 5 days apart
              person(12, "Paz, Juan", "Paz", "Juan", d(1970, 5, 20)),            # too far apart, same year: review
              person(13, "Sosa, Ana", "Sosa", "Ana", d(1990, 1, 1)),             # other year: a new person
              person(14, "Rey Mar, Luis", "Rey Mar", "Luis", d(1980, 3, 3)),     # canonical has no date, years agree
              person(15, "Vega Sol, Eva", "Vega Sol", "Eva", None),              # no date, name shape collides: review
              person(16, "Nueva, Zoe", "Nueva", "Zoe", None),                    # nothing like it: mint
              person(17, "Sosa, Ana", "Sosa", "Ana", None),                      # exact name, year unknown
              person(18, "Cruz, Luz", "Cruz", "Luz", d(1977, 7, 7))]             # bridged by hand
    bridge = spark.createDataFrame([("cruz luz", d(1977, 7, 7), "4")], "name_key string, birth_date date, target string")
    r = resolve.enrich_mint_review(spark.createDataFrame(second, PERSON.format("sid")), spark.createDataFrame(canon, PERSON.format("id")),
                                   "sid", "id", 990000, bridge)
    assert {x.sid: (x.tier, x.id) for x in r.decided.collect()} == {
        10: ("exact", 1), 11: ("family_shape", 1), 12: ("review", None), 13: ("mint", 990001), 14: ("family_shape", 3),
        15: ("review", None), 16: ("mint", 990002), 17: ("exact", 2), 18: ("bridge", 4)}
    # ids follow (name key, birth date), not input order
    assert rows(r.minted, "id", "name_key") == [(990001, "ana sosa"), (990002, "nueva zoe")]


def test_match_tiers(spark):
    canon = spark.createDataFrame([(1, ["paz"], "juan", 1980), (2, ["sosa"], "ana", 1981), (3, ["sosa"], "ana", 1981), (4, ["rey"], "luis", None),
                                   (5, ["sol"], "eva", None), (6, ["sol"], "eva", 1970)], "id long, family array<string>, given string, birth_year int")
    obs = spark.createDataFrame([(1, ["paz", "luna"], "juan", 1980, None), (2, ["paz"], "juan", None, 1981), (3, ["paz"], "juan", 1990, None),
                                 (4, ["sosa"], "ana", 1981, None), (5, ["rey"], "luis", 1999, None), (6, ["paz"], "juan", None, None),
                                 (7, ["sosa"], "ana", None, None), (8, ["nadie"], "x", 1980, None), (9, ["sol"], "eva", 1990, None)],
                                "oid int, family array<string>, given string, exact_birth int, approx_birth int")
    got = {x.oid: (x.tier[0], x.candidate_id) for x in resolve.match_tiers(obs, canon, "oid", "id").collect()}
    assert got == {1: ("1", 1), 2: ("2", 1), 3: ("5", None), 4: ("4", None), 5: ("3", 4), 6: ("3", 1), 7: ("4", None), 8: ("5", None), 9: ("4", None)}


def test_promote_traces_and_redirects(spark):
    m = spark.createDataFrame([("a", 2001, [7, 3], "confirmed_match"), ("b", 2001, [9], "confirmed_match"), ("c", 2001, [1], "no"), ("d", 2001, [4], "confirmed_match")],
                              "name string, season int, candidate_ids array<bigint>, disposition string")
    raw = spark.createDataFrame([("a", 2001, None), ("b", 2001, 5)], "name string, season int, jersey int")
    dead = spark.createDataFrame([(9, 3)], "retired_id long, survivor_id long")
    p = resolve.promote_confirmed(m, raw, ["name", "season"], "id", ["id", "season"], dead)
    assert rows(p.rows, "name", "id", "jersey") == [("a", 3, None), ("b", 3, 5)]
    assert rows(p.untraced, "name") == [("d",)] and rows(p.duplicates, "id", "n_rows") == [(3, 2)]


DECISION = "decision_id string, kind string, ids array<bigint>, survivor_id long, evidence string"


def test_merge_files_are_validated(spark):
    good = spark.createDataFrame([("D1", "merge", [1, 2], 1, "e"), ("D2", "not_same", [3, 4], None, "e")], DECISION)
    tomb = spark.createDataFrame([(2, 1, "D1")], "retired_id long, survivor_id long, decision_id string")
    assert resolve.invalid_merges(good, tomb).count() == 0
    bad = spark.createDataFrame([("D1", "merge", [1, 2], 1, ""), ("D2", "merge", [2, 3], 2, "e"), ("D3", "not_same", [2, 3], None, "e"), ("D4", "merge", [5], 5, "e"),
                                 ("D5", "merge", [6, 7], 8, "e")], DECISION)
    tomb = spark.createDataFrame([(2, 1, "D1"), (3, 2, "D2"), (3, 1, "D1")], "retired_id long, survivor_id long, decision_id string")
    got = {(r.decision_id, r.problem) for r in resolve.invalid_merges(bad, tomb).collect()}
    assert {("D1", "no evidence"), ("D2", "survivor is itself retired"), ("D4", "needs two distinct ids"), ("D5", "survivor not among ids"),
            ("D1", "no merge decision behind it")} <= got
    assert any(p == "retired twice" for _, p in got)


def test_merges_drop_only_identical_moved_rows(spark):
    df = spark.createDataFrame([(1, 2000, "a"), (1, 2000, "a"), (2, 2000, "a"), (2, 2001, "b"), (3, 2001, "b"), (4, 2005, "z")], "id long, season int, team string")
    dead = spark.createDataFrame([(2, 1), (3, 1)], "retired_id long, survivor_id long")
    m = resolve.apply_merges(df, dead, "id", ["season", "team"], [F.col("team")])
    assert rows(m.rows) == [(1, 2000, "a"), (1, 2000, "a"), (1, 2001, "b"), (4, 2005, "z")]
    assert rows(m.dropped, "id", "season", "retired_id") == [(1, 2000, 2), (1, 2001, 3)]
    assert resolve.apply_merges(m.rows, dead, "id", ["season", "team"], [F.col("team")]).dropped.count() == 0


def test_merge_then_fold(spark):
    df = spark.createDataFrame([(1, 2005, "Rayos, Rio", 9, 90, "main"), (2, 2005, "RIO", 9, 90, "extra"), (2, 2005, "Osos, Rio", 9, 90, "extra")],
                               "id long, season int, team string, games int, points int, source string")
    dead = spark.createDataFrame([(2, 1)], "retired_id long, survivor_id long")
    nick = F.when(F.col("team").contains(","), F.substring_index("team", ",", 1)).otherwise("")
    merged, folded = resolve.merge_then_fold(df, dead, "id", "season", "team", ["games", "points"], "source", "extra", nick)
    # both second-source rows sit in the survivor's city with equal figures: the second is identical, the first is folded
    assert merged.rows.count() + merged.dropped.count() == 3
    assert folded.kept.count() + folded.merged.count() == merged.rows.count()


def test_id_lists_follow_the_survivor(spark):
    df = spark.createDataFrame([(1, [2, 5, 1]), (2, []), (3, [7])], "k int, ids array<bigint>")
    dead = spark.createDataFrame([(2, 1)], "retired_id long, survivor_id long")
    assert rows(resolve.remap_id_lists(df, dead, "k", "ids")) == [(1, [1, 5]), (2, []), (3, [7])]


def test_fill_empty_never_overwrites(spark):
    spine = spark.createDataFrame([(1, None, "x"), (2, "a", None)], "k int, city string, pos string")
    src = spark.createDataFrame([(1, "rio", "y"), (2, None, "z"), (9, "q", "q")], "k int, city string, pos string")
    f = resolve.fill_empty(spine, src, "k", ["city", "pos"])
    assert rows(f.rows) == [(1, "rio", "x"), (2, "a", "z")]
    assert rows(f.conflicts) == [(1, "pos", "x", "y")] and rows(f.unmatched, "k") == [(9,)]
    assert rows(f.filled) == [(1, "city", "rio"), (2, "pos", "z")]


def test_spans_widen_for_unique_names_only(spark):
    canon = spark.createDataFrame([(1, 1950, 1955), (2, None, None), (3, 1960, 1961)], "id long, lo int, hi int")
    index = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("c", 2)], "k string, id long")
    seen = spark.createDataFrame([("a", 1957), ("a", 1949), ("b", 1948), ("c", 1990)], "k string, season int")
    out = resolve.seed_spans(canon, seen, index, "id", "k", "season", "lo", "hi")
    assert rows(out, "id", "lo", "hi", "seeded") == [(1, 1949, 1957, True), (2, 1948, 1948, True), (3, 1960, 1961, False)]


def test_canonical_entities(spark):
    d = spark.createDataFrame([(1, 1, "old", "1970"), (1, 2, "new", "1971"), (2, 1, "x", "")], "id int, ts int, name string, dob string")
    p = spark.createDataFrame([(1, 5, "profile")], "id int, ts int, name string")
    out = resolve.canonical_entities(d, p, "id", "ts", ["name"], ["dob"])
    assert rows(out, "id", "name", "dob", "has_profile") == [(1, "profile", "1970", True), (2, "x", None, False)]


def test_override_ranges(spark):
    r = spark.createDataFrame([("rio", "1950", "1959", "a", "e"), ("rio", "1960", None, "b", "e"), ("mar", "1950", "1960", "a", "e"), ("mar", "1955", None, "b", "e"),
                               ("sol", "1960", "1950", "a", "e"), ("luz", "19x", None, "a", "e"), ("paz", "1950", None, "a", " ")],
                              "city string, s string, e string, f string, evidence string")
    bad = {(x.city, x.reason) for x in joins.invalid_ranges(r, "city", "s", "e", "f", "evidence").collect()}
    assert bad == {("mar", "overlaps next"), ("sol", "reversed"), ("luz", "not a year"), ("paz", "no evidence")}
    ok = r.where("city = 'rio'").select("city", F.col("s").cast("int").alias("s"), F.col("e").cast("int").alias("e"), "f")
    q = spark.createDataFrame([("rio", 1949), ("rio", 1959), ("rio", 2024), ("mar", 1950)], "city string, season int")
    assert rows(joins.dated_override(q, ok, "city", "season", "s", "e", "f", "fid")) == [("mar", 1950, None), ("rio", 1949, None), ("rio", 1959, "a"), ("rio", 2024, "b")]


def test_name_splits(spark):
    out = spark.createDataFrame([("ana maria paz luna",)], "n string").select(F.explode(joins.name_splits(text.name_tokens("n"))).alias("s")).select("s.*")
    assert rows(out) == [("ana", ["luna"]), ("ana", ["maria", "paz", "luna"]), ("ana", ["paz", "luna"])]


def test_a_name_half_the_archive_shares(spark):
    """6,000 observations x 3,000 people of one name: the answer is exact and no pair is formed."""
    rng = random.Random(11)
    lo = [rng.randrange(0, 3000) for _ in range(3000)]
    people = spark.createDataFrame([(i, "Sosa, Ana", "Sosa", "Ana", None) for i in range(3000)] + [(9000, "Paz, Eva", "Paz", "Eva", None)],
                                   "id long, name string, family string, given string, nickname string")
    career = spark.createDataFrame([(i, s, "rio") for i, s in enumerate(lo)] + [(9000, 5, "mar")], "id long, season int, club string")
    spans = career.groupBy("id").agg(F.min("season").alias("lo"), F.max("season").alias("hi"))
    seasons = [rng.randrange(0, 3200) for _ in range(6000)]
    obs = spark.createDataFrame([(i, "Sosa, Ana", s, "sol") for i, s in enumerate(seasons)], "oid long, raw string, season int, club string")
    index = resolve.candidate_index(people, resolve.alias_table(people, "id", "name", "family", "given", "nickname", "given"), "id", "family", "given", "name")
    titles = spark.createDataFrame([], "name_key string, season int")
    out = resolve.resolve_observations(resolve.observation_keys(obs, "raw"), index, spans, career, titles, "oid", "id", "season", "club").decided
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    near = {s: [i for i in range(3000) if abs(lo[i] - s) <= 1] for s in set(seasons)}
    for r in out.collect():
        fit = near[r.season]
        assert r.n_candidates == 3000
        assert r.id == (fit[0] if len(fit) == 1 else None)


def test_fold_of_a_hot_player_season(spark):
    """Thousands of second-source rows of one player, season and city still fold row by row."""
    first = [(1, 2005, "Rayos, Rio", i, i, "main") for i in range(2000)]
    second = [(1, 2005, "RIO", i, i + (i % 2), "extra") for i in range(2000)]
    df = spark.createDataFrame(first + second, "pid long, season int, team string, games int, points int, source string")
    nick = F.when(F.col("team").contains(","), F.substring_index("team", ",", 1)).otherwise("")
    f = resolve.fold_cross_source(df, "pid", "season", "team", ["games", "points"], "source", "extra", nick)
    assert (f.kept.count(), f.merged.count(), f.conflicts.count()) == (3000, 1000, 1000)


def test_open_ranges_have_no_last_year(spark):
    q = spark.createDataFrame([("mar", 2150), ("mar", 1990), ("mar", None), (None, 2150)], "city string, season int")
    ranges = spark.createDataFrame([("mar", 2000, None, "x"), ("mar", 1980, 1985, "y")], "city string, s int, e int, f string")
    assert rows(joins.dated_override(q, ranges, "city", "season", "s", "e", "f", "fid")) == [
        (None, 2150, None), ("mar", None, None), ("mar", 1990, None), ("mar", 2150, "x")]


def test_disagreeing_offers_fill_nothing(spark):
    spine = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "id int, city string")
    offers = spark.createDataFrame([(1, "x"), (1, "y"), (2, "b"), (3, "z")], "id int, city string")
    out = resolve.fill_empty(spine, offers, "id", ["city"])
    assert rows(out.rows) == [(1, None), (2, "a"), (3, "z")] and rows(out.filled) == [(3, "city", "z")]
    assert rows(out.conflicts) == [(1, "city", None, "x"), (1, "city", None, "y"), (2, "city", "a", "b")]
