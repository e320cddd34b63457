"""Inferred line-ups keep unresolved members under their raw names and take whole games only."""

from pyspark.sql import functions as F

from cartulary.operators import aggregates


def test_unresolved_members_and_short_games(spark):
    rows = [(g, "t", None if m == 0 else f"m{m}", f"name{m}", 10 - m, 2) for g in range(15) for m in range(5 if g < 14 else 4)]
    rows += [(99, "t", f"m{m}", f"name{m}", 10 - m, 2) for m in range(1, 6)]
    box = spark.createDataFrame(rows, "game int, team string, member string, name string, minutes int, points int")
    got = aggregates.inferred_lineups(box, ["game"], ["team"], "member", "minutes", "points", "name").collect()
    assert {(r["member"], r["n_starts"]) for r in got} == {("raw:name0", 14), ("m1", 15), ("m2", 15), ("m3", 15), ("m4", 15)}
    assert {(r["n_games"], round(r["resolved_share"], 4)) for r in got} == {(15, round(61 / 75, 4))}
    known = aggregates.inferred_lineups(box, ["game"], ["team"], "member", "minutes", "points", "name", known=F.col("member") != "m1", min_resolved=0.5).collect()
    assert {(r["n_resolved"], round(r["resolved_share"], 4)) for r in known} == {(3, round(46 / 75, 4))}
    assert aggregates.inferred_lineups(box, ["game"], ["team"], "member", "minutes", "points", "name", known=F.lit(None).cast("boolean")).count() == 0
