"""Event order of games: clocks, running scores carried and checked, and who was on the court when."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import squish
from .skew import running

POINTS = {"made_3": 3, "made_2": 2, "made_ft": 1}  # fixed values
SEQ_RANGE = 4096  # plays of one period that one task orders


def with_clock(plays: DataFrame, period: str = "period_raw", clock: str = "clock", regular: int = 4, minutes: int = 10, overtime: int = 5, run_on: bool = True) -> DataFrame:
    """Adds period (overtimes count on) and elapsed seconds since the start; what cannot be read is NULL.

    The clock counts down within its period; one that shows more than the period has is no clock. Without `run_on` the
    seconds of every overtime count from the end of the regular time, not from the end of the overtime before it.
    """
    raw = F.upper(squish(period))
    number = F.regexp_extract(raw, r"(\d+)", 1).try_cast("int")
    extra = raw.rlike(r"^(OT|T\.?E|PR[OÓ]RROGA|SOBRETIEMPO)")
    p = F.when(extra, regular + F.coalesce(number, F.lit(1))).otherwise(number)
    minute, second = (F.regexp_extract(squish(clock), r"^(\d{1,2}):([0-5]\d)", i).try_cast("int") for i in (1, 2))
    left = F.col("__left")
    length = F.when(F.col("period") <= regular, minutes * 60).otherwise(overtime * 60)
    start = F.least(F.col("period") - 1, F.lit(regular)) * minutes * 60
    if run_on:
        start += F.greatest(F.col("period") - 1 - regular, F.lit(0)) * overtime * 60
    timed = plays.withColumns({"period": p, "__left": minute * 60 + second})
    return timed.withColumn("elapsed", F.when((left <= length) & (F.col("period") >= 1), start + length - left)).drop("__left")


def with_running_score(plays: DataFrame, keys: Sequence[str], seq: str = "seq", points: dict[str, int] | None = None) -> DataFrame:
    """Adds the score after each play three ways, and how they agree.

    `local_run`, `visit_run`: points of the plays so far, by the team each names. `local_carried`, `visit_carried`: the last
    stated score, carried over plays that state none. `score_check`: ok or mismatch between the two, and an empty text before
    any score is stated. A game of any length is ordered in ranges of SEQ_RANGE places, not by one task.
    """
    worth = F.lit(0)
    for event, n in (points or POINTS).items():
        worth = F.when(F.col("event_type") == event, n).otherwise(worth)
    sides = {"local": F.col("team_raw") == F.col("local_team"), "visit": F.col("team_raw") == F.col("visit_team")}
    sums = {f"{s}_run": F.when(own, worth).otherwise(0).cast("long") for s, own in sides.items()}
    out = running(plays, keys, F.floor(F.col(seq) / SEQ_RANGE), [F.col(seq)], sums, carries={f"{s}_carried": f"{s}_score" for s in sides})
    known = F.col("local_carried").isNotNull() & F.col("visit_carried").isNotNull()
    same = (F.col("local_carried") == F.col("local_run")) & (F.col("visit_carried") == F.col("visit_run"))
    return out.withColumn("score_check", F.when(~known, "").when(same, "ok").otherwise("mismatch"))


# fixed value: who leaves, who comes, and for which team
EXCHANGE = r"Sale\s+(.+?)\s+Entra\s+(.+?)\s+de\s+([A-ZÁÉÍÓÚÑ ]+)\s*$"


def exchanges(plays: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """One row for each player who comes or leaves: keys, seq, elapsed, team, player, comes."""
    play = squish("play_raw")
    part = [squish(F.regexp_extract(play, EXCHANGE, i)) for i in (1, 2, 3)]
    moves = F.array(F.struct(part[0].alias("player"), F.lit(False).alias("comes")), F.struct(part[1].alias("player"), F.lit(True).alias("comes")))
    return (plays.where((F.col("event_type") == "substitution") & play.rlike(EXCHANGE))
            .select(*keys, seq, "elapsed", part[2].alias("team"), F.explode(moves).alias("m")).select(*keys, seq, "elapsed", "team", "m.player", "m.comes"))


def court_intervals(plays: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """Stretches of the game each substituted player was on the court, from seq and second to seq and second.

    A player whose first move is to leave has been on since the start; one who never leaves stays to the last play (`open`).
    A second coming without a leaving between ends nothing and starts nothing; it is counted as `odd`.
    """
    ends = plays.groupBy(*keys).agg(F.max(seq).alias("__last"), F.max("elapsed").alias("__end"))
    who = [*keys, "team", "player"]
    each = Window.partitionBy(*who)
    w = each.orderBy(seq, "comes")
    # one order of each player's moves serves all: what came before, the odd ones, and among the others what comes next
    moves = exchanges(plays, keys, seq).withColumn("__before", F.lag("comes").over(w))
    moves = moves.withColumn("odd", F.count_if(F.col("__before") == F.col("comes")).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    real = moves.where(F.col("__before").isNull() | (F.col("__before") != F.col("comes")))
    real = real.withColumns({"__to": F.lead(seq).over(w), "__to_s": F.lead("elapsed").over(w)})
    comes = F.col("comes")
    found = real.where(comes | F.col("__before").isNull()).select(
        *who, "odd", *[F.when(comes, F.col(c)).otherwise(first).alias(name) for name, c, first in (
            ("from_seq", seq, F.lit(0)), ("from_s", "elapsed", F.lit(0)), ("to_seq", "__to", F.col(seq)), ("to_s", "__to_s", F.col("elapsed")))])
    return (found.join(ends, list(keys))
            .select(*who, "from_seq", "from_s", F.coalesce("to_seq", "__last").alias("to_seq"), F.when(F.col("to_seq").isNull(), F.col("__end")).otherwise(F.col("to_s")).alias("to_s"),
                    F.col("to_seq").isNull().alias("open"), "odd"))
