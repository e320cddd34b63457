"""Streams give the batch answer, also for late captures and repeated batches."""

import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import rows
from cartulary.operators import dedup
from cartulary.streaming import ingest, state

SCHEMA = "season string, champion string, ts timestamp, cap long"


@pytest.fixture()
def feed(spark, tmp_path):
    day = lambda d: dt.datetime(2010, 1, d)
    batches = [[("1950", "rio", day(5), 1), ("1951", "mar", day(5), 2)], [("1950", "sol", day(9), 3)],
               [("1950", "rio", day(2), 4), ("1951", "mar", day(8), 5), ("1952", None, day(1), 6)]]  # the last file arrives late
    for i, b in enumerate(batches):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{i}")
    return [r for b in batches for r in b], tmp_path


def stream(spark, tmp_path):
    return ingest.file_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def test_latest_wins_equals_the_batch_operator(spark, feed):
    data, tmp = feed
    ingest.ingest_observations(stream(spark, tmp), ["season"], ["champion"], ["ts", "cap"], f"{tmp}/ledger", f"{tmp}/progress")
    got = ingest.latest_observations(spark, f"{tmp}/ledger", ["season"], ["champion"])
    want = dedup.latest_wins(spark.createDataFrame(data, SCHEMA), ["season"], ["ts", "cap"], ["champion"]).latest
    cols = ["season", "champion", "n_captures", "n_variants", "confidence"]
    assert rows(got, *cols) == rows(want, *cols)
    assert rows(got, "season", "champion", "confidence")[0] == ("1950", "sol", "disputed")


def test_captures_keep_the_earliest_and_survive_a_rerun(spark, feed):
    data, tmp = feed
    s = stream(spark, tmp).withColumn("digest", F.sha2(F.concat_ws("|", "season", "champion"), 256))
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest_captures(s.select("digest", "cap", "ts"), "digest", "cap", "ts", f"{tmp}/ledger2", f"{tmp}/progress2")
    got = ingest.captures(spark, f"{tmp}/ledger2", "digest", "cap", "ts")
    assert rows(got, "cap", "n_captures") == [(2, 2), (3, 1), (4, 2), (6, 1)]
    ingest.compact(spark, f"{tmp}/ledger2", f"{tmp}/folded", lambda d: d.groupBy("digest").agg(F.min("ts").alias("ts")))
    assert spark.read.parquet(f"{tmp}/folded").count() == 4


def test_late_captures_are_relabelled_by_capture_time(spark, feed):
    _, tmp = feed

    def relabel(df):
        season = F.when((F.col("season") == "1950") & (F.col("ts") >= "2010-01-09"), "1951").otherwise(F.col("season"))
        return df.withColumn("digest", season)

    ingest.ingest_captures(stream(spark, tmp), "digest", "cap", "ts", f"{tmp}/ledger3", f"{tmp}/progress3", relabel)
    assert rows(ingest.captures(spark, f"{tmp}/ledger3", "digest", "cap", "ts"), "digest", "cap", "n_captures") == [("1950", 4, 2), ("1951", 2, 3), ("1952", 6, 1)]


def test_state_keeps_the_batch_answer_over_shuffled_arrival_and_a_restart(spark, tmp_path):
    rng = random.Random(5)
    data = [(f"k{rng.randrange(9)}" if rng.random() < 0.6 else "hot", rng.choice([None, "a", "b"]), dt.datetime(2010, 1, 1) + dt.timedelta(hours=rng.randrange(900)), i) for i in range(400)]
    data.append((None, "a", None, 400))
    for i in range(0, 401, 50):
        spark.createDataFrame(data[i:i + 50], SCHEMA).coalesce(2).write.parquet(f"{tmp_path}/in/{i}")
    want = rows(dedup.latest_wins(spark.createDataFrame(data, SCHEMA), ["season"], ["ts", "cap"], ["champion"]).latest, "season", "champion", "n_captures", "n_variants")
    earliest = {}
    for k, _, t, c in data:
        earliest.setdefault(k, []).append((t is not None, t, c))
    folders = sorted(p.name for p in (tmp_path / "in").iterdir())
    for part in (folders[:4], folders):  # the second run goes on from the first one's state
        feed = f"{tmp_path}/feed"
        for f in part:
            for file in (tmp_path / "in" / f).glob("part-*"):
                target = tmp_path / "feed" / f"{f}-{file.name}"
                target.parent.mkdir(exist_ok=True)
                if not target.exists():
                    shutil.copy(file, target)
        s = ingest.file_stream(spark, feed, spark.createDataFrame([], SCHEMA).schema, files_per_batch=3)
        latest, first = state.latest_updates(s, ["season"], ["champion"], ["ts", "cap"]), state.first_updates(s, "season", "cap", "ts")
        state.keep_updates(latest, f"{tmp_path}/l1", f"{tmp_path}/p1")
        state.keep_updates(first, f"{tmp_path}/l2", f"{tmp_path}/p2")
    got = state.answers(spark, f"{tmp_path}/l1", ["season"], latest.schema)
    assert rows(got, "season", "champion", "n_captures", "n_variants") == want
    once = {r.season: (r.cap, r.n_captures) for r in state.answers(spark, f"{tmp_path}/l2", ["season"], first.schema).collect()}
    assert once == {k: (min(v)[2] if k is not None else 400, len(v)) for k, v in earliest.items()}


def test_state_relabels_late_captures(spark, feed):
    _, tmp = feed

    def relabel(df):
        return df.withColumn("season", F.when((F.col("season") == "1950") & (F.col("ts") >= "2010-01-09"), "1951").otherwise(F.col("season")))

    updates = state.first_updates(stream(spark, tmp), "season", "cap", "ts", relabel)
    state.keep_updates(updates, f"{tmp}/l", f"{tmp}/p")
    assert rows(state.answers(spark, f"{tmp}/l", ["season"], updates.schema), "season", "cap", "n_captures") == [("1950", 4, 2), ("1951", 2, 3), ("1952", 6, 1)]
