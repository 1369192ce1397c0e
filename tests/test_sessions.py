"""Sessions and stream joins: stream equals batch, state is evicted."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ledgerline.streaming import sessions as S

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def write_batches(spark, rows, folder, files):
    """Events as parquet files, in the given order, one file per micro-batch."""
    for k, part in enumerate(files(rows)):
        df = spark.createDataFrame(part, S.EVENT_SCHEMA).coalesce(1)
        df.write.mode("append").parquet(f"{folder}/b={k:03d}")
    return folder


def stream_of(spark, folder):
    return (spark.readStream.schema(S.EVENT_SCHEMA).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(folder))


@pytest.fixture()
def rows():
    rng = random.Random(8)
    out = [(i, START + timedelta(minutes=rng.randrange(60 * 24), seconds=i % 60), rng.randrange(6),
            rng.choice(["click", "purchase", "view"]), 1.25, "{}") for i in range(400)]
    return sorted(out, key=lambda r: r[1])


def shuffled_within(minutes):
    """Files in time order whose rows are out of order by less than the lateness."""
    def deal(rows):
        rng = random.Random(1)
        jittered = sorted(rows, key=lambda r: r[1] + timedelta(minutes=rng.random() * minutes))
        return [jittered[k:k + 60] for k in range(0, len(jittered), 60)]
    return deal


def final(df):
    return sorted(map(tuple, df.select("user_id", "start", "n_events", "n_purchases", "value").collect()))


def test_sessions_of_a_shuffled_restarted_stream_equal_the_batch(spark, rows, tmp_out):
    batch = spark.createDataFrame(rows, S.EVENT_SCHEMA)
    late = (10 ** 6, rows[-1][1] + timedelta(days=3), None, "view", 0.0, "{}")
    closing = (10 ** 6 + 1, rows[-1][1] + timedelta(days=3), 99, "view", 0.0, "{}")
    write_batches(spark, rows, f"{tmp_out}/in", lambda r: shuffled_within(60)(r)[:3])
    q = S.session_stream(stream_of(spark, f"{tmp_out}/in"), f"{tmp_out}/out", f"{tmp_out}/check")
    q.awaitTermination()
    write_batches(spark, rows, f"{tmp_out}/in2", lambda r: shuffled_within(60)(r)[3:] + [[closing, late]])
    for name in ("in2",):       # more files arrive, the query starts again from its checkpoint
        (spark.read.schema(S.EVENT_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{tmp_out}/{name}")
         .orderBy("ts").coalesce(1).write.mode("append").parquet(f"{tmp_out}/in/late"))
    q = S.session_stream(stream_of(spark, f"{tmp_out}/in"), f"{tmp_out}/out", f"{tmp_out}/check")
    q.awaitTermination()
    found = spark.read.parquet(f"{tmp_out}/out")
    assert final(found) == final(S.sessions(batch))
    # final sessions leave no state: only the closing event's session is still open
    state = q.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] <= 2


def test_events_later_than_the_watermark_are_dropped(spark, rows, tmp_out):
    old = (10 ** 6, rows[0][1] - timedelta(days=2), 1, "purchase", 1.0, "{}")
    write_batches(spark, rows, f"{tmp_out}/in", lambda r: [r[:200], r[200:], [old]])
    q = S.session_stream(stream_of(spark, f"{tmp_out}/in"), f"{tmp_out}/out", f"{tmp_out}/check")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_out}/out").where(F.col("start") < rows[0][1] - timedelta(days=1)).count() == 0


def test_stream_join_equals_the_batch_join(spark, rows, tmp_out):
    batch = spark.createDataFrame(rows, S.EVENT_SCHEMA)
    want = S.clicks_before(batch.where("event_type = 'purchase'"), batch.where("event_type = 'click'"))
    end = rows[-1][1] + timedelta(days=3)
    closing = [[(10 ** 6, end, 98, "purchase", 0.0, "{}"), (10 ** 6 + 1, end, 97, "click", 0.0, "{}")]] * 2
    folder = write_batches(spark, rows, f"{tmp_out}/in", lambda r: shuffled_within(60)(r) + closing)
    q = S.joined_streams(stream_of(spark, folder), stream_of(spark, folder), f"{tmp_out}/out", f"{tmp_out}/check")
    q.awaitTermination()
    assert sorted(spark.read.parquet(f"{tmp_out}/out").collect()) == sorted(want.collect())
    # the watermark has passed every row but the closing ones: state is bounded by time, not by input
    state = q.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] <= 8 < len(rows)


def test_batch_sessions(spark):
    at = lambda m: START + timedelta(minutes=m)
    df = spark.createDataFrame([(1, at(0), 1, "click", 1.0, None), (2, at(29), 1, "purchase", 2.0, None),
                                (3, at(59), 1, "click", None, None), (6, at(90), 1, "click", None, None), (4, None, 1, "click", 1.0, None),
                                (5, at(0), None, "click", 1.0, None)], S.EVENT_SCHEMA)
    got = sorted(map(tuple, S.sessions(df).select("n_events", "n_purchases", F.col("value").cast("double")).collect()),
                 key=str)
    assert got == [(1, 0, None), (3, 1, 3.0)]
    assert S.sessions(df.where("false")).count() == 0
