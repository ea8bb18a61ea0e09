"""Sessions closed inside the stream equal the batch ones, across restarts, with late rows."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from eventmarts.operators import sessions, staging
from eventmarts.schema import BRONZE, SESSION_FIELDS
from eventmarts.streaming.sessions import MINUTE, merge, stream_gap_sessions

T0 = dt.datetime(2024, 1, 1, 12)


def _record(i, user, at):
    return (f"e{i}", user, None, "click", None if at is None else at.isoformat(), None, "batch_historical")


def _deliver(spark, landing, records):
    spark.createDataFrame(records, BRONZE).coalesce(1).write.mode("append").json(landing)


def _drain(spark, landing, out, ckpt, watermark, gap=30):
    lines = spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", 1).json(landing)
    rows = stream_gap_sessions(staging.stage_historical(lines), gap, watermark=watermark)
    (rows.writeStream.format("parquet").option("checkpointLocation", ckpt).trigger(availableNow=True)
     .start(out).awaitTermination())


def _texts(df):
    return sorted(str(tuple(r[c] for c in SESSION_FIELDS)) for r in df.select(*SESSION_FIELDS).collect())


def test_merge_counts_minute_boundaries():
    s = lambda m, sec=0: (m * 60 + sec) * 1_000_000
    assert merge([(s(31, 1), s(31, 1), 1), (s(0, 59), s(0, 59), 2)], 30) == [(s(0, 59), s(0, 59), 2), (s(31, 1), s(31, 1), 1)]
    assert merge([(s(0, 0), s(0, 0), 1), (s(30, 59), s(30, 59), 1)], 30) == [(s(0, 0), s(30, 59), 2)]
    # a late span joins two
    assert merge([(s(0), s(0), 1), (s(50), s(50), 1), (s(25), s(25), 1)], 30) == [(s(0), s(50), 3)]
    assert MINUTE == 60_000_000


def test_a_drained_stream_equals_the_batch_sessions(spark, scratch):
    rng = random.Random(4)
    records = []
    for i in range(240):
        at = T0 + dt.timedelta(seconds=rng.choice([rng.randrange(3 * 86400), rng.randrange(3 * 3600)]))
        records.append((at, _record(i, rng.choice(["a", "b", "hot", "hot", None]), at)))
    records.sort(key=lambda r: r[0])
    # events come up to six hours late, in an order of their own
    records.sort(key=lambda r: r[0] + dt.timedelta(seconds=rng.randrange(6 * 3600)))
    rows = [r for _, r in records] + [_record(900, "a", None), _record(901, None, None)]
    landing, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    for part in (rows[:80], rows[80:160], rows[160:], [(None, None, None, None, "2024-02-01T00:00:00", None, None)]):
        _deliver(spark, landing, part)
        _drain(spark, landing, out, ckpt, "8 hours")  # a restart between deliveries
    want = sessions.gap_sessions(staging.stage_historical(spark.createDataFrame(rows, BRONZE)))
    assert _texts(spark.read.parquet(out)) == _texts(want)


def test_sessions_leave_as_the_watermark_passes(spark, scratch):
    at = lambda h, m=0: T0 + dt.timedelta(hours=h, minutes=m)
    landing, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    _deliver(spark, landing, [_record(1, "u", at(0)), _record(2, "u", at(0, 40)), _record(3, "v", at(0, 5))])
    _drain(spark, landing, out, ckpt, "1 hour")
    assert spark.read.schema("session_id string").parquet(out).count() == 0
    _deliver(spark, landing, [_record(4, "u", at(0, 20))])  # late, joins u's two sessions
    _drain(spark, landing, out, ckpt, "1 hour")
    _deliver(spark, landing, [_record(5, "w", at(5))])
    _drain(spark, landing, out, ckpt, "1 hour")
    got = {(r["user_id"], r["event_count"]) for r in spark.read.parquet(out).collect()}
    assert got == {("u", 3), ("v", 1)}
    _deliver(spark, landing, [_record(6, "u", at(0, 50))])  # later than the watermark: dropped
    _drain(spark, landing, out, ckpt, "1 hour")
    assert spark.read.parquet(out).where(F.col("user_id") == "u").count() == 1


def test_no_user_is_a_python_call(spark, scratch):
    lines = spark.readStream.schema(BRONZE).json(scratch)
    plan = stream_gap_sessions(staging.stage_historical(lines))._jdf.queryExecution().analyzed().toString()
    assert "session_window" in plan
    assert not [n for n in ("WithState", "MapInArrow", "MapInPandas", "Python") if n in plan]


def test_an_event_behind_the_watermark_by_less_than_the_gap_is_no_session(spark, scratch):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    landing, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    _deliver(spark, landing, [_record(1, "u", at(0)), _record(2, "v", at(100))])  # the watermark: 40
    _drain(spark, landing, out, ckpt, "1 hour")
    _deliver(spark, landing, [_record(3, "u", at(20)), _record(4, "v", at(45)), _record(5, "v", at(400))])
    _drain(spark, landing, out, ckpt, "1 hour")
    got = {(r["user_id"], r["session_start_at"].minute, r["event_count"]) for r in spark.read.parquet(out).collect()}
    assert got == {("u", 0, 1), ("v", 45, 1), ("v", 40, 1)}
