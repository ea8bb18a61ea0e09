"""Column functions against literal probes (boundary counts, keys, ids, rounding)."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid

from pyspark.sql import functions as F

from eventmarts.functions import (
    iso_millis,
    minute_boundaries,
    pct,
    second_boundaries,
    surrogate_key,
    ts_key_text,
    uuid5,
    week_start,
    weeks_between,
)
from eventmarts.schema import EVENT_ID_NAMESPACE


def _one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def _ts(s):
    return F.lit(s).cast("timestamp")


def test_minute_boundaries_count_crossings(spark):
    assert _one(spark, minute_boundaries(_ts("2024-01-01 10:00:59"), _ts("2024-01-01 10:31:01"))) == 31
    assert _one(spark, minute_boundaries(_ts("2024-01-01 10:00:01"), _ts("2024-01-01 10:30:59"))) == 30
    assert _one(spark, minute_boundaries(_ts("2024-01-01 10:00:00"), _ts("2024-01-01 10:30:00"))) == 30
    # before 1970 the truncation still counts boundaries
    assert _one(spark, minute_boundaries(_ts("1969-12-31 23:59:59"), _ts("1970-01-01 00:00:01"))) == 1


def test_second_boundaries(spark):
    assert _one(spark, second_boundaries(_ts("2024-01-01 10:00:00.999"),
                                         _ts("2024-01-01 10:00:01.001"))) == 1
    assert _one(spark, second_boundaries(_ts("2021-11-10 12:00:00.125"),
                                         _ts("2021-11-10 12:02:39.9"))) == 159


def test_week_start_and_weeks_between(spark):
    assert _one(spark, week_start(F.lit("2015-01-11").cast("date"))) == dt.date(2015, 1, 5)
    assert _one(spark, week_start(F.lit("2015-01-05").cast("date"))) == dt.date(2015, 1, 5)
    assert _one(spark, weeks_between(F.lit("2015-01-05").cast("date"),
                                     F.lit("2015-01-19").cast("date"))) == 2


def test_uuid5_matches_rfc4122(spark):
    keys = ["7-1-view-31", "-", "", "ünïcödé-key", "x" * 300]
    ns = uuid.UUID(EVENT_ID_NAMESPACE)
    got = dict(spark.createDataFrame([(k,) for k in keys], "k string")
               .select("k", uuid5(EVENT_ID_NAMESPACE, F.col("k")).alias("u")).collect())
    assert got == {k: str(uuid.uuid5(ns, k)) for k in keys}


def test_surrogate_key_text(spark):
    ts = _ts("2021-11-10 12:00:00.125")
    assert _one(spark, ts_key_text(ts)) == "2021-11-10 12:00:00.125+00"
    assert _one(spark, ts_key_text(_ts("2021-11-10 12:00:00.500"))) == "2021-11-10 12:00:00.5+00"
    assert _one(spark, surrogate_key(F.lit("hist-7"), ts_key_text(ts))) == hashlib.md5(
        b"hist-7-2021-11-10 12:00:00.125+00").hexdigest()
    # NULL parts use the placeholder text
    assert _one(spark, surrogate_key(F.lit(None).cast("string"), F.lit("a"))) == _one(
        spark, F.md5(F.lit("_dbt_utils_surrogate_key_null_-a")))


def test_iso_millis_truncates(spark):
    assert _one(spark, iso_millis(F.timestamp_millis(F.lit(1636545600125)))) == "2021-11-10T12:00:00.125Z"


def test_pct_rounds_half_up_and_guards_zero(spark):
    assert _one(spark, pct(F.lit(13.125), F.lit(100))) == 13.13
    assert _one(spark, pct(F.lit(2), F.lit(3))) == 66.67
    assert _one(spark, pct(F.lit(1), F.lit(0))) is None
