"""Funnels from session masks and sessions from active minutes, against plain Python."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventmarts.operators import marts, sessions
from eventmarts.schema import EVENT_TYPES
from tests import plain
from tests.test_properties import T0, _frame


def _masked(spark, evs, steps, gap=30):
    out = marts.funnel_of_events(_frame(spark, evs), gap, steps).collect()
    return {(r["step_number"], r["step_name"]): r["sessions_reached"] for r in out}


def _events(n=400):
    """Several users, one without an id, times around the gap and missing ones."""
    out = []
    for i in range(n):
        user = ("a", "b", "hot", None)[i % 4]
        seconds = None if i % 37 == 0 else (i * 977) % (3 * 86400)
        out.append((user, seconds, EVENT_TYPES[(i * 7) % 5]))
    return out


def _want(evs, steps, gap=30):
    rows = [{"source": "batch_historical", "session_id": None, "user_id": u, "event_id": f"e{i:04d}",
             "at": T0 + dt.timedelta(seconds=s), "event_type": t}
            for i, (u, s, t) in enumerate(evs) if s is not None and u is not None]
    kinds = [{e["event_type"] for e in part} for part in plain.sessions(rows, gap)]
    got = {(n, t): sum(t in k for k in kinds) for _, n, t in steps}
    return {k: v for k, v in got.items() if v}


@pytest.mark.parametrize("gap", [0, 30, 360])
def test_masks_equal_plain_sessions(spark, gap):
    steps = [("batch_historical", i + 1, t) for i, t in enumerate((*EVENT_TYPES, "refund"))]
    evs = _events()
    assert _masked(spark, evs, steps, gap) == _want(evs, steps, gap)


def test_more_types_than_a_word_has_bits(spark):
    types = [f"kind{i}" for i in range(150)]
    evs = [("u" + str(i % 5), (i * 3571) % 86400, types[(i * 11) % 140]) for i in range(300)]
    steps = [("batch_historical", i + 1, t) for i, t in enumerate(types)]
    masks = sessions.event_masks(_frame(spark, evs), types)
    assert masks.columns == ["source", "mask0", "mask1", "mask2"]
    assert _masked(spark, evs, steps) == _want(evs, steps)


def test_any_step_list_of_the_types_from_one_set_of_masks(spark):
    """Masks hold their types in order, so one table of masks answers lists over these types."""
    evs, steps = _events(), [("batch_historical", 2, "click"), ("batch_historical", 1, "purchase"),
                             ("batch_historical", 3, "click"), ("stream", 1, "click")]
    masks = sessions.event_masks(_frame(spark, evs), marts.step_types(steps))
    out = marts.funnel_of_masks(masks, steps).collect()
    assert {(r["step_number"], r["step_name"]): r["sessions_reached"] for r in out} == _want(evs, steps[:3])
    assert marts.funnel_of_masks(masks, []).count() == 0
    assert marts.funnel_of_masks(masks.limit(0), steps).count() == 0


def test_funnel_of_a_fact_equals_funnel_of_events(spark):
    evs = _events()
    df = _frame(spark, evs)
    steps = [("batch_historical", 1, "page_view"), ("batch_historical", 2, "click")]
    fact = marts.event_fact(sessions.sessionize(df, 30))
    assert sorted(marts.funnel(fact, steps).collect()) == sorted(marts.funnel_of_events(df, 30, steps).collect())


def test_a_heavy_user_is_a_row_per_minute(spark):
    """100,000 events of one user within two hours: the window sees 120 rows."""
    burst = spark.range(100_000).select(
        F.lit("hot").alias("user_id"), F.lit("batch_historical").alias("source"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") % 7200).cast("decimal(18,6)")))
        .alias("event_timestamp"), F.lit("click").alias("event_type"))
    minutes = sessions._minutes(burst, ["source", "user_id"], 30, F.count(F.lit(1)).alias("n")).collect()
    assert len(minutes) == 120 and sum(r["n"] for r in minutes) == 100_000 and {r["_no"] for r in minutes} == {1}
