"""Property tests on random event sets, some without users or times: split scans equal
plain windows, active users and retention equal plain counts."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventmarts.functions import minute_boundaries
from eventmarts.operators import marts, sessions
from tests import plain
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
TYPES = ("page_view", "click", "add_to_cart", "purchase")

# second offsets over ~40 days, clustered so gaps near 30 minutes occur
SECONDS = st.one_of(st.integers(0, 40 * 86400), st.integers(0, 4 * 3600))
event = st.tuples(st.sampled_from(["u1", "u2", "u3", "hot"]), SECONDS, st.sampled_from(TYPES))
gappy_event = st.tuples(st.sampled_from(["u1", "u2", None]), st.one_of(st.none(), SECONDS),
                        st.sampled_from(TYPES))
SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, evs):
    data = [(f"e{i:04d}", u, None if s is None else T0 + dt.timedelta(seconds=s), t)
            for i, (u, s, t) in enumerate(evs)]
    df = spark.createDataFrame(
        data, "event_id string, user_id string, event_timestamp timestamp, event_type string")
    return df.select(
        "event_id", "user_id", F.lit(None).cast("string").alias("session_id"), "event_type",
        "event_timestamp", F.to_date("event_timestamp").alias("event_date"),
        *[F.lit(None).cast("string").alias(c) for c in
          ("element_id", "url", "referrer", "item_id", "transaction_id")],
        F.lit("batch_historical").alias("source"))


@SETTINGS
@given(st.lists(event, min_size=1, max_size=120), st.sampled_from([0, 30, 360]))
def test_gap_sessions_match_plain_window(spark, evs, gap):
    df = _frame(spark, evs)
    w = Window.partitionBy("user_id").orderBy("event_timestamp", "event_id")
    mins = minute_boundaries(F.lag("event_timestamp").over(w), F.col("event_timestamp"))
    p = df.withColumn("_n", (mins.isNull() | (mins > gap)).cast("int"))
    p = p.withColumn("_s", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    p = (p.withColumn("session_start_at", F.min("event_timestamp").over(
            Window.partitionBy("user_id", "_s")))
         .withColumn("event_sequence_number", F.row_number().over(
            Window.partitionBy("user_id", "_s").orderBy("event_timestamp", "event_id"))))
    split = sessions.gap_session_events(df, gap)
    cols = ("event_id", "session_start_at", "event_sequence_number")
    assert rows(split, *cols) == rows(p, *cols)
    # the interval-join attach agrees with the join-free one
    cols = ("event_id", "session_id", "event_sequence_number")
    assert rows(sessions.sessionize(df, gap), *cols) == rows(
        sessions.sessionize_interval_join(df, gap), *cols)


def _plain_events(evs):
    return [{"source": "batch_historical", "user_id": u, "day": (T0 + dt.timedelta(seconds=s)).date()}
            for u, s, _ in evs if s is not None]


@SETTINGS
@given(st.lists(gappy_event, min_size=1, max_size=150))
def test_active_users_count_users_on_days(spark, evs):
    df = _frame(spark, evs)
    want = plain.active(_plain_events(evs))
    for method in ("sweep", "range_join"):
        assert sorted(tuple(r) for r in marts.active_users(df, method=method).collect()) == want


@SETTINGS
@given(st.lists(gappy_event, min_size=1, max_size=150))
def test_retention_counts_users_of_a_cohort(spark, evs):
    got = [tuple(r) for r in marts.retention(_frame(spark, evs)).collect()]
    assert sorted(r for r in got if r[2] is not None) == plain.retention(_plain_events(evs))
    size = {r[1]: r[3] for r in got if r[2] == 0}
    for _, week, _, cohort, retained, rate in got:  # undated weeks are a cell of their own
        assert cohort == size[week] and 0 < retained <= cohort and rate == round(100 * retained / cohort, 2)
    cohorts = {r.cohort_week: r.cohort_size for r in marts.cohort_sizes(_frame(spark, evs)).collect()}
    assert all(cohorts[w] == n for w, n in size.items())
    assert sum(cohorts.values()) == len({u for u, *_ in evs if u is not None})


@SETTINGS
@given(st.lists(event, min_size=1, max_size=150))
def test_funnel_counts_sessions_with_the_step(spark, evs):
    df = sessions.sessionize(_frame(spark, evs))
    got = {r.step_name: r.sessions_reached
           for r in marts.funnel(df).where("source = 'batch_historical'").collect()}
    per_type = {r.event_type: r.n for r in df.groupBy("event_type").agg(
        F.countDistinct("session_id").alias("n")).collect()}
    for name in ("page_view", "add_to_cart", "purchase"):
        assert got.get(name) == per_type.get(name)
    assert "click" not in got  # not a step of this source
