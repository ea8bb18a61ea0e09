"""End to end over a small bronze fixture, against the models in plain Python."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from eventmarts.operators import marts, quality, reports, sessions
from tests import plain
from tests.conftest import HIST_ROOT, STREAM_ROOT, rows

D = dt.date


@pytest.fixture(scope="module")
def events():
    out = plain.load(STREAM_ROOT) + plain.load(HIST_ROOT)
    plain.sessions(out)
    return out


def test_the_fixture_has_the_cases(events):
    parts = plain.sessions(events)
    assert len(events) == 25 and len(parts) == 15
    by_event = {e["event_id"]: e["sid"] for e in events}
    assert by_event["o-01"] == by_event["o-02"] != by_event["o-03"] == by_event["o-04"]  # 30, 31, 0 minutes
    assert by_event["o-05"] == by_event["o-06"] != by_event["o-07"]  # over midnight


def test_sessions(events, fixture_models):
    want = sorted((p[0]["sid"], p[0]["user_id"] or "", len(p),
                   int((p[-1]["at"].replace(microsecond=0) - p[0]["at"].replace(microsecond=0)).total_seconds()))
                  for p in plain.sessions(events))
    got = sorted((r.session_id, r.user_id or "", r.event_count, r.duration_seconds)
                 for r in fixture_models["fct_sessions"].collect())
    assert got == want


def test_event_fact(events, fixture_models):
    want = sorted((e["event_id"], e["sid"], k) for p in plain.sessions(events)
                  for k, e in enumerate(p, 1) if plain.in_fact(e))
    assert rows(fixture_models["fct_events"], "event_id", "session_id", "event_sequence_number") == want


def test_funnel(events, fixture_models):
    got = [tuple(r) for r in marts.funnel(fixture_models["fct_events"]).collect()]
    assert sorted(got) == plain.funnel(events)
    assert ("stream", 3, "add_to_cart", 2, 50.0, 66.67) in got


@pytest.mark.parametrize("method", ["sweep", "range_join"])
def test_active_users(events, fixture_models, method):
    # the spine comes from all events, the users from the fact
    got = marts.active_users(fixture_models["fct_events"], fixture_models["dim_date"], method)
    assert sorted(tuple(r) for r in got.collect()) == plain.active(events)


def test_dim_date_spans_events_that_no_user_owns(events, fixture_models):
    days = sorted(tuple(r) for r in fixture_models["dim_date"].collect())
    assert days == plain.spine(events)
    assert ("batch_historical", D(2021, 12, 6)) in days  # only a NULL user's event


def test_retention(events, fixture_models):
    got = [tuple(r) for r in marts.retention(fixture_models["fct_events"]).collect()]
    assert sorted(got) == plain.retention(events)


def test_interval_join_equals_join_free(fixture_models):
    conformed = fixture_models["int_events_unioned"]
    cols = ("event_id", "session_id", "event_sequence_number")
    assert rows(sessions.sessionize(conformed), *cols) == rows(
        sessions.sessionize_interval_join(conformed), *cols)


def test_model_tests(fixture_models):
    fct = fixture_models["fct_events"]
    models = {**fixture_models, "mart_funnel_analysis": marts.funnel(fct),
              "mart_dau_wau_mau": marts.active_users(fct, fixture_models["dim_date"]),
              "mart_retention": marts.retention(fct)}
    failed = {(r.model, r.column, r.failures)
              for r in quality.run_model_tests(models).where(~F.col("passed")).collect()}
    # the fixture's three events without a user, wherever a user is asked for
    assert all(column == "user_id" for _, column, _ in failed) and failed


def test_reports(events, fixture_models):
    fct, fs = fixture_models["fct_events"], fixture_models["fct_sessions"]
    assert [r.source for r in reports.list_sources(fct).collect()] == ["batch_historical", "stream"]
    k = reports.overview_kpis(fct, fs, "stream").first()
    assert (k.total_events, k.total_sessions, k.min_date, k.max_date) == (12, 5, D(2022, 3, 7), D(2022, 3, 10))
    mix = [(r.event_type, r.event_count, r.position)
           for r in reports.event_mix(fct, "batch_historical").collect()]
    assert mix == [("page_view", 6, 1), ("add_to_cart", 3, 2), ("purchase", 2, 3)]
    order = [(r.cohort_week, r.weeks_since_cohort, r.position) for r in
             reports.read_retention(marts.retention(fct), "batch_historical").collect()]
    assert order == sorted(order) and [p for *_, p in order] == list(range(1, len(order) + 1))


def test_retention_matrix_shows_every_week_or_refuses(fixture_models):
    mart = marts.retention(fixture_models["fct_events"])
    m = reports.retention_matrix(mart, source="batch_historical")
    assert m.columns == ["source", "cohort_week", "w0", "w1", "w2", "w3", "w4"]
    got = {r.cohort_week: r for r in m.collect()}
    assert (got[D(2021, 11, 1)].w1, got[D(2021, 11, 1)].w2, got[D(2021, 11, 1)].w4) == (50.0, None, 50.0)
    with pytest.raises(ValueError, match="week"):
        reports.retention_matrix(mart, [0, 1])
    assert reports.retention_matrix(mart.limit(0)).columns == ["source", "cohort_week"]


def test_pipeline_publishes_only_after_its_tests(spark, scratch, events):
    from eventmarts.plans.pipeline import Paths, run_pipeline

    strict = [t for t in quality.MODEL_TESTS if t[2] != "user_id"]
    paths = Paths(STREAM_ROOT, HIST_ROOT, os.path.join(scratch, "wh"))
    out = run_pipeline(spark, paths, gate=False, tests=strict)
    assert set(out) == {"stg_events_stream", "stg_events_historical", "fct_events",
                        "fct_sessions", "dim_date", "mart_funnel_analysis",
                        "mart_dau_wau_mau", "mart_retention"}
    want = plain.active(events)
    assert sorted(tuple(r) for r in spark.read.parquet(out["mart_dau_wau_mau"]).collect()) == want
    assert spark.read.parquet(out["fct_sessions"]).count() == len(plain.sessions(events))
    # a build whose tests fail leaves what is published in place
    other = Paths(STREAM_ROOT, os.path.join(HIST_ROOT, "dt=2021-11-01"), paths.warehouse)
    with pytest.raises(AssertionError, match="model tests failed"):
        run_pipeline(spark, other, gate=False,
                     tests=[*strict, ("fct_events", "accepted_values", "source", ("stream",))])
    assert sorted(tuple(r) for r in spark.read.parquet(out["mart_dau_wau_mau"]).collect()) == want
    with pytest.raises(AssertionError, match="required_fields_present"):
        run_pipeline(spark, paths)


def test_serve_binds_parameters(spark, fixture_models):
    reports.register_models({"fct_events": fixture_models["fct_events"]})
    assert reports.serve(spark, "fct_events", "stream").count() == 12
    assert reports.serve(spark, "fct_events", "stream' OR '1'='1").count() == 0
    rows_ = reports.serve(spark, "fct_events", "batch_historical", ["event_timestamp"]).collect()
    assert len(rows_) == 11 and rows_[0].event_id == "o-01"
