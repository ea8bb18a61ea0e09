"""Physical-plan guards for the scale design (checked with AQE off and
broadcasts disabled, i.e. the plan a large input would get)."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from eventmarts.operators import marts, sessions
from eventmarts.plans import catalog
from eventmarts.plans.build import Model
from eventmarts.plans.ordered import gap_windows

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def large_plan(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",
                                           "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> int:
    return plan.count("Exchange ")


def test_session_scan_moves_event_rows_twice(spark, large_plan):
    """Above its input the written frame has a range and a hash exchange, no join."""
    m = Model(spark, SF)
    hist = m.conformed().where("source = 'batch_historical'")
    written = gap_windows(hist, ["source", "user_id"], "event_timestamp", "event_id", sessions.gap_rule(30))
    p = _plan(written)
    assert _exchanges(p) == _exchanges(_plan(hist)) + 2
    assert "rangepartitioning(source" in p and "hashpartitioning(_pk" in p and "SortMergeJoin" not in p
    # no window or exchange keyed by the user alone
    assert not re.search(r"hashpartitioning\(source#\d+, user_id#\d+, \d+\)", p)


def test_final_rows_of_the_scan_are_not_moved_again(spark, large_plan):
    p = _plan(sessions.gap_session_events(Model(spark, SF).conformed(), 30))
    first = p[:p.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in first and "Exchange hash" not in first
    # the broadcast side holds only keys that cross a range bound
    assert "_ranges" in p and "> 1)" in p


@pytest.mark.parametrize("name", ["dau", "retention", "list_sources", "active_users", "event_mix"])
def test_user_level_marts_need_no_session_scan(spark, large_plan, name):
    p = _plan(catalog.QUERIES[name](spark, SF))
    assert "_pk" not in p and "rangepartitioning(user_id" not in p
    assert _exchanges(p) <= 9


def test_funnel_needs_no_ordered_scan(spark, large_plan, monkeypatch):
    """Sessions and steps from masks: nothing is written, ordered by event, expanded or
    broadcast; a user's window is over active minutes."""
    from eventmarts import session
    from eventmarts.plans import ordered

    def refuse(*_):
        raise AssertionError("a table was written")
    for module in (session, ordered, sessions):
        monkeypatch.setattr(module, "materialize", refuse)
    for name in ("funnel", "funnel_missing_step"):
        p = _plan(catalog.QUERIES[name](spark, SF))
        assert "rangepartitioning" not in p and "Expand" not in p and "BroadcastExchange" not in p
        assert "Join" not in p and _exchanges(p) <= 7
        windows = re.findall(r"Window \[(.*)", p)
        assert all("_minute" in w or "step_number" in w or "_opens" in w for w in windows)
    # a caller's own frame may be of any size: no hint
    facts = Model(spark, SF).fact_rows().withColumn("session_id", F.col("user_id"))
    steps = spark.range(9).selectExpr("'stream' as source", "cast(id as int) as step_number", "'click' as event_type")
    assert "BroadcastExchange" not in _plan(marts.funnel(facts, steps))


def test_scans_read_only_needed_columns(spark):
    m = Model(spark, SF)
    orders = m.table("orders").select("o_custkey", "o_orderdate")
    p = _plan(marts.retention(orders.selectExpr("cast(o_custkey as string) as user_id",
                                                "'orders' as source",
                                                "to_date(o_orderdate) as event_date")))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"o_custkey", "o_orderdate"}


def test_active_user_sweep_has_no_k_fold_expansion(spark, large_plan):
    m = Model(spark, SF)
    per_user_day = r"sequence\(d#\d+, date_add\(d#\d+, \d+\)"
    # the sweep only generates the calendar spine
    assert not re.search(per_user_day, _plan(marts.active_users(m.fact_rows())))
    # the range-join form lists every user-day under the 30 days it counts for
    assert re.search(per_user_day, _plan(marts.active_users(m.fact_rows(), method="range_join")))
