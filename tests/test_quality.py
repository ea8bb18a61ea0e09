"""Bronze gate checks on passing and broken frames, declarative tests, Q10-Q14."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventmarts.operators import quality

SCHEMA = "event_id string, user_id string, event_type string, event_timestamp string"
CLEAN = [("k1", "ada", "click", "t"), ("k2", "ben", "signup", "t"), ("k3", "ada", "purchase", "t")]


def _report(spark, rows):
    return {r.check: (r.passed, r.failures, r.detail)
            for r in quality.bronze_checks(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_gate_on_clean_rows(spark):
    assert _report(spark, CLEAN) == {
        "has_rows": (True, 0, "3 rows"), "required_fields_present": (True, 0, ""),
        "known_event_types": (True, 0, ""), "unique_event_ids": (True, 0, "0 repeated ids")}


def test_gate_without_rows(spark):
    r = _report(spark, [])
    assert r["has_rows"] == (False, 1, "0 rows")
    assert all(passed for name, (passed, *_) in r.items() if name != "has_rows")


def test_gate_names_every_fault(spark):
    rows = [*CLEAN, ("k3", None, "refund", None), ("k3", "cyd", "refund", "t"), (None, "cyd", None, "t"),
            (None, "cyd", "wish", "t")]
    assert _report(spark, rows) == {
        "has_rows": (True, 0, "7 rows"),
        "required_fields_present": (False, 2, "event_id: 2, user_id: 1, event_type: 1, event_timestamp: 1"),
        "known_event_types": (False, 4, "<null> (1), refund (2), wish (1)"),
        "unique_event_ids": (False, 3, "3 repeated ids")}
    kinds = quality.invalid_event_types(spark.createDataFrame(rows, SCHEMA))
    assert sorted(tuple(r) for r in kinds.collect()) == [("<null>", 1), ("refund", 2), ("wish", 1)]


def test_gate_raises_at_the_first_fault(spark):
    broken = spark.createDataFrame([*CLEAN, (None, "ada", "wish", "t")], SCHEMA)
    with pytest.raises(AssertionError, match="required_fields_present failed: event_id: 1"):
        quality.raise_on_failure(quality.bronze_checks(broken))
    quality.raise_on_failure(quality.bronze_checks(spark.createDataFrame(CLEAN, SCHEMA)))


def test_declarative_tests(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), ("b", None)], "k string, v string")
    assert quality.test_unique(df, "k").first().failures == 1
    assert quality.test_not_null(df, "k").first().failures == 1
    assert quality.test_accepted_values(df, "v", ["x", "y"]).first().failures == 1  # z; NULL passes
    parent = spark.createDataFrame([("a",)], "k string")
    assert quality.test_relationships(df, "k", parent, "k").first().failures == 1  # b; NULL passes


def test_all_tests_in_one_grouping_equal_the_single_tests(spark):
    a = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), (None, "z", 2), ("b", None, None), ("c", "z", 3)],
                              "k string, v string, n int")
    b = spark.createDataFrame([("a", 2), ("a", 2), (None, 4), ("d", 4)], "k string, n int")
    none = a.limit(0)
    models = {"a": a, "alias": a, "b": b, "none": none}
    tests = [("a", "unique", "k", None), ("alias", "unique", "k", None), ("a", "not_null", "v", None),
             ("a", "accepted_values", "v", ("x", "y")), ("a", "accepted_values", "v", ("x",)),
             ("a", "relationships", "k", ("b", "k")), ("b", "relationships", "n", ("a", "n")), ("a", "relationships", "k", ("a", "k")),
             ("b", "unique", "k", None), ("b", "unique", "n", None), ("a", "unique", "n", None), ("b", "not_null", "k", None),
             ("none", "unique", "k", None), ("none", "relationships", "k", ("b", "k")), ("a", "relationships", "k", ("none", "k")),
             ("none", "not_null", "v", None), ("absent", "not_null", "k", None)]
    got = [(r["model"], r["test"], r["column"], r["passed"], r["failures"])
           for r in quality.run_model_tests(models, tests).collect()]
    want = []
    for model, test, column, arg in tests[:-1]:
        df = models[model]
        one = {"unique": lambda: quality.test_unique(df, column, model),
               "not_null": lambda: quality.test_not_null(df, column, model),
               "accepted_values": lambda: quality.test_accepted_values(df, column, arg, model),
               "relationships": lambda: quality.test_relationships(df, column, models[arg[0]], arg[1], model)}[test]().first()
        want.append((model, test, column, one["passed"], one["failures"]))
    assert sorted(got) == sorted(want) and len(got) == 16


def test_model_tests_scan_a_table_once_and_move_keys_once(spark):
    """Plan of the shipped list over one written fact: a scan per table, one exchange of
    keys, no join and no distinct expansion."""
    a = spark.range(50).selectExpr("cast(id as string) event_id", "cast(id % 9 as string) session_id", "'click' event_type",
                                   "'stream' source", "'u' user_id", "current_timestamp() event_timestamp", "current_date() date_day",
                                   "1 step_number", "1 sessions_reached", "current_date() cohort_week", "1.0 retention_rate")
    s = a.select("session_id").distinct()
    models = {t[0]: s if "sessions" in t[0] and "sessionized" not in t[0] else a for t in quality.MODEL_TESTS}
    out = quality.run_model_tests(models)
    assert out.count() == 38
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Expand" not in plan
    assert plan.count("Range (") == 2 and plan.count("filter(array(") == 2
    assert len([line for line in plan.splitlines() if "Aggregate [g#" in line and "k#" in line]) == 1


def test_cart_and_order_checks(spark):
    cart = spark.createDataFrame([("c1", "s1", 2.5, 2), ("c2", "s1", 1.0, 1)],
                                 "event_id string, session_id string, price double, quantity int")
    pur = spark.createDataFrame([("p1", "s1", 6.0, 3), ("p2", "s2", 1.0, 1)],
                                "event_id string, session_id string, total_amount double, item_count int")
    got = {r.session_id: r.passed for r in quality.cart_reconciliation(cart, pur).collect()}
    assert got == {"s1": True, "s2": False}

    ev = spark.createDataFrame(
        [("s", 1, "signup", "2024-01-01 00:00:00"), ("s", 2, "page_view", "2024-01-01 00:00:01"),
         ("s", 3, "click", "2024-01-01 00:00:02"), ("t", 4, "click", "2024-01-01 00:00:05"),
         ("t", 5, "page_view", "2024-01-01 00:00:03"), ("t", 6, "signup", "2024-01-01 00:00:06")],
        "session_id string, arrival long, event_type string, ts string"
    ).withColumn("event_timestamp", F.col("ts").cast("timestamp"))
    order = {r.session_id: (r.out_of_order, r.passed) for r in quality.session_time_order(ev, "arrival").collect()}
    assert order == {"s": (0, True), "t": (1, False)}
    steps = {r.session_id: (r.steps_back, r.signup_first, r.passed)
             for r in quality.session_step_order(ev, "arrival").collect()}
    assert steps == {"s": (0, True, True), "t": (1, False, False)}


def test_contract(spark):
    lines = spark.createDataFrame([
        ('{"event_id":"1","user_id":"u","session_id":null,"event_type":"click",'
         '"event_timestamp":"t","event_properties":{}}',),
        ('{"event_id":"2","user_id":"u","event_type":"click","event_timestamp":"t",'
         '"event_properties":"x","session_id":"s"}',),
        ('{"event_id":"3","user_id":"u","event_type":"bogus","event_timestamp":"t",'
         '"event_properties":{}}',),
    ], "value string")
    r = quality.contract_check(lines).first()
    assert (r.lines, r.missing_keys, r.properties_not_object, r.invalid_event_type, r.passed) == (
        3, 1, 1, 1, False)


def test_reconcile(spark):
    a = spark.range(3)
    b = spark.range(2)
    assert quality.reconcile_counts(a, b, spark.range(5)).first().passed
    assert not quality.reconcile_counts(a, b, spark.range(4)).first().passed
