"""Data-quality checks.

Every check is a distributed aggregate that returns a small DataFrame; only
:func:`raise_on_failure` brings a (bounded, few-row) report to the driver.

* Bronze gate Q1-Q5: row count, required fields, event-type vocabulary,
  duplicate ids -- rows ``(check_order, check, passed, failures, detail)``.
* Declarative model tests Q6-Q9 (unique / not_null / accepted_values /
  relationships) and the shipped list of 38 instances.
* Q10 row-count reconciliation, Q11 cart vs purchase, Q12 time order, Q13 funnel
  step order, Q14 record contract.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmarts.plans.ordered import split_lag
from eventmarts.schema import EVENT_TYPES, HISTORICAL, REQUIRED_FIELDS, STREAM

# ---------------------------------------------------------------------------
# Bronze gate (Q1-Q5)
# ---------------------------------------------------------------------------


def invalid_event_types(df: DataFrame, allowed: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """Every event type outside the vocabulary with its rows (``<null>`` for NULL)."""
    return (df.where(~F.col("event_type").isin(list(allowed)) | F.col("event_type").isNull())
            .groupBy(F.coalesce("event_type", F.lit("<null>")).alias("event_type"))
            .agg(F.count(F.lit(1)).alias("rows")))


def bronze_checks(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS,
                  allowed: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """Q1-Q4 as one aggregate over three tagged groupings: per-row counts, event
    types, event ids.  A NULL event type is invalid; repeated NULL ids count as
    duplicates.  The whole set of invalid types is listed with its counts; a
    vocabulary that is off has few of them (``invalid_event_types`` has any number).
    """
    zero = F.lit(0).cast("long")

    def part(frame: DataFrame, **columns) -> DataFrame:
        names = ["n", *[f"null_{c}" for c in required], "bad_rows", "bad_type", "dup"]
        return frame.select(*[columns.get(c, F.lit(None).cast("string") if c == "bad_type" else zero)
                              .alias(c) for c in names])

    counts = df.agg(F.count(F.lit(1)).alias("n"),
                    *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in required])
    types = invalid_event_types(df, allowed)
    copies = (df.groupBy("event_id").agg((F.count(F.lit(1)) - 1).alias("extra"))
              .agg(F.coalesce(F.sum("extra"), zero).alias("dup")))
    tagged = (part(counts, n=F.col("n"), **{f"null_{c}": F.col(f"null_{c}") for c in required})
              .unionByName(part(types, bad_rows=F.col("rows"), bad_type=F.concat(
                  "event_type", F.lit(" ("), F.col("rows").cast("string"), F.lit(")"))))
              .unionByName(part(copies, dup=F.col("dup"))))
    a = tagged.agg(F.sum("n").alias("n"), *[F.sum(f"null_{c}").alias(f"null_{c}") for c in required],
                   F.sum("bad_rows").alias("bad_rows"), F.sum("dup").alias("dup"),
                   F.array_join(F.array_sort(F.collect_list("bad_type")), ", ").alias("bad_types"))

    nulls = [F.col(f"null_{c}") for c in required]
    null_report = F.concat_ws(", ", *[F.when(n > 0, F.concat(F.lit(f"{c}: "), n.cast("string")))
                                      for n, c in zip(nulls, required)])
    first_n = F.coalesce(*[F.when(n > 0, n) for n in nulls], zero)
    rows = [
        (1, "has_rows", F.col("n") > 0, F.when(F.col("n") > 0, 0).otherwise(1),
         F.concat(F.col("n").cast("string"), F.lit(" rows"))),
        (2, "required_fields_present", first_n == 0, first_n, null_report),
        (3, "known_event_types", F.col("bad_rows") == 0, F.col("bad_rows"), F.col("bad_types")),
        (4, "unique_event_ids", F.col("dup") == 0, F.col("dup"),
         F.concat(F.col("dup").cast("string"), F.lit(" repeated ids"))),
    ]
    structs = [F.struct(F.lit(o).cast("int").alias("check_order"), F.lit(n).alias("check"),
                        p.alias("passed"), f.cast("long").alias("failures"), d.alias("detail"))
               for o, n, p, f, d in rows]
    return a.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def raise_on_failure(report: DataFrame) -> None:
    """Q5 gate: raise at the first failing check, in check order.
    The report is a handful of rows, so collecting it is bounded."""
    for r in report.orderBy("check_order").collect():
        if not r["passed"]:
            raise AssertionError(f"{r['check']} failed: {r['detail']}")


# ---------------------------------------------------------------------------
# Declarative tests (Q6-Q9)
# ---------------------------------------------------------------------------

def _result(df: DataFrame, model: str, test: str, column: str, failures) -> DataFrame:
    return df.select(F.lit(model).alias("model"), F.lit(test).alias("test"),
                     F.lit(column).alias("column"),
                     (failures == 0).alias("passed"), failures.cast("long").alias("failures"))


def test_unique(df: DataFrame, column: str, model: str = "") -> DataFrame:
    """Q6: number of non-NULL values that occur more than once."""
    d = (df.where(F.col(column).isNotNull()).groupBy(column).count()
         .agg(F.count(F.when(F.col("count") > 1, 1)).alias("f")))
    return _result(d, model, "unique", column, F.col("f"))


def test_not_null(df: DataFrame, column: str, model: str = "") -> DataFrame:
    """Q7: number of NULL values."""
    d = df.agg(F.count(F.when(F.col(column).isNull(), 1)).alias("f"))
    return _result(d, model, "not_null", column, F.col("f"))


def test_accepted_values(df: DataFrame, column: str, values: Sequence[str],
                         model: str = "") -> DataFrame:
    """Q8: number of distinct non-NULL values outside the list (NULLs pass)."""
    d = df.agg(F.count_distinct(F.when(~F.col(column).isin(list(values)), F.col(column))).alias("f"))
    return _result(d, model, "accepted_values", column, F.col("f"))


def test_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                       model: str = "") -> DataFrame:
    """Q9 (J8): child rows whose non-NULL key has no parent row (anti join)."""
    keys = parent.select(F.col(parent_column).alias("_pk")).distinct()
    orphans = (child.select(F.col(column).alias("_fk")).where(F.col("_fk").isNotNull())
               .join(keys, F.col("_fk") == F.col("_pk"), "left_anti"))
    d = orphans.agg(F.count(F.lit(1)).alias("f"))
    return _result(d, model, "relationships", column, F.col("f"))


_NN = "not_null"
# (model, test, column, argument): 38 instances.
MODEL_TESTS: tuple[tuple[str, str, str, object], ...] = (
    ("stg_events_stream", "unique", "event_id", None),
    ("stg_events_stream", _NN, "event_id", None),
    ("stg_events_stream", _NN, "user_id", None),
    ("stg_events_stream", _NN, "event_timestamp", None),
    ("stg_events_stream", _NN, "event_type", None),
    ("stg_events_stream", "accepted_values", "event_type", EVENT_TYPES),
    ("stg_events_stream", "accepted_values", "source", (STREAM,)),
    ("stg_events_historical", "unique", "event_id", None),
    ("stg_events_historical", _NN, "event_id", None),
    ("stg_events_historical", _NN, "user_id", None),
    ("stg_events_historical", _NN, "event_timestamp", None),
    ("stg_events_historical", _NN, "event_type", None),
    ("stg_events_historical", "accepted_values", "event_type", EVENT_TYPES),
    ("stg_events_historical", "accepted_values", "source", (HISTORICAL,)),
    ("int_events_unioned", "unique", "event_id", None),
    ("int_events_unioned", _NN, "event_id", None),
    ("int_sessions", "unique", "session_id", None),
    ("int_sessions", _NN, "session_id", None),
    ("int_sessionized_events", "unique", "event_id", None),
    ("int_sessionized_events", _NN, "event_id", None),
    ("int_sessionized_events", _NN, "session_id", None),
    ("int_sessionized_events", "relationships", "session_id", ("int_sessions", "session_id")),
    ("dim_date", _NN, "source", None),
    ("dim_date", _NN, "date_day", None),
    ("fct_events", "unique", "event_id", None),
    ("fct_events", _NN, "event_id", None),
    ("fct_events", _NN, "session_id", None),
    ("fct_events", "relationships", "session_id", ("fct_sessions", "session_id")),
    ("fct_sessions", "unique", "session_id", None),
    ("fct_sessions", _NN, "session_id", None),
    ("mart_funnel_analysis", _NN, "source", None),
    ("mart_funnel_analysis", _NN, "step_number", None),
    ("mart_funnel_analysis", _NN, "sessions_reached", None),
    ("mart_dau_wau_mau", _NN, "source", None),
    ("mart_dau_wau_mau", _NN, "date_day", None),
    ("mart_retention", _NN, "source", None),
    ("mart_retention", _NN, "cohort_week", None),
    ("mart_retention", _NN, "retention_rate", None),
)


#: What a test counts over the keys of its group (see :func:`run_model_tests`).
_COUNTS = {
    _NN: lambda own, parent: F.sum(own),
    "accepted_values": lambda own, parent: F.count_if(own > 0),
    "unique": lambda own, parent: F.count_if(own > 1),
    "unique_parent": lambda own, parent: F.count_if(parent > 1),
    "relationships": lambda own, parent: F.sum(F.when(parent == 0, own).otherwise(0)),
}


def run_model_tests(models: Mapping[str, DataFrame],
                    tests: Sequence[tuple[str, str, str, object]] = MODEL_TESTS) -> DataFrame:
    """All declarative tests whose model is given, as one result frame.

    One scan per table and one grouping for all tests.  Every test has a group, and a table
    gives the group the keys it must see: all values for ``unique`` and for both sides of
    ``relationships``, only the missing ones for ``not_null``, only the odd ones for
    ``accepted_values``.  Rows are counted by (group, key) -- as own and as parent rows -- and
    each test is a count over the keys of its group.  Tests of one table under two
    names, and the uniqueness of a parent key, are counted once.
    """
    groups: dict[tuple, int] = {}
    given: dict[int, list[Column]] = {}  # by table: (group, key, own, parent) or NULL
    tables: dict[int, DataFrame] = {}
    listed: list[tuple] = []

    def add(df: DataFrame, group: int, column: str, when: Column, parent: bool = False) -> None:
        tables[id(df)] = df
        given.setdefault(id(df), []).append(F.when(when, F.struct(
            F.lit(group).alias("g"), F.col(column).cast("string").alias("k"),
            F.lit(int(not parent)).alias("own"), F.lit(int(parent)).alias("parent"))))

    chosen = [t for t in tests if t[0] in models]
    # relationships first, so that a unique test can use the group that sees its keys as parent
    for model, test, column, arg in sorted(chosen, key=lambda t: t[1] != "relationships"):
        df, value = models[model], F.col(column)
        if test == "relationships":
            parent, parent_column = models[arg[0]], arg[1]
            key = (id(df), test, column, id(parent), parent_column)
            if key not in groups:
                groups[key] = max(groups.values(), default=-1) + 1
                add(df, groups[key], column, value.isNotNull())
                add(parent, groups[key], parent_column, F.col(parent_column).isNotNull(), parent=True)
                groups.setdefault((id(parent), "unique_parent", parent_column), groups[key])
        elif test == "unique" and (id(df), "unique_parent", column) in groups:
            key = (id(df), "unique_parent", column)
        else:
            key = (id(df), test, column, tuple(arg) if test == "accepted_values" else None)
            if key not in groups:
                groups[key] = max(groups.values(), default=-1) + 1
                if test == _NN:
                    add(df, groups[key], column, value.isNull())
                elif test == "accepted_values":
                    add(df, groups[key], column, ~value.isin(list(arg)))
                elif test == "unique":
                    add(df, groups[key], column, value.isNotNull())
                else:
                    raise ValueError(test)
        listed.append((model, test, column, groups[key], key[1]))

    keys = None
    for i, rows in given.items():
        part = tables[i].select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")
        keys = part if keys is None else keys.unionByName(part)
    counted = keys.groupBy("g", "k").agg(F.sum("own").alias("own"), F.sum("parent").alias("parent"))
    measures = [count(F.col("own"), F.col("parent")).cast("long").alias(name) for name, count in _COUNTS.items()]
    per_group = counted.groupBy("g").agg(*measures)
    found = per_group.agg(F.map_from_entries(F.collect_list(F.struct(
        "g", F.struct(*_COUNTS)))).alias("m"))  # one row per test at most
    order = {(m, t, c): n for n, (m, t, c, _) in enumerate(chosen)}
    cells = []
    for model, test, column, group, measure in sorted(listed, key=lambda x: order[x[:3]]):
        failures = F.coalesce(F.try_element_at("m", F.lit(group))[measure], F.lit(0).cast("long"))
        cells.append(F.struct(F.lit(model).alias("model"), F.lit(test).alias("test"),
                              F.lit(column).alias("column"), (failures == 0).alias("passed"),
                              failures.alias("failures")))
    return found.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


# ---------------------------------------------------------------------------
# Q10-Q14
# ---------------------------------------------------------------------------


def reconcile_counts(stg_stream: DataFrame, stg_historical: DataFrame,
                     fct_events: DataFrame) -> DataFrame:
    """Q10: staged stream + staged historical rows = event-fact rows."""
    tagged = (stg_stream.select(F.lit(1).alias("_t"))
              .unionByName(stg_historical.select(F.lit(2).alias("_t")))
              .unionByName(fct_events.select(F.lit(3).alias("_t"))))
    return (tagged.agg(*[F.count(F.when(F.col("_t") == i, 1)).alias(n) for i, n in
                         ((1, "stream_rows"), (2, "historical_rows"), (3, "fact_rows"))])
            .withColumn("passed", F.col("stream_rows") + F.col("historical_rows") == F.col("fact_rows")))


def cart_reconciliation(cart: DataFrame, purchase: DataFrame, arrival: str = "event_id") -> DataFrame:
    """Q11: for each session with a purchase, its first purchase's total and item
    count equal the session's cart contents (total rounded to 2 places).
    Both sides are aggregated per session before the join (partial aggregates)."""
    c = (cart.groupBy("session_id")
         # exact decimals: a sum of doubles depends on the order of the tasks
         .agg(F.sum(F.col("price").cast("decimal(18,4)") * F.col("quantity")).alias("cart_total"),
              F.sum("quantity").cast("long").alias("cart_items")))
    first = F.struct("event_id", "total_amount", "item_count")
    p = (purchase.groupBy("session_id")
         .agg(F.min_by(first, F.col(arrival)).alias("p"))
         .select("session_id", F.col("p.event_id").alias("purchase_event_id"),
                 F.col("p.total_amount").alias("total_amount"),
                 F.col("p.item_count").cast("long").alias("item_count")))
    j = p.join(c, "session_id", "left")
    total = F.round(F.col("cart_total"), 2).cast("decimal(18,2)")
    j = j.withColumn("cart_total", total.cast("double"))
    ok = (F.coalesce(total, F.lit(0).cast("decimal(18,2)"))
          == F.round(F.col("total_amount").cast("decimal(18,4)"), 2).cast("decimal(18,2)")) & (
        F.coalesce(F.col("cart_items"), F.lit(0)) == F.col("item_count"))
    return j.select("session_id", "purchase_event_id", "total_amount", "item_count",
                    "cart_total", "cart_items", F.coalesce(ok, F.lit(False)).alias("passed"))


def _per_session_violations(flagged: DataFrame, name: str) -> DataFrame:
    return (flagged.groupBy("session_id")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.sum(F.col("_bad").cast("long")).alias(name))
            .withColumn("passed", F.col(name) == 0))


def session_time_order(events: DataFrame, arrival: str) -> DataFrame:
    """Q12: per session, events whose timestamp is earlier than the previous
    event's in arrival order (split lag, so a huge session is not one task)."""
    e = split_lag(events.select("session_id", arrival, "event_timestamp"), ["session_id"],
                  [arrival], "event_timestamp", "_prev")
    return _per_session_violations(
        e.withColumn("_bad", F.coalesce(F.col("event_timestamp") < F.col("_prev"), F.lit(False))),
        "out_of_order")


# Fixed value: funnel positions of the stream state machine.
FUNNEL_ORDER = ("page_view", "click", "add_to_cart", "purchase")


def session_step_order(events: DataFrame, arrival: str) -> DataFrame:
    """Q13: per session, funnel steps (signup excluded) never go back in
    arrival order, and a session with a signup starts with it."""
    idx = F.create_map(*[F.lit(x) for i, t in enumerate(FUNNEL_ORDER) for x in (t, i)])
    steps = (events.where(F.col("event_type") != "signup")
             .select("session_id", arrival, idx[F.col("event_type")].alias("_step")))
    e = split_lag(steps, ["session_id"], [arrival], "_step", "_prev")
    back = (e.withColumn("_bad", F.coalesce(F.col("_step") < F.col("_prev"), F.lit(False)))
            .groupBy("session_id").agg(F.sum(F.col("_bad").cast("long")).alias("steps_back")))
    sign = (events.groupBy("session_id")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.count(F.when(F.col("event_type") == "signup", 1)).alias("_signups"),
                 F.min_by("event_type", F.col(arrival)).alias("_first")))
    j = sign.join(back, "session_id", "left")
    signup_ok = (F.col("_signups") == 0) | (F.col("_first") == "signup")
    return j.select("session_id", "events",
                    F.coalesce(F.col("steps_back"), F.lit(0)).alias("steps_back"),
                    signup_ok.alias("signup_first"),
                    (signup_ok & (F.coalesce(F.col("steps_back"), F.lit(0)) == 0)).alias("passed"))


# Fixed value: keys every event record must carry.
CONTRACT_KEYS = ("event_id", "user_id", "session_id", "event_type", "event_timestamp",
                 "event_properties")


def contract_check(lines: DataFrame, value: str = "value") -> DataFrame:
    """Q14: raw event JSON lines carry every contract key, a JSON object as
    ``event_properties`` and a known event type.  One summary row."""
    keys = F.json_object_keys(F.col(value))
    missing = F.exists(F.array(*[F.lit(k) for k in CONTRACT_KEYS]),
                       lambda k: ~F.coalesce(F.array_contains(keys, k), F.lit(False)))
    props_obj = F.json_object_keys(F.get_json_object(F.col(value), "$.event_properties")).isNotNull()
    et = F.get_json_object(F.col(value), "$.event_type")
    bad_type = ~F.coalesce(et.isin(list(EVENT_TYPES)), F.lit(False))
    return (lines.agg(F.count(F.lit(1)).alias("lines"),
                      F.count(F.when(missing, 1)).alias("missing_keys"),
                      F.count(F.when(~props_obj, 1)).alias("properties_not_object"),
                      F.count(F.when(bad_type, 1)).alias("invalid_event_type"))
            .withColumn("passed", (F.col("missing_keys") + F.col("properties_not_object")
                                   + F.col("invalid_event_type")) == 0))
