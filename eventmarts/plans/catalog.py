"""Query catalogue: name -> (Spark callable, DuckDB oracle SQL or None).

Every query reads the driver's whole tables through the binding; nothing is
sampled or capped.  Output timestamps are emitted as TIMESTAMP_NTZ (UTC wall
time) so that both engines report a naive timestamp.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmarts.operators import active_bitmaps, historical, marts, quality, reports, sessions, staging
from eventmarts.plans import oracle as O
from eventmarts.plans import pipeline
from eventmarts.plans.build import Model
from eventmarts.plans.incremental import SessionStore
from eventmarts.session import materialize, shared_dir
from eventmarts.sinks.bronze import count_files, keyed_records, record_json, write_mart
from eventmarts.sources import binding
from eventmarts.sources.bronze import (
    load_bronze_events,
    read_historical_bronze,
    read_mart,
    read_stream_bronze,
)
from eventmarts.sources.raw import read_event_stream
from eventmarts.streaming import batches
from eventmarts.streaming import ingest as stream_ingest
from eventmarts.streaming.sessions import stream_gap_sessions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def naive_ts(df: DataFrame) -> DataFrame:
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: naive_ts(fn(Model(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


STG_STREAM_COLS = (O.C12 + ", _ingested_dt, _ingested_hour")
STG_HIST_COLS = (O.C12 + ", _ingested_dt")

# --- staging / conform ------------------------------------------------------


@query("stage_stream", O.with_base(f"SELECT {STG_STREAM_COLS} FROM stg_stream"))
def q_stage_stream(m: Model):
    return m.stg_stream()


@query("stage_historical", O.with_base(f"SELECT {STG_HIST_COLS} FROM stg_hist"))
def q_stage_historical(m: Model):
    return m.stg_historical()


@query("conform_union", O.with_base("SELECT * FROM conformed"))
def q_conform(m: Model):
    return m.conformed()


# --- historical transform ---------------------------------------------------

HIST_BRONZE_SQL = O.with_base("""
SELECT event_id, user_id, session_id, event_type,
       strftime(hts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_timestamp,
       '{"item_id":"' || CAST(itemid AS VARCHAR) || '"'
         || CASE WHEN transactionid IS NOT NULL
                 THEN ',"transaction_id":"' || CAST(transactionid AS VARCHAR) || '"' ELSE '' END
         || '}' AS event_properties,
       source, strftime(hts, '%Y-%m-%d') AS dt
FROM stg_hist""")


@query("historical_transform", HIST_BRONZE_SQL)
def q_hist_transform(m: Model):
    return m.historical_bronze()


@query("historical_event_id", O.with_base(f"""
SELECT visitorid, "timestamp", event, itemid, {O.UUID5} AS event_id
FROM (SELECT *, sha1(unhex('{O.NS_HEX}') || encode({O.KEY_TEXT})) AS h FROM raw)"""))
def q_hist_event_id(m: Model):
    raw = m.raw_csv()
    return raw.select("visitorid", "timestamp", "event", "itemid",
                      historical.historical_event_id().alias("event_id"))


@query("dedup_natural_key", O.with_base("""
, replayed AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE event = 'view')
SELECT visitorid, "timestamp", event, itemid, transactionid
FROM (SELECT *, row_number() OVER (PARTITION BY visitorid, "timestamp", event, itemid
                                   ORDER BY transactionid NULLS LAST) AS rn
      FROM replayed) WHERE rn = 1"""))
def q_dedup(m: Model):
    return historical.dedup_natural_key(binding.replayed_raw_csv(m.table("events")))


# --- sessions ---------------------------------------------------------------

SESS_COLS = "session_id, user_id, source, session_start_at, session_end_at, event_count"


@query("sessions_native", O.with_model(f"SELECT {SESS_COLS} FROM s_sessions"))
def q_sessions_native(m: Model):
    return sessions.native_sessions(m.conformed())


@query("sessions_gap_30", O.with_model(f"SELECT {SESS_COLS} FROM h_sessions", 30))
def q_sessions_gap_30(m: Model):
    return sessions.gap_sessions(m.conformed(), 30)


@query("sessions_gap_360", O.with_model(f"SELECT {SESS_COLS} FROM h_sessions", 360))
def q_sessions_gap_360(m: Model):
    return sessions.gap_sessions(m.conformed(), 360)


@query("sessions", O.with_model(f"SELECT {SESS_COLS} FROM int_sessions"))
def q_sessions(m: Model):
    return m.sessions()


SESSIONIZED_SQL = O.with_model("SELECT * FROM fct_events")


@query("sessionize_window", SESSIONIZED_SQL)
def q_sessionize_window(m: Model):
    return marts.event_fact(m.sessionized())


@query("sessionize_gap_360", O.with_model("SELECT * FROM fct_events", 360))
def q_sessionize_360(m: Model):
    return marts.event_fact(sessions.sessionize(m.conformed(), 360))


@query("sessionize_interval_join", SESSIONIZED_SQL)
def q_sessionize_interval(m: Model):
    return marts.event_fact(sessions.sessionize_interval_join(m.conformed(), m.gap))


@query("sessionize_interval_join_month", O.with_model("SELECT * FROM fct_events", 43_200))
def q_sessionize_interval_month(m: Model):
    """Sessions that last for weeks: the join's work does not grow with their length."""
    return marts.event_fact(sessions.sessionize_interval_join(m.conformed(), 43_200))


def _flushed(m: Model) -> SessionStore:
    """The session store after three flushes: days up to the middle one, later days, and
    events of all days that were held back (every tenth), some between two sessions."""
    events = materialize(m.conformed(), "conformed")
    span = events.agg(F.min("event_date").alias("a"), F.max("event_date").alias("b")).first()
    late = F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0
    early = F.col("event_date") <= F.lit(span["a"] + (span["b"] - span["a"]) / 2)
    store = SessionStore(m.spark, shared_dir(m.spark, "session_store"), m.gap)
    for part in (events.where(~late & early), events.where(~late & ~early), events.where(late)):
        store.flush(part)
    return store


@query("sessionize_incremental", SESSIONIZED_SQL)
def q_sessionize_incremental(m: Model):
    return _flushed(m).events()


@query("sessions_incremental", O.with_model(f"SELECT {SESS_COLS} FROM int_sessions"))
def q_sessions_incremental(m: Model):
    return _flushed(m).sessions()


# --- core marts -------------------------------------------------------------


@query("event_fact", SESSIONIZED_SQL)
def q_event_fact(m: Model):
    return m.fct_events()


@query("session_fact", O.with_model("SELECT * FROM fct_sessions"))
def q_session_fact(m: Model):
    return m.fct_sessions()


@query("date_spine", O.with_model("SELECT * FROM dim_date"))
def q_date_spine(m: Model):
    return m.dim_date()


# --- product marts ----------------------------------------------------------


@query("funnel", O.funnel_sql())
def q_funnel(m: Model):
    return marts.funnel_of_events(m.conformed(), m.gap)


@query("funnel_of_fact", O.funnel_sql())
def q_funnel_of_fact(m: Model):
    """The same funnel from the written event fact."""
    return marts.funnel(materialize(m.fct_events(), "fct_events"))


MISSING_STEPS = (
    ("stream", 1, "page_view"), ("stream", 2, "signup"), ("stream", 3, "refund"),
    ("stream", 4, "purchase"), ("batch_historical", 1, "signup"),
    ("batch_historical", 2, "page_view"), ("batch_historical", 3, "purchase"),
)
MISSING_STEPS_SQL = """funnel_steps AS (
  SELECT * FROM (VALUES
    ('stream', 1, 'page_view'), ('stream', 2, 'signup'), ('stream', 3, 'refund'),
    ('stream', 4, 'purchase'), ('batch_historical', 1, 'signup'),
    ('batch_historical', 2, 'page_view'), ('batch_historical', 3, 'purchase'))
    AS t(source, step_number, event_type))"""


@query("funnel_missing_step", O.funnel_sql(MISSING_STEPS_SQL))
def q_funnel_missing(m: Model):
    return marts.funnel_of_events(m.conformed(), m.gap, MISSING_STEPS)


@query("dau", O.active_sql("dau"))
def q_dau(m: Model):
    return marts.dau(m.fact_rows())


@query("wau", O.active_sql("wau"))
def q_wau(m: Model):
    return marts.trailing_active(m.fact_rows(), m.dim_date(), 7, "wau")


@query("mau", O.active_sql("mau"))
def q_mau(m: Model):
    return marts.trailing_active(m.fact_rows(), m.dim_date(), 30, "mau")


@query("active_users", O.active_sql("all"))
def q_active_users(m: Model):
    return marts.active_users(m.fact_rows(), m.dim_date())


@query("active_users_range_join", O.active_sql("all"))
def q_active_users_rj(m: Model):
    return marts.active_users(m.fact_rows(), m.dim_date(), method="range_join")


@query("active_users_bitmaps", O.active_sql("all"))
def q_active_users_bitmaps(m: Model):
    return active_bitmaps.active_users(m.fact_rows(), m.dim_date())


@query("active_users_bitmap_store", O.active_sql("all"))
def q_active_users_bitmap_store(m: Model):
    """Day bitmaps that grow by flushes, the later of which hold new and late events."""
    store = active_bitmaps.ActiveUsers(m.spark, shared_dir(m.spark, "active_users"))
    rows = materialize(m.conformed().select("source", "user_id", "event_date", "event_id"), "conformed")
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for k in range(3):
        store.flush(rows.where(part == k))
    return store.active_users()


FCT_UE = O.FCT_UE


@query("cohort_sizes", O.with_model(O.retention_sql(FCT_UE) + "SELECT * FROM cohort_sizes"))
def q_cohort_sizes(m: Model):
    return marts.cohort_sizes(m.fact_rows())


@query("retention", O.with_model(O.retention_sql(FCT_UE) + "SELECT * FROM mart_retention"))
def q_retention(m: Model):
    return marts.retention(m.fact_rows())


ORDERS_UE = ("SELECT CAST(o_custkey AS VARCHAR) AS user_id, 'orders' AS source, "
             "CAST(o_orderdate AS DATE) AS event_date FROM orders")


def _orders(m: Model) -> DataFrame:
    return m.table("orders").select(
        F.col("o_custkey").cast("string").alias("user_id"), F.lit("orders").alias("source"),
        F.to_date("o_orderdate").alias("event_date"))


@query("retention_orders",
       "WITH _x AS (SELECT 1)" + O.retention_sql(ORDERS_UE) + "SELECT * FROM mart_retention")
def q_retention_orders(m: Model):
    return marts.retention(_orders(m))


# --- reports ----------------------------------------------------------------


@query("list_sources", O.with_model("SELECT DISTINCT source FROM fct_events"))
def q_list_sources(m: Model):
    return reports.list_sources(m.fact_rows())


@query("overview_kpis", O.with_model("""
, ek AS (SELECT source, CAST(count(*) AS BIGINT) AS total_events, min(event_date) AS min_date,
                max(event_date) AS max_date FROM fct_events GROUP BY source),
  sk AS (SELECT source, CAST(count(*) AS BIGINT) AS total_sessions FROM fct_sessions GROUP BY source)
SELECT ek.source, ek.total_events, sk.total_sessions, ek.min_date, ek.max_date
FROM ek JOIN sk ON ek.source = sk.source"""))
def q_overview_kpis(m: Model):
    return reports.overview_kpis(m.fact_rows(), m.sessions())


@query("overview_kpis_stream", O.with_base("""
SELECT 'stream' AS source, CAST(count(*) AS BIGINT) AS total_events,
       CAST(count(DISTINCT (session_id, user_id)) AS BIGINT) AS total_sessions,
       min(event_date) AS min_date, max(event_date) AS max_date
FROM conformed WHERE source = 'stream'"""))
def q_overview_kpis_stream(m: Model):
    return reports.overview_kpis(m.fact_rows(), m.sessions(), "stream")


MIX_SQL = """SELECT *, row_number() OVER (PARTITION BY source ORDER BY event_count DESC, event_type)
  AS position
FROM (SELECT source, event_type, CAST(count(*) AS BIGINT) AS event_count
      FROM fct_events GROUP BY source, event_type)"""


@query("event_mix", O.with_model(MIX_SQL))
def q_event_mix(m: Model):
    return reports.event_mix(m.fact_rows())


@query("event_mix_hist", O.with_model(MIX_SQL + " WHERE source = 'batch_historical'"))
def q_event_mix_hist(m: Model):
    return reports.event_mix(m.fact_rows(), "batch_historical")


MATRIX_WEEKS = (0, 1, 2, 3, 4)


@query("retention_matrix", O.with_model(O.retention_sql(FCT_UE) + "SELECT source, cohort_week, "
       + ", ".join(f"max(CASE WHEN weeks_since_cohort = {w} THEN retention_rate END) AS w{w}"
                   for w in MATRIX_WEEKS)
       + " FROM mart_retention GROUP BY source, cohort_week"))
def q_retention_matrix(m: Model):
    # refuses the list if the mart has a later week
    return reports.retention_matrix(marts.retention(m.fact_rows()), MATRIX_WEEKS)


@query("retention_matrix_orders", "WITH _x AS (SELECT 1)" + O.retention_sql(ORDERS_UE) + """
SELECT source, cohort_week, 'w' || weeks_since_cohort AS week, retention_rate,
       weeks_since_cohort = (SELECT max(weeks_since_cohort) FROM mart_retention) AS is_last
FROM mart_retention""")
def q_retention_matrix_orders(m: Model):
    """The matrix over all weeks of ``orders``, its cells listed again."""
    matrix = reports.retention_matrix(marts.retention(_orders(m)))
    weeks = matrix.columns[2:]
    return (matrix.unpivot(["source", "cohort_week"], weeks, "week", "retention_rate")
            .where(F.col("retention_rate").isNotNull())
            .withColumn("is_last", F.col("week") == weeks[-1]))


# --- ordered serving reads (the position makes the order visible) -------------


@query("read_funnel", O.with_model(O.funnel_ctes() + "SELECT *, row_number() OVER (PARTITION BY source "
                                   "ORDER BY step_number) AS position FROM mart_funnel"))
def q_read_funnel(m: Model):
    return reports.read_funnel(marts.funnel_of_events(m.conformed(), m.gap))


@query("read_active_users", O.with_model(O.ACTIVE_CTES + "SELECT *, row_number() OVER (PARTITION BY source "
                                         "ORDER BY date_day) AS position FROM au WHERE source = 'stream'"))
def q_read_active_users(m: Model):
    return reports.read_active_users(marts.active_users(m.fact_rows(), m.dim_date()), "stream")


@query("read_retention", "WITH _x AS (SELECT 1)" + O.retention_sql(ORDERS_UE) + """
SELECT *, row_number() OVER (PARTITION BY source ORDER BY cohort_week, weeks_since_cohort) AS position
FROM mart_retention""")
def q_read_retention(m: Model):
    return reports.read_retention(marts.retention(_orders(m)))


# --- missing users and days -----------------------------------------------------


def _gappy(m: Model) -> DataFrame:
    """The whole events table with some users and some days missing (as ``O.GAPPY``)."""
    e = F.col("event_id")
    return m.table("events").select(
        F.when(e % 3 == 0, "a").otherwise("b").alias("source"),
        F.when(e % 7 > 0, F.col("user_id").cast("string")).alias("user_id"),
        F.when(e % 11 > 0, F.to_date("ts")).alias("event_date"))


GAPPY_ACTIVE = O.GAPPY + """
SELECT d.source, d.date_day,
  (SELECT count(DISTINCT user_id) FROM gappy g WHERE g.source = d.source
     AND g.event_date = d.date_day) AS dau,
  (SELECT count(DISTINCT user_id) FROM gappy g WHERE g.source = d.source
     AND g.event_date <= d.date_day AND g.event_date > d.date_day - 7) AS wau,
  (SELECT count(DISTINCT user_id) FROM gappy g WHERE g.source = d.source
     AND g.event_date <= d.date_day AND g.event_date > d.date_day - 30) AS mau
FROM days d"""


@query("active_users_nulls", GAPPY_ACTIVE)
def q_active_users_nulls(m: Model):
    return marts.active_users(_gappy(m))


@query("active_users_range_join_nulls", GAPPY_ACTIVE)
def q_active_users_rj_nulls(m: Model):
    return marts.active_users(_gappy(m), method="range_join")


@query("active_users_bitmaps_nulls", GAPPY_ACTIVE)
def q_active_users_bitmaps_nulls(m: Model):
    return active_bitmaps.active_users(_gappy(m), marts.date_spine(_gappy(m)))


GAPPY_UE = "SELECT user_id, source, event_date FROM gappy"


@query("retention_nulls", O.GAPPY + O.retention_sql(GAPPY_UE) + "SELECT * FROM mart_retention")
def q_retention_nulls(m: Model):
    return marts.retention(_gappy(m))


@query("cohort_sizes_nulls", O.GAPPY + O.retention_sql(GAPPY_UE) + "SELECT * FROM cohort_sizes")
def q_cohort_sizes_nulls(m: Model):
    return marts.cohort_sizes(_gappy(m))


# --- quality ----------------------------------------------------------------

DIRTY_CTES = """WITH """ + O.EV + """,
d AS (
  SELECT CAST(eid AS VARCHAR) AS event_id,
         CASE WHEN et = 'purchase' THEN NULL ELSE CAST(uid AS VARCHAR) END AS user_id,
         et AS event_type, ts AS event_timestamp
  FROM (SELECT *, CASE et0 WHEN 'view' THEN 'page_view' WHEN 'error' THEN 'error_event'
                  ELSE et0 END AS et FROM ev)),
checked AS (SELECT * FROM d UNION ALL SELECT * FROM d WHERE event_type = 'signup'),
odd AS (SELECT event_type, CAST(count(*) AS BIGINT) AS rows FROM checked
        WHERE event_type NOT IN ('page_view', 'click', 'add_to_cart', 'signup', 'purchase')
        GROUP BY event_type)"""

REPORT_SQL = """
SELECT 1 AS check_order, 'has_rows' AS "check", count(*) > 0 AS passed,
       CAST(count(*) = 0 AS BIGINT) AS failures, count(*) || ' rows' AS detail FROM checked
UNION ALL
SELECT 2, 'required_fields_present', n = 0, n, CASE WHEN n = 0 THEN '' ELSE 'user_id: ' || n END
FROM (SELECT CAST(count(*) - count(user_id) AS BIGINT) AS n FROM checked)
UNION ALL
SELECT 3, 'known_event_types', count(*) = 0, CAST(coalesce(sum(rows), 0) AS BIGINT),
       coalesce(string_agg(event_type || ' (' || rows || ')', ', ' ORDER BY event_type), '') FROM odd
UNION ALL
SELECT 4, 'unique_event_ids', n = 0, n, n || ' repeated ids'
FROM (SELECT CAST(count(*) - count(DISTINCT event_id) AS BIGINT) AS n FROM checked)"""

HIST_CHECKED = """
, checked AS (SELECT event_id, user_id, event_type FROM stg_hist),
odd AS (SELECT event_type, CAST(count(*) AS BIGINT) AS rows FROM checked
        WHERE event_type NOT IN ('page_view', 'click', 'add_to_cart', 'signup', 'purchase')
        GROUP BY event_type)"""


@query("quality_report", DIRTY_CTES + REPORT_SQL)
def q_quality_report(m: Model):
    return quality.bronze_checks(binding.dirty_stream_bronze(m.table("events")))


@query("invalid_event_types", DIRTY_CTES + "SELECT * FROM odd")
def q_invalid_event_types(m: Model):
    return quality.invalid_event_types(binding.dirty_stream_bronze(m.table("events")))


@query("gate_message", DIRTY_CTES + """
SELECT 'required_fields_present failed: user_id: ' || (count(*) - count(user_id)) AS message
FROM checked""")
def q_gate_message(m: Model):
    """The raising gate: what it says of the first check that fails."""
    try:
        quality.raise_on_failure(quality.bronze_checks(binding.dirty_stream_bronze(m.table("events"))))
        said = "passed"
    except AssertionError as e:
        said = str(e)
    return m.spark.createDataFrame([(said,)], "message string")


@query("quality_report_clean", O.with_base(HIST_CHECKED + REPORT_SQL))
def q_quality_report_clean(m: Model):
    return quality.bronze_checks(m.historical_bronze())


def _mart_models(m: Model) -> dict[str, DataFrame]:
    """All models for the declarative tests.  The staged tables and the event fact are
    written once, so each test scans the columns it needs."""
    stg_s = materialize(m.stg_stream(), "stg_stream")
    stg_h = materialize(m.stg_historical(), "stg_historical")
    unioned = staging.conform(stg_s, stg_h)
    fct = materialize(marts.event_fact(sessions.sessionize(unioned, m.gap)), "fct_events")
    sess = materialize(marts.session_fact(marts.sessions_from_fact(fct)), "fct_sessions")
    spine = marts.date_spine(unioned)
    return {
        "stg_events_stream": stg_s, "stg_events_historical": stg_h,
        "int_events_unioned": unioned, "int_sessions": sess,
        "int_sessionized_events": fct, "fct_events": fct, "fct_sessions": sess,
        "dim_date": spine, "mart_funnel_analysis": marts.funnel(fct),
        "mart_dau_wau_mau": marts.active_users(fct, spine), "mart_retention": marts.retention(fct),
    }


_CTE_OF = {
    "stg_events_stream": "stg_stream", "stg_events_historical": "stg_hist",
    "int_events_unioned": "conformed", "int_sessions": "int_sessions",
    "int_sessionized_events": "fct_events", "fct_events": "fct_events",
    "fct_sessions": "fct_sessions", "dim_date": "dim_date",
    "mart_funnel_analysis": "mart_funnel", "mart_dau_wau_mau": "au",
    "mart_retention": "mart_retention",
}


def _test_sql(model: str, test: str, col: str, arg) -> str:
    t = _CTE_OF[model]
    if test == "unique":
        f = (f"(SELECT count(*) FROM (SELECT {col} FROM {t} WHERE {col} IS NOT NULL "
             f"GROUP BY {col} HAVING count(*) > 1))")
    elif test == "not_null":
        f = f"(SELECT count(*) FROM {t} WHERE {col} IS NULL)"
    elif test == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in arg)
        f = f"(SELECT count(DISTINCT {col}) FROM {t} WHERE {col} NOT IN ({vals}))"
    else:
        p, pc = arg
        f = (f"(SELECT count(*) FROM {t} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {_CTE_OF[p]} p WHERE p.{pc} = c.{col}))")
    return (f"SELECT '{model}' AS model, '{test}' AS test, '{col}' AS \"column\", "
            f"{f} = 0 AS passed, CAST({f} AS BIGINT) AS failures")


@query("model_tests", O.all_marts("\n UNION ALL ".join(_test_sql(*t) for t in quality.MODEL_TESTS)))
def q_model_tests(m: Model):
    return quality.run_model_tests(_mart_models(m))


# Four ways to break the staged stream: a repeated id, a lost user, an unknown type, a
# session row without events.
DIRTY_TESTS = (
    ("stg_events_stream", "unique", "event_id", None),
    ("stg_events_stream", "not_null", "user_id", None),
    ("stg_events_stream", "accepted_values", "event_type",
     ("page_view", "click", "add_to_cart", "signup", "purchase")),
    ("fct_events", "relationships", "session_id", ("fct_sessions", "session_id")),
)


@query("model_tests_dirty", "WITH " + ",\n".join([O.EV, O.STG_STREAM]) + """,
t AS (SELECT CASE WHEN eid % 5 = 0 THEN 'same' ELSE event_id END AS event_id,
             CASE WHEN eid % 7 > 0 THEN user_id END AS user_id,
             CASE WHEN eid % 9 = 0 THEN 'odd' || (eid % 2) ELSE event_type END AS event_type,
             session_id, eid
      FROM stg_stream),
r(model, test, "column", failures) AS (
  SELECT 'stg_events_stream', 'unique', 'event_id',
         (SELECT count(*) FROM (SELECT event_id FROM t GROUP BY event_id HAVING count(*) > 1))
  UNION ALL SELECT 'stg_events_stream', 'not_null', 'user_id', (SELECT count(*) FROM t WHERE user_id IS NULL)
  UNION ALL SELECT 'stg_events_stream', 'accepted_values', 'event_type',
         (SELECT count(DISTINCT event_type) FROM t WHERE event_type LIKE 'odd%')
  UNION ALL SELECT 'fct_events', 'relationships', 'session_id',
         (SELECT count(*) FROM t WHERE session_id NOT IN (SELECT session_id FROM t WHERE eid % 3 = 0)))
SELECT model, test, "column", failures = 0 AS passed, CAST(failures AS BIGINT) AS failures FROM r""")
def q_model_tests_dirty(m: Model):
    e = F.col("event_id").cast("long")
    s = materialize(m.stg_stream(), "stg_stream")
    broken = s.select(
        F.when(e % 5 == 0, "same").otherwise(F.col("event_id")).alias("event_id"),
        F.when(e % 7 > 0, F.col("user_id")).alias("user_id"),
        F.when(e % 9 == 0, F.concat(F.lit("odd"), (e % 2).cast("string")))
        .otherwise(F.col("event_type")).alias("event_type"), "session_id")
    models = {"stg_events_stream": broken, "fct_events": s,
              "fct_sessions": s.where(e % 3 == 0).select("session_id")}
    return quality.run_model_tests(models, DIRTY_TESTS)


@query("reconcile_counts", O.with_model("""
SELECT (SELECT count(*) FROM stg_stream) AS stream_rows,
       (SELECT count(*) FROM stg_hist) AS historical_rows,
       (SELECT count(*) FROM fct_events) AS fact_rows,
       (SELECT count(*) FROM stg_stream) + (SELECT count(*) FROM stg_hist)
         = (SELECT count(*) FROM fct_events) AS passed"""))
def q_reconcile(m: Model):
    return quality.reconcile_counts(m.stg_stream(), m.stg_historical(), m.fct_events())


def _stream_bronze_arrival(m: Model) -> DataFrame:
    return m.stream_bronze().withColumn("arrival", F.col("event_id").cast("long"))


@query("cart_reconciliation", O.with_base("""
, cart AS (SELECT session_id, round(sum(CAST(value AS DECIMAL(18, 4))), 2)::DOUBLE AS cart_total,
                  CAST(count(*) AS BIGINT) AS cart_items
           FROM stg_stream WHERE et = 'add_to_cart' GROUP BY session_id),
  pur AS (SELECT session_id, arg_min(event_id, eid) AS purchase_event_id,
                 arg_min(value, eid) AS total_amount, CAST(1 AS BIGINT) AS item_count
          FROM stg_stream WHERE et = 'purchase' GROUP BY session_id)
SELECT p.session_id, p.purchase_event_id, p.total_amount, p.item_count, c.cart_total, c.cart_items,
       coalesce(coalesce(c.cart_total, 0.0) = p.total_amount
                AND coalesce(c.cart_items, 0) = p.item_count, false) AS passed
FROM pur p LEFT JOIN cart c ON p.session_id = c.session_id"""))
def q_cart(m: Model):
    b = _stream_bronze_arrival(m)
    return quality.cart_reconciliation(staging.cart_items(b), staging.purchases(b, "arrival"), "arrival")


@query("session_time_order", O.with_base("""
, o AS (SELECT session_id, event_timestamp < lag(event_timestamp) OVER (
                 PARTITION BY session_id ORDER BY eid) AS bad FROM stg_stream)
SELECT session_id, CAST(count(*) AS BIGINT) AS events,
       CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS out_of_order,
       sum(CASE WHEN bad THEN 1 ELSE 0 END) = 0 AS passed
FROM o GROUP BY session_id"""))
def q_time_order(m: Model):
    s = m.stg_stream().withColumn("arrival", F.col("event_id").cast("long"))
    return quality.session_time_order(s, "arrival")


@query("session_step_order", O.with_base("""
, st AS (SELECT session_id, eid,
                CASE event_type WHEN 'page_view' THEN 0 WHEN 'click' THEN 1
                     WHEN 'add_to_cart' THEN 2 WHEN 'purchase' THEN 3 END AS step
         FROM stg_stream WHERE event_type <> 'signup'),
  back AS (SELECT session_id, CAST(sum(CASE WHEN step < prev THEN 1 ELSE 0 END) AS BIGINT) AS steps_back
           FROM (SELECT *, lag(step) OVER (PARTITION BY session_id ORDER BY eid) AS prev FROM st)
           GROUP BY session_id),
  sg AS (SELECT session_id, CAST(count(*) AS BIGINT) AS events,
                count(*) FILTER (WHERE event_type = 'signup') AS signups,
                arg_min(event_type, eid) AS first_type
         FROM stg_stream GROUP BY session_id)
SELECT sg.session_id, sg.events, coalesce(back.steps_back, 0) AS steps_back,
       (signups = 0 OR first_type = 'signup') AS signup_first,
       (signups = 0 OR first_type = 'signup') AND coalesce(back.steps_back, 0) = 0 AS passed
FROM sg LEFT JOIN back ON sg.session_id = back.session_id"""))
def q_step_order(m: Model):
    s = m.stg_stream().withColumn("arrival", F.col("event_id").cast("long"))
    return quality.session_step_order(s, "arrival")


@query("contract_check", """WITH """ + O.EV + """
SELECT CAST(count(*) + count(*) FILTER (WHERE et0 = 'signup') AS BIGINT) AS lines,
       CAST(count(*) FILTER (event_id IS NULL) AS BIGINT) AS missing_keys,
       CAST(count(*) FILTER (json_type(props) <> 'OBJECT') AS BIGINT) AS properties_not_object,
       CAST(count(*) FILTER (WHERE et0 = 'error') AS BIGINT) AS invalid_event_type,
       count(*) FILTER (WHERE et0 = 'error') = 0 AS passed
FROM ev JOIN events ON events.event_id = ev.eid""")
def q_contract(m: Model):
    return quality.contract_check(keyed_records(binding.dirty_stream_bronze(m.table("events"))))


# --- ingest round trips -------------------------------------------------------


def _write_stream_tree(m: Model, root: str) -> None:
    b = m.stream_bronze()
    (b.select(record_json(b).alias("value"), F.date_format("dt", "yyyy-MM-dd").alias("dt"),
              F.format_string("%02d", "hour").alias("hour"))
     .write.mode("overwrite").partitionBy("dt", "hour").text(root))


@query("bronze_json_roundtrip", O.with_base(f"SELECT {STG_STREAM_COLS} FROM stg_stream"))
def q_roundtrip(m: Model):
    root = shared_dir(m.spark, "bronze_stream")
    _write_stream_tree(m, root)
    return staging.stage_stream(read_stream_bronze(m.spark, root))


def _write_raw_csv(m: Model, path: str) -> None:
    binding.replayed_raw_csv(m.table("events")).write.option("header", "true").csv(path)


@query("historical_ingest", O.with_base(f"SELECT {STG_HIST_COLS} FROM stg_hist"))
def q_hist_ingest(m: Model):
    csv, out = shared_dir(m.spark, "raw_csv"), shared_dir(m.spark, "bronze_hist")
    _write_raw_csv(m, csv)
    pipeline.ingest_historical(m.spark, csv, out, max_records_per_file=1000)
    return staging.stage_historical(read_historical_bronze(m.spark, out))


def _drain(m: Model, landing: str, out: str, ckpt: str, dedup: str | None = None,
           max_files: int | None = None) -> None:
    stream_ingest.ingest_stream(
        read_event_stream(m.spark, "text", path=landing, max_files_per_trigger=max_files), out, ckpt,
        trigger={"availableNow": True}, dedup_watermark=dedup).awaitTermination()


def _stream_through(m: Model, *deliveries: DataFrame, dedup: str | None = None,
                    max_files: int | None = None) -> str:
    """The bronze tree after the stream has taken each delivery, with a restart between."""
    landing = shared_dir(m.spark, "landing")
    out, ckpt = shared_dir(m.spark, "bronze_stream"), shared_dir(m.spark, "stream_ckpt")
    for lines in deliveries:
        lines.select("value").write.mode("append").text(landing)
        _drain(m, landing, out, ckpt, dedup, max_files)
    return out


def _staged(m: Model, root: str) -> DataFrame:
    return staging.stage_stream(read_stream_bronze(m.spark, root)).select(*O.C12.split(", "))


@query("stream_ingest_bronze", O.with_base(f"SELECT {O.C12} FROM stg_stream"))
def q_stream_ingest(m: Model):
    return _staged(m, _stream_through(m, binding.stream_records(m.table("events"))))


@query("stream_restart", O.with_base(f"SELECT {O.C12} FROM stg_stream"))
def q_stream_restart(m: Model):
    """Two deliveries and a third start without any: nothing lost, nothing twice."""
    recs = binding.stream_records(m.table("events"))
    odd = F.col("arrival") % 2 == 1
    return _staged(m, _stream_through(m, recs.where(odd), recs.where(~odd), recs.where(F.lit(False))))


def _shuffled(recs: DataFrame) -> DataFrame:
    """Several files, each with event times from all over the table."""
    return recs.repartition(4, F.xxhash64("arrival"))


@query("stream_dedup", O.with_base(f"SELECT {O.C12} FROM stg_stream"))
def q_stream_dedup(m: Model):
    """One file per micro-batch, event times in any order, replays in later batches."""
    recs = binding.stream_records(m.table("events"))
    replays = recs.where(F.get_json_object("value", "$.event_type") == "signup")
    return _staged(m, _stream_through(m, _shuffled(recs.unionByName(replays)), _shuffled(replays),
                                      dedup="1 hour", max_files=1))


def _batches(m: Model, landing: str, out: str, ckpt: str, **options) -> None:
    batches.ingest_batches(read_event_stream(m.spark, "text", path=landing), out, ckpt,
                           trigger={"availableNow": True}, **options).awaitTermination()


@query("stream_replays_any_age", O.with_base(f"SELECT {O.C12} FROM stg_stream"))
def q_stream_replays(m: Model):
    """Replays without a watermark: half of the records, then all of them, then everything once
    more under a new checkpoint; each event lands once."""
    recs = binding.stream_records(m.table("events"))
    landing, out, state, *ckpts = (shared_dir(m.spark, d) for d in (
        "landing", "bronze_stream", "landed", "stream_ckpt", "stream_ckpt"))
    for part in (recs.where(F.col("arrival") % 2 == 1), recs):
        part.select("value").write.mode("append").text(landing)
        _batches(m, landing, out, ckpts[0], landed=state)
    _batches(m, landing, out, ckpts[1], landed=state)
    return _staged(m, out)


@query("stream_gate", """
WITH lines AS (SELECT CASE event_type WHEN 'purchase' THEN 'missing_field' WHEN 'error' THEN 'unknown_type'
                   ELSE 'good' END AS verdict, event_type FROM events
            UNION ALL SELECT 'good', event_type FROM events WHERE event_type = 'signup'
            UNION ALL SELECT 'malformed', event_type FROM events WHERE event_type = 'click')
SELECT verdict, CAST(count(*) AS BIGINT) AS lines, CAST(count(*) AS BIGINT) AS counted
FROM lines GROUP BY verdict""")
def q_stream_gate(m: Model):
    """The gate inside the stream over broken records and half lines: what lies under each verdict,
    and what the write itself counted."""
    e = m.table("events")
    b = binding.dirty_stream_bronze(e)
    halves = binding.stream_records(e.where(F.col("event_type") == "click")).select(
        F.substring("value", 1, 20).alias("value"))
    landing, out, ckpt = (shared_dir(m.spark, d) for d in ("landing", "bronze_stream", "stream_ckpt"))
    for part in (b.select(record_json(b).alias("value")), halves):
        part.write.mode("append").text(landing)
        _batches(m, landing, out, ckpt, gated=True)
    good, dead = batches.read_gated(m.spark, out)
    lines = (good.select("verdict").unionByName(dead.select("verdict"))
             .groupBy("verdict").agg(F.count(F.lit(1)).alias("lines")))
    counted = batches.gate_report(m.spark, out).groupBy("verdict").agg(F.sum("lines").alias("counted"))
    return lines.join(counted, "verdict")


@query("stream_sessions", O.with_model(f"SELECT {SESS_COLS} FROM h_sessions", 30))
def q_stream_sessions(m: Model):
    """Sessions closed inside the stream: three deliveries of whole files with a restart between,
    every tenth record one delivery late, then a heartbeat."""
    records = materialize(m.historical_bronze(), "historical_bronze")
    at = F.col("event_timestamp").cast("timestamp")
    lo, hi = records.agg(F.min(at), F.max(at)).first()
    third = (hi - lo) / 3
    due = F.when(at < F.lit(lo + third), 0).when(at < F.lit(lo + 2 * third), 1).otherwise(2)
    late = F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0
    lines = records.select(record_json(records).alias("value"), F.least(
        due + F.when(late, 1).otherwise(0), F.lit(2)).alias("delivery"))
    beat = m.spark.createDataFrame([((hi + 9 * third).isoformat(),)], "event_timestamp string").select(
        F.to_json(F.struct("event_timestamp")).alias("value"))
    landing, out, ckpt = (shared_dir(m.spark, d) for d in ("landing", "stream_sessions", "stream_ckpt"))
    for part in (*[lines.where(F.col("delivery") == k).select("value") for k in range(3)], beat):
        part.write.mode("append").text(landing)
        raw = stream_ingest.parse_records(read_event_stream(m.spark, "text", path=landing))
        rows = stream_gap_sessions(staging.stage_historical(raw), m.gap,
                                   watermark=f"{2 * int(third.total_seconds()) + 60} seconds")
        (rows.writeStream.format("parquet").option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start(out).awaitTermination())
    return m.spark.read.parquet(out).select(*SESS_COLS.split(", "))


@query("stream_dedup_bad_lines", """
SELECT 'no json ' || (event_id % 3) AS value, CAST(count(*) AS BIGINT) AS lines
FROM events WHERE event_type = 'signup' GROUP BY 1""")
def q_stream_bad_lines(m: Model):
    """Lines without an event id pass the replay check, alike or not."""
    e = m.table("events")
    bad = e.where(F.col("event_type") == "signup").select(
        F.concat(F.lit("no json "), (F.col("event_id") % 3).cast("string")).alias("value"),
        F.col("event_id").alias("arrival"))
    root = _stream_through(m, _shuffled(binding.stream_records(e).unionByName(bad)),
                           dedup="1 hour", max_files=2)
    _, lines = read_stream_bronze(m.spark, root, on_bad="quarantine")
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("lines"))


@query("flush_partitions", "SELECT CAST(count(*) AS BIGINT) AS records, true AS flushed_now FROM events")
def q_flush_partitions(m: Model):
    """Records lie under the date and hour at which they were flushed."""
    hour = F.date_trunc("hour", F.current_timestamp())
    before = m.spark.range(1).select(hour.alias("h")).first()["h"]
    root = _stream_through(m, binding.stream_records(m.table("events")))
    flushed = F.to_timestamp(F.concat_ws(" ", F.col("dt").cast("string"),
                                         F.format_string("%02d:00:00", "hour")))
    tree = m.spark.read.text(root)
    return tree.agg(F.count(F.lit(1)).alias("records"),
                    F.every(flushed.between(F.lit(before), hour)).alias("flushed_now"))


@query("bronze_quarantine", """
SELECT 'good' AS kind, CAST(count(*) AS BIGINT) AS lines FROM events
UNION ALL SELECT 'bad', CAST(count(*) AS BIGINT) FROM events WHERE event_type = 'error'""")
def q_quarantine(m: Model):
    """S1 over a tree in which every error event left half a line behind."""
    e = m.table("events")
    recs = binding.stream_records(e)
    halves = binding.stream_records(e.where(F.col("event_type") == "error")).select(
        F.substring("value", 1, 20).alias("value"))
    root = shared_dir(m.spark, "bronze_stream")
    (recs.select("value").unionByName(halves)
     .select("value", F.lit("2024-01-01").alias("dt"), F.lit("00").alias("hour"))
     .write.partitionBy("dt", "hour").text(root))
    good, bad = read_stream_bronze(m.spark, root, on_bad="quarantine")
    kinds = good.select(F.lit("good").alias("kind")).unionByName(bad.select(F.lit("bad").alias("kind")))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("lines"))


@query("ingest_counts", O.with_base("""
, offered AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE event = 'view'),
n AS (SELECT (SELECT count(*) FROM offered WHERE event IN ('view', 'addtocart', 'transaction')) AS r,
             (SELECT count(*) FROM stg_hist) AS w)
SELECT CAST(r AS BIGINT) AS rows_read, CAST(r - w AS BIGINT) AS rows_dropped,
       CAST(w AS BIGINT) AS rows_written, true AS files_counted, true AS again_alike FROM n"""))
def q_ingest_counts(m: Model):
    """What the ingest reports, and that a second run reports the same."""
    csv, out = shared_dir(m.spark, "raw_csv"), shared_dir(m.spark, "bronze_hist")
    _write_raw_csv(m, csv)
    first = pipeline.ingest_historical(m.spark, csv, out, max_records_per_file=500)
    files = count_files(m.spark, out)
    again = pipeline.ingest_historical(m.spark, csv, out, max_records_per_file=500)
    return m.spark.createDataFrame(
        [(first.rows_read, first.rows_dropped, first.rows_written, first.files == files, again == first)],
        "rows_read long, rows_dropped long, rows_written long, files_counted boolean, again_alike boolean")


@query("read_mart", "WITH _x AS (SELECT 1)" + O.retention_sql(ORDERS_UE) + "SELECT * FROM mart_retention")
def q_read_mart(m: Model):
    """A mart as written and as read by path."""
    path = shared_dir(m.spark, "mart")
    write_mart(marts.retention(_orders(m)), path)
    return read_mart(m.spark, path)


def _warehouse(m: Model) -> dict[str, str]:
    sroot, csv = shared_dir(m.spark, "bronze_stream"), shared_dir(m.spark, "raw_csv")
    hroot, wh = shared_dir(m.spark, "bronze_hist"), shared_dir(m.spark, "warehouse")
    _write_stream_tree(m, sroot)
    _write_raw_csv(m, csv)
    pipeline.ingest_historical(m.spark, csv, hroot)
    return pipeline.run_pipeline(m.spark, pipeline.Paths(sroot, hroot, wh), m.gap)


@query("warehouse_dim_date", O.with_model("SELECT * FROM dim_date"))
def q_warehouse_dim_date(m: Model):
    return read_mart(m.spark, _warehouse(m)["dim_date"])


@query("warehouse_funnel", O.funnel_sql())
def q_warehouse_funnel(m: Model):
    return read_mart(m.spark, _warehouse(m)["mart_funnel_analysis"])


@query("serve_funnel_stream", O.funnel_sql().replace(
    "SELECT * FROM mart_funnel", "SELECT * FROM mart_funnel WHERE source = 'stream'"))
def q_serve_funnel(m: Model):
    reports.register_models({"mart_funnel_analysis": marts.funnel_of_events(m.conformed(), m.gap)})
    return reports.serve(m.spark, "mart_funnel_analysis", "stream", ["step_number"])


@query("serve_active_users_hist", O.with_model(
    O.ACTIVE_CTES + "SELECT * FROM au WHERE source = 'batch_historical'"))
def q_serve_active(m: Model):
    reports.register_models({"mart_dau_wau_mau": marts.active_users(m.fact_rows(), m.dim_date())})
    return reports.serve(m.spark, "mart_dau_wau_mau", "batch_historical", ["date_day"])


@query("keyed_records", O.with_base("""
SELECT user_id AS key, event_id, event_type, url, element_id,
       strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_timestamp
FROM stg_stream"""))
def q_keyed_records(m: Model):
    r = keyed_records(m.stream_bronze())
    j = F.col("value")
    return r.select(
        "key",
        F.get_json_object(j, "$.event_id").alias("event_id"),
        F.get_json_object(j, "$.event_type").alias("event_type"),
        F.get_json_object(j, "$.event_properties.url").alias("url"),
        F.get_json_object(j, "$.event_properties.element_id").alias("element_id"),
        F.get_json_object(j, "$.event_timestamp").alias("event_timestamp"))


@query("bronze_gate_ingested", O.with_base(HIST_CHECKED + REPORT_SQL))
def q_gate_ingested(m: Model):
    csv, out = shared_dir(m.spark, "raw_csv"), shared_dir(m.spark, "bronze_hist")
    _write_raw_csv(m, csv)
    pipeline.ingest_historical(m.spark, csv, out, max_records_per_file=2000)
    return quality.bronze_checks(load_bronze_events(m.spark, out))
