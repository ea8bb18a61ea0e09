"""DuckDB SQL for the catalogue queries, written from the specification.

It takes nothing from the library under test and computes by other means: sessions
from the set of their first events, funnels from the event types of each session,
active users from user-days listed under the days they count for, retention from a
window minimum.  Timestamps stay naive UTC; keys append ``+00``.
"""

from __future__ import annotations

# Fixed value: the namespace of the historical event ids.
NS_HEX = "6f1c1f0e2b3a4b8a9c7a8e5f6a1d2c3b"

EV = """ev AS (
  SELECT event_id AS eid, ts, user_id AS uid, event_type AS et0, value,
         json_extract_string(props, '$.k') AS k
  FROM events)"""

STG_STREAM = """stg_stream AS (
  SELECT CAST(eid AS VARCHAR) AS event_id, CAST(uid AS VARCHAR) AS user_id,
         CAST(uid AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
         et AS event_type, date_trunc('millisecond', ts) AS event_timestamp,
         CAST(ts AS DATE) AS event_date,
         CASE WHEN et = 'click' THEN 'e' || k END AS element_id,
         CASE WHEN et = 'page_view' THEN '/p/' || k END AS url,
         CASE WHEN et = 'page_view' THEN 'direct' END AS referrer,
         CAST(NULL AS VARCHAR) AS item_id, CAST(NULL AS VARCHAR) AS transaction_id,
         'stream' AS source, CAST(ts AS DATE) AS _ingested_dt,
         CAST(hour(ts) AS INTEGER) AS _ingested_hour,
         et, eid, value, k
  FROM (SELECT *, CASE et0 WHEN 'view' THEN 'page_view' WHEN 'error' THEN 'add_to_cart'
                  ELSE et0 END AS et FROM ev))"""

RAW = """raw AS (
  SELECT CAST(epoch_us(ts) // 1000 AS BIGINT) AS "timestamp", uid AS visitorid,
         CASE et0 WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction'
              ELSE et0 END AS event,
         CAST(k AS BIGINT) AS itemid,
         CASE WHEN et0 = 'purchase' THEN eid END AS transactionid
  FROM ev)"""

UUID5 = (f"""(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
   || substr('89ab', ((position(substr(h, 17, 1) IN '0123456789abcdef') - 1) % 4) + 1, 1)
   || substr(h, 18, 3) || '-' || substr(h, 21, 12))""")

KEY_TEXT = """(CAST(visitorid AS VARCHAR) || '-' || CAST("timestamp" AS VARCHAR) || '-' || event
   || '-' || CAST(itemid AS VARCHAR))"""

HIST = f"""hist_raw AS (
  SELECT visitorid, "timestamp", event, itemid, min(transactionid) AS transactionid
  FROM raw WHERE event IN ('view', 'addtocart', 'transaction')
  GROUP BY visitorid, "timestamp", event, itemid),
hist_h AS (
  SELECT *, sha1(unhex('{NS_HEX}') || encode({KEY_TEXT})) AS h,
         make_timestamp("timestamp" * 1000) AS hts
  FROM hist_raw),
stg_hist AS (
  SELECT {UUID5} AS event_id, 'hist-' || CAST(visitorid AS VARCHAR) AS user_id,
         CAST(NULL AS VARCHAR) AS session_id,
         CASE event WHEN 'view' THEN 'page_view' WHEN 'addtocart' THEN 'add_to_cart'
              ELSE 'purchase' END AS event_type,
         hts AS event_timestamp, CAST(hts AS DATE) AS event_date,
         CAST(NULL AS VARCHAR) AS element_id, CAST(NULL AS VARCHAR) AS url,
         CAST(NULL AS VARCHAR) AS referrer,
         CAST(itemid AS VARCHAR) AS item_id, CAST(transactionid AS VARCHAR) AS transaction_id,
         'batch_historical' AS source, CAST(hts AS DATE) AS _ingested_dt,
         visitorid, "timestamp", event, itemid, transactionid, hts
  FROM hist_h)"""

C12 = ("event_id, user_id, session_id, event_type, event_timestamp, event_date, "
       "element_id, url, referrer, item_id, transaction_id, source")

CONFORMED = f"""conformed AS (
  SELECT {C12} FROM stg_stream
  UNION ALL
  SELECT {C12} FROM stg_hist)"""


def session_ctes(gap: int) -> str:
    """An event opens a session unless one of its user's earlier events is within the
    gap; every event belongs to the latest opening at or before it."""
    return f"""opening AS (
  SELECT e.user_id AS who, e.event_timestamp AS opened,
         md5(e.user_id || '-' || CAST(e.event_timestamp AS VARCHAR) || '+00') AS sid
  FROM conformed e
  WHERE e.source = 'batch_historical' AND NOT EXISTS (
    SELECT 1 FROM conformed p
    WHERE p.source = 'batch_historical' AND p.user_id = e.user_id
      AND (p.event_timestamp < e.event_timestamp
           OR (p.event_timestamp = e.event_timestamp AND p.event_id < e.event_id))
      AND datediff('minute', p.event_timestamp, e.event_timestamp) <= {gap})),
owned AS (
  SELECT e.* EXCLUDE (session_id), o.sid AS session_id
  FROM (SELECT * FROM conformed WHERE source = 'batch_historical') e
  ASOF JOIN opening o ON e.user_id = o.who AND e.event_timestamp >= o.opened),
placed AS (
  SELECT * FROM conformed WHERE source = 'stream'
  UNION ALL BY NAME SELECT * FROM owned),
session_rows AS (
  SELECT session_id, user_id, source, min(event_timestamp) AS session_start_at,
         max(event_timestamp) AS session_end_at, CAST(count(*) AS BIGINT) AS event_count
  FROM placed GROUP BY ALL),
h_sessions AS (SELECT * FROM session_rows WHERE source = 'batch_historical'),
s_sessions AS (SELECT * FROM session_rows WHERE source = 'stream'),
int_sessions AS (SELECT * FROM session_rows),
fct_events AS (
  SELECT event_id, user_id, session_id,
         CAST(rank() OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS BIGINT)
           AS event_sequence_number,
         event_type, event_timestamp, event_date, element_id, url, referrer, item_id,
         transaction_id, source
  FROM placed),
fct_sessions AS (
  SELECT *, CAST(epoch(date_trunc('second', session_end_at))
                 - epoch(date_trunc('second', session_start_at)) AS BIGINT) AS duration_seconds
  FROM session_rows),
dim_date AS (
  SELECT source, CAST(unnest(range(min(event_date), max(event_date) + 1, INTERVAL 1 DAY)) AS DATE)
           AS date_day
  FROM conformed GROUP BY source)"""


def with_model(body: str, gap: int = 30) -> str:
    """Full CTE chain (binding -> marts) followed by ``body``."""
    return ("WITH " + ",\n".join([EV, STG_STREAM, RAW, HIST, CONFORMED, session_ctes(gap)])
            + "\n" + body)


def with_base(body: str) -> str:
    """Binding + staging CTEs only (cheaper for staging-level queries)."""
    return "WITH " + ",\n".join([EV, STG_STREAM, RAW, HIST, CONFORMED]) + "\n" + body


FUNNEL_STEPS_SQL = """funnel_steps AS (
  SELECT * FROM (VALUES
    ('stream', 1, 'page_view'), ('stream', 2, 'click'), ('stream', 3, 'add_to_cart'),
    ('stream', 4, 'purchase'), ('batch_historical', 1, 'page_view'),
    ('batch_historical', 2, 'add_to_cart'), ('batch_historical', 3, 'purchase'))
    AS t(source, step_number, event_type))"""


def funnel_ctes(steps_cte: str = FUNNEL_STEPS_SQL) -> str:
    """Each session's set of event types, counted per step; neighbours by lookup."""
    return f""", {steps_cte},
kinds AS (
  SELECT source, unnest(list_distinct(list(event_type))) AS kind
  FROM fct_events WHERE session_id IS NOT NULL GROUP BY source, session_id),
hits AS (
  SELECT s.source, s.step_number, s.event_type AS step_name,
         CAST((SELECT count(*) FROM kinds k WHERE k.source = s.source AND k.kind = s.event_type)
              AS BIGINT) AS sessions_reached
  FROM funnel_steps s),
present AS (SELECT * FROM hits WHERE sessions_reached > 0),
mart_funnel AS (
  SELECT p.*,
         round(100.0 * sessions_reached / (
           SELECT arg_min(q.sessions_reached, q.step_number) FROM present q
           WHERE q.source = p.source), 2) AS pct_of_funnel_start,
         round(100.0 * sessions_reached / (
           SELECT arg_max(q.sessions_reached, q.step_number) FROM present q
           WHERE q.source = p.source AND q.step_number < p.step_number), 2) AS pct_of_previous_step
  FROM present p)
"""


def funnel_sql(steps_cte: str = FUNNEL_STEPS_SQL) -> str:
    return with_model(funnel_ctes(steps_cte) + "SELECT * FROM mart_funnel")


def active_ctes(events: str, spine: str) -> str:
    """Users of a day, 7 and 30 days: each user-day is listed under the days it counts
    for with its age there; a user's least age on a day decides."""
    return f""", user_day AS (
  SELECT DISTINCT source, user_id, event_date FROM {events}
  WHERE user_id IS NOT NULL AND event_date IS NOT NULL),
listed AS (
  SELECT source, user_id, event_date + CAST(age AS INTEGER) AS date_day, min(age) AS age
  FROM (SELECT *, unnest(range(30)) AS age FROM user_day) GROUP BY source, user_id, date_day),
au AS (
  SELECT d.source, d.date_day, CAST(count(*) FILTER (l.age = 0) AS BIGINT) AS dau,
         CAST(count(*) FILTER (l.age < 7) AS BIGINT) AS wau,
         CAST(count(l.user_id) AS BIGINT) AS mau
  FROM {spine} d LEFT JOIN listed l ON l.source = d.source AND l.date_day = d.date_day
  GROUP BY d.source, d.date_day)
"""


ACTIVE_CTES = active_ctes("fct_events", "dim_date")


def active_sql(kind: str) -> str:
    """kind in dau/wau/mau/all; days without any event have no ``dau`` row of their own."""
    sel = {"dau": "SELECT source, event_date AS date_day, CAST(len(list_distinct(list(user_id))) "
                  "AS BIGINT) AS dau FROM fct_events GROUP BY source, event_date",
           "wau": "SELECT source, date_day, wau FROM au",
           "mau": "SELECT source, date_day, mau FROM au", "all": "SELECT * FROM au"}[kind]
    return with_model(ACTIVE_CTES + sel)


def retention_sql(source_sql: str) -> str:
    """Retention CTEs over ``user_id, source, event_date``."""
    return f""", active_week AS (
  SELECT DISTINCT source, user_id, event_date - CAST(isodow(event_date) - 1 AS INTEGER) AS week
  FROM ({source_sql})),
dated AS (
  SELECT *, min(week) OVER (PARTITION BY source, user_id) AS cohort_week FROM active_week),
cohort_sizes AS (
  SELECT source, cohort_week, CAST(count(DISTINCT user_id) AS BIGINT) AS cohort_size
  FROM dated GROUP BY source, cohort_week),
cell AS (
  SELECT source, cohort_week, CAST((week - cohort_week) // 7 AS BIGINT) AS weeks_since_cohort,
         CAST(count(*) AS BIGINT) AS retained_users
  FROM dated WHERE user_id IS NOT NULL AND cohort_week IS NOT NULL GROUP BY ALL),
mart_retention AS (
  SELECT cell.source, cell.cohort_week, weeks_since_cohort, cohort_size, retained_users,
         round(100.0 * retained_users / cohort_size, 2) AS retention_rate
  FROM cell JOIN cohort_sizes z ON z.source = cell.source AND z.cohort_week = cell.cohort_week)
"""


FCT_UE = "SELECT user_id, source, event_date FROM fct_events"

# The whole events table with every seventh row's user and every eleventh's day missing.
GAPPY = """WITH gappy AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 'a' ELSE 'b' END AS source,
         CASE WHEN event_id % 7 > 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN event_id % 11 > 0 THEN CAST(ts AS DATE) END AS event_date
  FROM events),
days AS (
  SELECT source, CAST(unnest(range(min(event_date), max(event_date) + 1, INTERVAL 1 DAY)) AS DATE)
           AS date_day
  FROM gappy GROUP BY source)"""


def all_marts(body: str) -> str:
    """Every model and mart as CTEs, then ``body``."""
    return with_model(funnel_ctes() + ACTIVE_CTES + retention_sql(FCT_UE) + body)
