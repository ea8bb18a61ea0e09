"""Inferred sessions inside the stream (W1, W2, T1): rows leave when their session is over.

Only active minutes matter to the rule, and between whole minutes "more than N minute
boundaries" is elapsed time.  So two of Spark's own windows say it, without Python and with all
state in the state store of the JVM:

* a window of one minute per user keeps the span and the number of its events until
  the watermark passes the minute's end, and drops events of minutes that it has passed;
* ``session_window`` joins those minutes; a session is over, and leaves, when the watermark reaches
  the first minute more than the gap after its last one.  No admitted event can reach it then.

The second window alone would take an event that is later than the watermark by less
than the gap for a session of its own, beside the one it belongs to.  As minutes reach it in the order
of the watermark, it holds the sessions of the last gap; the first holds the active minutes
of the last ``watermark``.  A burst of one user is one row a minute before the shuffle already.

A record without id and type is a heartbeat: it moves the watermark, so that sessions of
a quiet stream close, and counts for no session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.functions import surrogate_key, ts_key_text
from eventmarts.schema import DEFAULT_SESSION_GAP_MINUTES, HISTORICAL, SESSION_FIELDS

MINUTE = 60_000_000


def configure_state(spark: SparkSession) -> None:
    """State that need not fit the heap: the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def merge(spans: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """The rule in plain Python, for comparison: spans ``(first, last, events)`` in microseconds,
    joined where not more than ``gap`` minute boundaries lie between them."""
    out: list[list[int]] = []
    for lo, hi, n in sorted(spans):
        if out and lo // MINUTE - out[-1][1] // MINUTE <= gap:
            out[-1][1] = max(out[-1][1], hi)
            out[-1][2] += n
        else:
            out.append([lo, hi, n])
    return [tuple(s) for s in out]


def stream_gap_sessions(events: DataFrame, gap_minutes: int = DEFAULT_SESSION_GAP_MINUTES,
                        sources: Sequence[str] = (HISTORICAL,), watermark: str = "1 day") -> DataFrame:
    """A stream of conformed ``events`` -> a stream of finished inferred sessions (A2).

    Once a heartbeat has passed all events by watermark and gap, the rows are those of
    ``gap_sessions`` over the events that came no later than ``watermark`` allows.  An event
    without a time is a session of its own and leaves at once."""
    configure_state(events.sparkSession)
    ts = F.col("event_timestamp")
    beat = F.col("event_id").isNull() & F.col("event_type").isNull()
    chosen = events.where(F.col("source").isin(list(sources)))
    marked = chosen.select(F.when(~beat, F.col("source")).alias("source"), "user_id",
                           ts.alias("event_timestamp"), beat.alias("beat"))
    # heartbeats go by a count: a filter on their columns would be moved below the watermark
    minutes = (marked.where(ts.isNotNull()).withWatermark("event_timestamp", watermark)
               .groupBy("source", "user_id", F.window("event_timestamp", "1 minute").alias("minute"))
               .agg(F.min("event_timestamp").alias("lo"), F.max("event_timestamp").alias("hi"),
                    F.count(F.when(~F.col("beat"), 1)).alias("n")).where(F.col("n") > 0))
    # (a minute's time is its last microsecond; the one more microsecond makes a session end with the
    # first minute that is over the gap)
    gap = f"{int(gap_minutes)} minutes 1 microsecond"
    closed = minutes.groupBy("source", "user_id", F.session_window(F.window_time("minute"), gap)).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))
    dated = closed.select("source", "user_id", F.col("lo").alias("session_start_at"),
                          F.col("hi").alias("session_end_at"), F.col("n").alias("event_count"))
    undated = marked.where(ts.isNull() & ~F.col("beat")).select(
        "source", "user_id", ts.alias("session_start_at"), ts.alias("session_end_at"),
        F.lit(1).cast("long").alias("event_count"))
    return dated.unionByName(undated).select(
        surrogate_key(F.col("user_id"), ts_key_text(F.col("session_start_at"))).alias("session_id"),
        *SESSION_FIELDS[1:])
