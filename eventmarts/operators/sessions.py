"""Sessions (C5), sessionized events (C6) and session masks.

* Native sources (``stream``): the payload's ``session_id``; a session row per
  ``(session_id, user_id, source)``.
* Inferred sources (``batch_historical``): per user, a new session starts at the
  first event and whenever the minute-boundary count since the previous event
  is greater than ``gap_minutes``.  Key = md5 of ``user_id-<start as
  timestamptz text>``.

The rule counts minute boundaries, so it sees nothing but a user's *active minutes*: events
of one minute never lie apart.  Session rows and masks therefore come from one aggregate by
(user, minute), which collapses a burst or a heavy user map-side, and a window over that
user's minutes, of which there are 525,600 a year at most, however many events the user has.
No event is sorted and nothing is written.

Event rows need their number in the session and keep the ordered scan.  Attaching the
inferred session to each event needs no join: the split gap scan already yields each event's
session start.  The interval join of the original
(event time between start and end) is kept as :func:`attach_by_interval_join`, a sweep
over session starts and events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmarts.functions import minute_boundaries, surrogate_key, ts_key_text
from eventmarts.plans.ordered import split_gap_sessions, split_last, split_row_number
from eventmarts.schema import (
    CONFORMED_FIELDS,
    DEFAULT_SESSION_GAP_MINUTES,
    HISTORICAL,
    SESSION_FIELDS,
    STREAM,
)
from eventmarts.session import materialize

TS, TIE = "event_timestamp", "event_id"


def _by_source(events: DataFrame, sources: Sequence[str]) -> DataFrame:
    return events.where(F.col("source").isin(list(sources)))


def native_sessions(events: DataFrame, sources: Sequence[str] = (STREAM,)) -> DataFrame:
    """A1: min/max/count per (session_id, user_id, source)."""
    return (_by_source(events, sources)
            .groupBy("session_id", "user_id", "source")
            .agg(F.min(TS).alias("session_start_at"), F.max(TS).alias("session_end_at"),
                 F.count(F.lit(1)).alias("event_count"))
            .select(*SESSION_FIELDS))


def gap_rule(gap_minutes: int):
    """Break iff minute boundaries since the previous event > gap."""
    return lambda prev, ts: minute_boundaries(prev, ts) > F.lit(int(gap_minutes))


def gap_session_events(events: DataFrame, gap_minutes: int = DEFAULT_SESSION_GAP_MINUTES,
                       sources: Sequence[str] = (HISTORICAL,)) -> DataFrame:
    """Inferred-source events with ``session_start_at``, ``event_sequence_number``
    and the derived ``session_id`` (W1, W2, W3, F12, no join)."""
    e = split_gap_sessions(_by_source(events, sources), ["source", "user_id"], TS, TIE,
                           gap_rule(gap_minutes))
    return e.withColumn("session_id", surrogate_key(F.col("user_id"), ts_key_text(F.col("session_start_at"))))


def _minutes(events: DataFrame, keys: Sequence[str], gap_minutes: int, *aggs) -> DataFrame:
    """Active minutes of each key with ``aggs`` and ``_no``, the number of their session."""
    minute = F.floor(F.unix_seconds(TS) / F.lit(60)).cast("long")
    active = (events.where(F.col(TS).isNotNull()).withColumn("_minute", minute)
              .groupBy(*keys, "_minute").agg(*aggs))
    w = Window.partitionBy(*keys).orderBy("_minute")
    apart = F.col("_minute") - F.lag("_minute").over(w) > F.lit(int(gap_minutes))
    opens = F.coalesce(apart, F.lit(True)).cast("long")
    return (active.withColumn("_opens", opens)
            .withColumn("_no", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0))))


def gap_sessions(events: DataFrame, gap_minutes: int = DEFAULT_SESSION_GAP_MINUTES,
                 sources: Sequence[str] = (HISTORICAL,)) -> DataFrame:
    """A2 + F12: one row per inferred session.  An event without a time always is a
    session of its own."""
    chosen = _by_source(events, sources)
    keys = ["source", "user_id"]
    dated = _minutes(chosen, keys, gap_minutes, F.min(TS).alias("_lo"), F.max(TS).alias("_hi"),
                     F.count(F.lit(1)).alias("_n"))
    s = dated.groupBy(*keys, "_no").agg(
        F.min("_lo").alias("session_start_at"), F.max("_hi").alias("session_end_at"),
        F.sum("_n").alias("event_count")).drop("_no")
    undated = chosen.where(F.col(TS).isNull()).select(
        *keys, F.col(TS).alias("session_start_at"), F.col(TS).alias("session_end_at"),
        F.lit(1).cast("long").alias("event_count"))
    return s.unionByName(undated).select(
        surrogate_key(F.col("user_id"), ts_key_text(F.col("session_start_at"))).alias("session_id"),
        "user_id", "source", "session_start_at", "session_end_at", "event_count")


#: Event types per mask word: the bits of a long without its sign.
MASK_BITS = 63


def _mask_words(types: Sequence[str]) -> list[Column]:
    """One bit per event type, as partial-aggregated ORs, ``MASK_BITS`` types to a word."""
    words = [types[i:i + MASK_BITS] for i in range(0, len(types), MASK_BITS)] or [()]
    out = []
    for k, some in enumerate(words):
        bit = F.lit(0).cast("long")
        for b, name in enumerate(some):
            bit = F.when(F.col("event_type") == F.lit(name), F.lit(1 << b).cast("long")).otherwise(bit)
        out.append(F.bit_or(bit).alias(f"mask{k}"))
    return out


def _merged(count: int) -> list[Column]:
    return [F.bit_or(f"mask{k}").alias(f"mask{k}") for k in range(count)]


def session_masks(fact: DataFrame, types: Sequence[str]) -> DataFrame:
    """``source, mask0, ...`` of every session of a fact: which of ``types`` it holds."""
    return (fact.where(F.col("session_id").isNotNull()).groupBy("source", "session_id")
            .agg(*_mask_words(types)).drop("session_id"))


def event_masks(events: DataFrame, types: Sequence[str],
                gap_minutes: int = DEFAULT_SESSION_GAP_MINUTES,
                native: Sequence[str] = (STREAM,), inferred: Sequence[str] = (HISTORICAL,)) -> DataFrame:
    """:func:`session_masks` of the sessionized table, straight from conformed events:
    native sessions by their id, inferred ones by their active minutes."""
    words = _mask_words(types)
    own = session_masks(_by_source(events, native), types)
    keys = ["source", "user_id"]
    gaps = _minutes(attachable(events, (), inferred), keys, gap_minutes, *words)
    return own.unionByName(gaps.groupBy(*keys, "_no").agg(*_merged(len(words)))
                           .drop("user_id", "_no"))


def sessions(events: DataFrame, gap_minutes: int = DEFAULT_SESSION_GAP_MINUTES,
             native: Sequence[str] = (STREAM,), inferred: Sequence[str] = (HISTORICAL,)) -> DataFrame:
    """Native sessions UNION ALL inferred sessions."""
    return native_sessions(events, native).unionByName(gap_sessions(events, gap_minutes, inferred))


_OUT = [c for c in CONFORMED_FIELDS] + ["event_sequence_number"]


def attachable(events: DataFrame, native: Sequence[str] = (STREAM,),
               inferred: Sequence[str] = (HISTORICAL,)) -> DataFrame:
    """The events that the sessionized table holds.  Attaching by "user equal and time
    between start and end" can never match an inferred-source event whose user or
    timestamp is NULL (its session still is part of the session table)."""
    dated = F.col("user_id").isNotNull() & F.col(TS).isNotNull()
    return events.where(F.col("source").isin(list(native))
                        | (F.col("source").isin(list(inferred)) & dated))


def sessionize(events: DataFrame, gap_minutes: int = DEFAULT_SESSION_GAP_MINUTES,
               native: Sequence[str] = (STREAM,), inferred: Sequence[str] = (HISTORICAL,)) -> DataFrame:
    """C6 (join-free): conformed events with ``session_id`` filled and
    ``event_sequence_number`` = position in the session by (timestamp, event_id)."""
    stream = split_row_number(_by_source(events, native), ["session_id"], TS, TIE,
                              "event_sequence_number")
    hist = gap_session_events(attachable(events, (), inferred), gap_minutes, inferred)
    return stream.select(*_OUT).unionByName(hist.select(*_OUT))


def attach_by_interval_join(events: DataFrame, sess: DataFrame,
                            inferred: Sequence[str] = (HISTORICAL,)) -> DataFrame:
    """Inferred-source events matched to their session by user, source and
    ``event_timestamp between session_start_at and session_end_at``, with their number in it.

    Sessions of a user do not overlap, so the only candidate is the last one that starts at
    or before the event: one ordered sweep over the union of session starts and events.  A
    session is one row, however long it lasts.
    """
    e = attachable(_by_source(events, inferred), (), inferred)
    own = F.struct("session_id", "session_end_at")
    starts = (_by_source(sess, inferred)
              .where(F.col("user_id").isNotNull() & F.col("session_start_at").isNotNull())
              .select("source", "user_id", F.col("session_start_at").alias(TS), F.lit(0).alias("_kind"),
                      own.alias("_own")))
    rows = starts.unionByName(e.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    swept = split_last(rows, ["source", "user_id"], [TS, "_kind", TIE], "_own", "_at",
                       F.col("_kind") == 1, "event_sequence_number")
    found = swept.where((F.col("_kind") == 1) & (F.col(TS) <= F.col("_at.session_end_at")))
    return found.select(*[F.col("_at.session_id").alias(c) if c == "session_id" else F.col(c) for c in _OUT])


def sessionize_interval_join(events: DataFrame, gap_minutes: int = DEFAULT_SESSION_GAP_MINUTES,
                             native: Sequence[str] = (STREAM,),
                             inferred: Sequence[str] = (HISTORICAL,)) -> DataFrame:
    """C6 with the session table first: sessions, then the interval join.  Same result as
    :func:`sessionize`.

    The conformed events and the sessions are written once and swept from there."""
    events = materialize(events.select(*CONFORMED_FIELDS), "conformed")
    sess = materialize(gap_sessions(events, gap_minutes, inferred), "sessions")
    stream = split_row_number(_by_source(events, native), ["session_id"], TS, TIE, "event_sequence_number")
    return stream.select(*_OUT).unionByName(attach_by_interval_join(events, sess, inferred))
