"""Sessions that grow by flushes (C5, C6, W1-W3): a flush rebuilds what it touches.

The store is a published warehouse (:mod:`eventmarts.sinks.publish`) of

* ``events``: the sessionized event rows, one folder per event date;
* ``sessions``: one row per (session, user, source) with its span, event count and the
  dates that hold its events, one folder per start date: the state of the scan;
* ``unattached``: inferred-source events that no session row can own (NULL user or time).

A flush finds the sessions that its events touch -- inferred sessions of the same user on the
days within a gap of a new event, native sessions of the same id -- from the session
table alone.  Only the dates of those sessions and of the new events are read from the event
table; the touched rows and the new ones are sessionized again by the same ordered scan as a
full build, all other rows of those dates are carried over, and the next version names
the new folders beside the old ones of all other dates.  Sessions of a user that no new event
comes near are not touched: between two of them lies more than a gap, and each new event
belongs to the session(s) within a gap of it.

A replayed event id on its date is dropped, so a flush may be run again.  (An event without
an id cannot be told from another and is kept.)  The lists of dates are the only data that
come to the driver: they are bounded by the calendar.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.operators import marts, sessions
from eventmarts.schema import (
    CONFORMED_FIELDS,
    DEFAULT_SESSION_GAP_MINUTES,
    EVENT_FACT_FIELDS,
    HISTORICAL,
    SESSION_FIELDS,
    STREAM,
)
from eventmarts.session import materialize
from eventmarts.sinks.publish import Version, _hadoop, current, publish, read_published

UNDATED = "none"
_FACT = ("event_id string, user_id string, session_id string, event_sequence_number long, event_type string, "
         "event_timestamp timestamp, event_date date, element_id string, url string, referrer string, "
         "item_id string, transaction_id string, source string")
_STATE = ("session_id string, user_id string, source string, session_start_at timestamp, "
          "session_end_at timestamp, event_count long, dates array<string>")


@dataclass
class Flush:
    """What a flush did: dates read from and written to the event table, rows taken in."""

    read: list[str]
    written: list[str]
    added: int
    version: int


def _part(date) -> F.Column:
    return F.coalesce(F.col(date).cast("string") if isinstance(date, str) else date.cast("string"),
                      F.lit(UNDATED))


class SessionStore:
    """Sessionized events under ``root``, extended by :meth:`flush`."""

    def __init__(self, spark: SparkSession, root: str, gap_minutes: int = DEFAULT_SESSION_GAP_MINUTES,
                 native: tuple[str, ...] = (STREAM,), inferred: tuple[str, ...] = (HISTORICAL,)):
        self.spark, self.root, self.gap = spark, root, int(gap_minutes)
        self.native, self.inferred = list(native), list(inferred)

    # -- reading ---------------------------------------------------------------

    def _read(self, version: Version, table: str, schema: str, parts=None) -> DataFrame:
        found = read_published(self.spark, self.root, table, version, parts, schema)
        return self.spark.createDataFrame([], schema) if found is None else found

    def events(self, version: Version | None = None, dates=None) -> DataFrame:
        """The event fact (C6, C8), or its rows of some dates (``YYYY-MM-DD``)."""
        version = version or current(self.spark, self.root)
        return self._read(version, "events", _FACT, dates).select(*EVENT_FACT_FIELDS)

    def sessions(self, version: Version | None = None) -> DataFrame:
        """The session table."""
        version = version or current(self.spark, self.root)
        lost = self._read(version, "unattached", _FACT)
        return (self._read(version, "sessions", _STATE).select(*SESSION_FIELDS)
                .unionByName(sessions.gap_sessions(lost, self.gap, self.inferred).select(*SESSION_FIELDS)))

    # -- writing ---------------------------------------------------------------

    def flush(self, events: DataFrame) -> Flush:
        """Take conformed ``events`` into the store and publish its next version."""
        version = current(self.spark, self.root)
        new = materialize(events.select(*CONFORMED_FIELDS), "flush-events")
        days = _dates(new.select(_part("event_date").alias("d")))
        stored = self.events(version, [d for d in days if d in version.tables.get("events", {})])
        key, named = ["source", "event_id"], F.col("event_id").isNotNull()
        seen = stored.where(named).select(*key)
        new = new.where(named).dropDuplicates(key).join(seen, key, "left_anti").select(
            *CONFORMED_FIELDS).unionByName(new.where(~named))
        new = materialize(new, "flush-new")
        attached = sessions.attachable(new, self.native, self.inferred)
        touched = materialize(self._touched(version, attached), "flush-touched")

        read = _dates(touched.select(F.explode("dates").alias("d")))
        write = sorted(set(read) | set(_dates(attached.select(_part("event_date").alias("d")))))
        carried, rebuilt = self._rebuild(version, attached, touched, write)
        run = os.path.join("_runs", uuid.uuid4().hex)
        tables = {t: dict(parts) for t, parts in version.tables.items()}
        self._write(tables, "events", run, carried.unionByName(rebuilt), _part("event_date"), write)
        self._write_sessions(version, tables, run, rebuilt, touched)
        lost = new.where(
            F.col("source").isin(self.inferred) & (F.col("user_id").isNull() | F.col("event_timestamp").isNull()))
        if not lost.isEmpty():
            path = os.path.join(run, "unattached")
            lost.write.parquet(os.path.join(self.root, path))
            tables.setdefault("unattached", {})[path] = path
        done = publish(self.spark, self.root, tables, version.number)
        return Flush(sorted(set(read) | (set(write) & set(version.tables.get("events", {})))), write,
                     new.count(), done.number)

    def _touched(self, version: Version, new: DataFrame) -> DataFrame:
        """Session rows that the new events may change.

        One row per user and per native session on the side of the new events, so the join
        never grows; a day within a gap of a new event names the inferred sessions."""
        state = self._read(version, "sessions", _STATE)
        reach = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(self.gap + 1), F.lit(0).cast("decimal(18,6)"))
        ts = F.col("event_timestamp")
        near = (new.where(F.col("source").isin(self.inferred))
                .groupBy("source", "user_id").agg(F.array_distinct(F.flatten(F.collect_set(
                    F.array(F.to_date(ts - reach), F.to_date(ts), F.to_date(ts + reach))))).alias("near")))
        spans = F.exists("near", lambda d: d.between(F.to_date("session_start_at"), F.to_date("session_end_at")))
        own = state.join(near, ["source", "user_id"]).where(spans).select(*state.columns)
        ids = new.where(F.col("source").isin(self.native)).select(F.col("session_id").alias("_id")).distinct()
        given = state.where(F.col("source").isin(self.native)).join(
            ids, F.col("session_id").eqNullSafe(F.col("_id")), "left_semi")
        return own.unionByName(given)

    def _rebuild(self, version: Version, new: DataFrame, touched: DataFrame,
                 dates: list[str]) -> tuple[DataFrame, DataFrame]:
        """(rows of ``dates`` as they were, rows sessionized again)."""
        old = self.events(version, dates)
        keys = touched.select(F.col("source").alias("_s"), F.col("session_id").alias("_id"))
        same = (F.col("source") == F.col("_s")) & F.col("session_id").eqNullSafe(F.col("_id"))
        # inferred events carry no session id of their own
        again = old.join(keys, same, "left_semi").withColumn(
            "session_id", F.when(F.col("source").isin(self.native), F.col("session_id")))
        rows = again.select(*CONFORMED_FIELDS).unionByName(new)
        if version.tables.get("events"):  # the scan reads its rows several times; the join runs once
            rows = materialize(rows, "flush-rows")
        rebuilt = marts.event_fact(sessions.sessionize(rows, self.gap, self.native, self.inferred))
        return old.join(keys, same, "left_anti"), materialize(rebuilt, "flush-rebuilt")

    def _write(self, tables: dict, name: str, run: str, rows: DataFrame, part: F.Column,
               parts: list[str]) -> None:
        """Write ``rows`` by part and point the parts at the new folders; a part that has
        become empty is dropped."""
        path = os.path.join(run, name)
        (rows.withColumn("_part", part).hint("rebalance", "_part")
         .write.partitionBy("_part").parquet(os.path.join(self.root, path)))
        folder, fs = _hadoop(self.spark, os.path.join(self.root, path))
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        got = {n.removeprefix("_part=") for n in names if n.startswith("_part=")}
        mine = tables.setdefault(name, {})
        for p in parts:
            mine.pop(p, None)
            if p in got:
                mine[p] = os.path.join(path, f"_part={p}")

    def _write_sessions(self, version: Version, tables: dict, run: str, rebuilt: DataFrame,
                        touched: DataFrame) -> None:
        fresh = (rebuilt.groupBy("session_id", "user_id", "source").agg(
            F.min("event_timestamp").alias("session_start_at"), F.max("event_timestamp").alias("session_end_at"),
            F.count(F.lit(1)).alias("event_count"), F.sort_array(F.collect_set(_part("event_date"))).alias("dates")))
        fresh = materialize(fresh, "flush-sessions")
        part = _part(F.to_date("session_start_at"))
        parts = sorted(set(_dates(fresh.select(part.alias("d")))) | set(_dates(touched.select(part.alias("d")))))
        keys = touched.select(
            *[F.col(c).alias(f"_{c}") for c in ("source", "session_id", "user_id")])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("source", "session_id", "user_id")]
        kept = self._read(version, "sessions", _STATE, parts).join(keys, same, "left_anti")
        self._write(tables, "sessions", run, kept.unionByName(fresh), part, parts)


def _dates(days: DataFrame) -> list[str]:
    """Distinct values of ``d`` (calendar days as text)."""
    return sorted(r["d"] for r in days.distinct().collect())
