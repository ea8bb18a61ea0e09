"""Flush by flush equals one full build, whatever the order; untouched dates stay unread."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from eventmarts.operators import marts, sessions
from eventmarts.plans.incremental import SessionStore
from eventmarts.schema import EVENT_FACT_FIELDS, SESSION_FIELDS
from eventmarts.sinks.publish import current, publish

T0 = dt.datetime(2024, 1, 1, 22)
SCHEMA = ("event_id string, user_id string, session_id string, event_type string, event_timestamp timestamp, "
          "source string")


def _frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("event_id", "user_id", "session_id", "event_type", "event_timestamp",
                     F.to_date("event_timestamp").alias("event_date"),
                     *[F.lit(None).cast("string").alias(c) for c in
                       ("element_id", "url", "referrer", "item_id", "transaction_id")], "source")


def _rows(seed, n=220):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        at = T0 + dt.timedelta(seconds=rng.choice([rng.randrange(6 * 86400), rng.randrange(4 * 3600)]))
        user = rng.choice(["a", "b", "hot", "hot", None])
        if rng.random() < 0.5:
            out.append((f"h{i:03d}", user, None, "click", None if rng.random() < 0.04 else at, "batch_historical"))
        else:
            sid = rng.choice([f"{user}-{at:%Y%m%d}", "long", None])
            out.append((f"s{i:03d}", user, sid, "click", None if rng.random() < 0.04 else at, "stream"))
    return out


def _texts(df, cols):
    return sorted(str(tuple(r[c] for c in cols)) for r in df.select(*cols).collect())


def _same_as_full(spark, store, rows, gap=30):
    full = _frame(spark, rows)
    assert _texts(store.events(), EVENT_FACT_FIELDS) == _texts(
        marts.event_fact(sessions.sessionize(full, gap)), EVENT_FACT_FIELDS)
    assert _texts(store.sessions(), SESSION_FIELDS) == _texts(sessions.sessions(full, gap), SESSION_FIELDS)


@pytest.mark.parametrize("seed,gap", [(1, 30), (2, 360)])
def test_flushes_in_any_order_equal_a_full_build(spark, scratch, seed, gap):
    rows = _rows(seed)
    random.Random(seed + 10).shuffle(rows)
    store, seen = SessionStore(spark, os.path.join(scratch, "s"), gap), []
    for part in (rows[:90], rows[90:130], rows[130:131], rows[131:]):
        store.flush(_frame(spark, part))
        seen += part
    _same_as_full(spark, store, seen, gap)


def test_a_replayed_flush_changes_nothing(spark, scratch):
    rows = _rows(3, 80)
    store = SessionStore(spark, os.path.join(scratch, "s"))
    store.flush(_frame(spark, rows))
    dated = [r for r in rows if not (r[5] != "stream" and (r[1] is None or r[4] is None))]
    again = store.flush(_frame(spark, dated[:50] + dated[:10]))
    assert again.added == 0
    _same_as_full(spark, store, rows)


def test_a_late_event_merges_two_sessions_across_midnight(spark, scratch):
    at = lambda h, m: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h, minutes=m)
    rows = [("1", "u", None, "click", at(23, 20), "batch_historical"), ("2", "u", None, "click", at(24, 15), "batch_historical"),
            ("3", "u", None, "click", at(24, 20), "batch_historical")]
    late = ("0", "u", None, "click", at(23, 48), "batch_historical")
    store = SessionStore(spark, os.path.join(scratch, "s"))
    store.flush(_frame(spark, rows))
    assert store.sessions().count() == 2
    did = store.flush(_frame(spark, [late]))
    assert did.written == ["2024-01-01", "2024-01-02"]
    assert [(r["event_id"], r["event_sequence_number"]) for r in store.events().orderBy("event_timestamp").collect()] == [
        ("1", 1), ("0", 2), ("2", 3), ("3", 4)]
    _same_as_full(spark, store, [*rows, late])


def test_untouched_dates_are_neither_read_nor_written(spark, scratch, monkeypatch):
    rows = [(f"{d}-{u}-{k}", f"u{u}", None, "click", dt.datetime(2024, 1, 1 + d, 12, k), "batch_historical")
            for d in range(20) for u in range(4) for k in range(3)]
    root = os.path.join(scratch, "s")
    store = SessionStore(spark, root)
    store.flush(_frame(spark, rows))
    before, asked = current(spark, root), []
    events = SessionStore.events
    monkeypatch.setattr(SessionStore, "events", lambda self, version=None, dates=None: (
        asked.append(dates), events(self, version, dates))[1])
    late = [("late", "u2", None, "click", dt.datetime(2024, 1, 7, 12, 20), "batch_historical"),
            ("new", "u3", None, "click", dt.datetime(2024, 1, 25, 1), "batch_historical")]
    did = store.flush(_frame(spark, late))
    assert did.read == ["2024-01-07"] and did.written == ["2024-01-07", "2024-01-25"]
    assert {d for dates in asked for d in dates} <= {"2024-01-07", "2024-01-25"}
    after = current(spark, root)
    same = {d for d, p in before.tables["events"].items() if after.tables["events"].get(d) == p}
    assert same == set(before.tables["events"]) - {"2024-01-07"}
    monkeypatch.undo()
    _same_as_full(spark, store, rows + late)
    # rows of other users on a rewritten date are carried over as they were
    assert store.events(dates=["2024-01-07"]).count() == 13


def test_a_crash_before_publication_leaves_the_store(spark, scratch, monkeypatch):
    from eventmarts.plans import incremental

    rows = _rows(5, 60)
    store = SessionStore(spark, os.path.join(scratch, "s"))
    store.flush(_frame(spark, rows[:40]))

    def dies(*_):
        raise OSError("lost")
    monkeypatch.setattr(incremental, "publish", dies)
    with pytest.raises(OSError):
        store.flush(_frame(spark, rows[40:]))
    monkeypatch.setattr(incremental, "publish", publish)
    _same_as_full(spark, store, rows[:40])
    store.flush(_frame(spark, rows[40:]))
    _same_as_full(spark, store, rows)


def test_an_empty_flush(spark, scratch):
    store = SessionStore(spark, os.path.join(scratch, "s"))
    assert store.events().count() == 0 and store.sessions().count() == 0
    did = store.flush(_frame(spark, []))
    assert (did.added, did.written, store.events().count()) == (0, [], 0)


def test_the_rows_of_a_flush_are_joined_once(spark, scratch, monkeypatch):
    """A written table is looked up in its folder, not computed again; what the scan reads is written."""
    from eventmarts.plans import incremental

    rows, names, listed = _rows(6, 60), [], []
    store = SessionStore(spark, os.path.join(scratch, "s"))
    store.flush(_frame(spark, rows[:40]))
    dates, write = incremental._dates, incremental.materialize
    monkeypatch.setattr(incremental, "_dates", lambda d: (listed.append(d._jdf.queryExecution().analyzed().toString()),
                                                          dates(d))[1])
    monkeypatch.setattr(incremental, "materialize", lambda df, name: (names.append(name), write(df, name))[1])
    store.flush(_frame(spark, rows[40:]))
    assert "flush-rows" in names
    assert not [p for p in listed if "Join" in p]
    _same_as_full(spark, store, rows)
