"""Week masks beyond one word, and mergeable day bitmaps, against plain counts."""

from __future__ import annotations

import datetime as dt
import os
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from eventmarts.operators import active_bitmaps, marts
from tests.test_plans import _exchanges, _plan, large_plan  # noqa: F401

D0 = dt.date(1969, 11, 20)  # weeks on both sides of the counting's zero
SCHEMA = "source string, user_id string, event_date date"


def _rows(seed, n=900, span=1400):
    rng = random.Random(seed)
    return [(rng.choice("st"), rng.choice([None, *(f"u{k}" for k in range(25))]),
             None if rng.random() < 0.03 else D0 + dt.timedelta(days=rng.randrange(span))) for _ in range(n)]


def test_masks_of_more_than_a_word_of_weeks(spark):
    rows = _rows(1)
    df = spark.createDataFrame(rows, SCHEMA)
    monday = lambda d: d - dt.timedelta(days=d.weekday())
    weeks = defaultdict(set)
    for s, u, d in rows:
        if u is not None:
            weeks[s, u].add(None if d is None else monday(d))
    cells, sizes = defaultdict(int), defaultdict(int)
    for (s, _), w in weeks.items():
        first = min(x for x in w if x is not None)
        sizes[s, first] += 1
        for x in w:
            cells[s, first, None if x is None else (x - first).days // 7] += 1
    got = {(r["source"], r["cohort_week"], r["weeks_since_cohort"]): (r["cohort_size"], r["retained_users"])
           for r in marts.retention(df).collect()}
    assert got == {k: (sizes[k[:2]], n) for k, n in cells.items()}
    assert max(k[2] or 0 for k in got) > 150
    masks = marts.week_masks(df).collect()
    assert max(len(r["mask"]) for r in masks) == 4 and all(r["mask"][0] & 1 for r in masks)
    assert sum(r["users"] for r in masks) == len(weeks)


def test_user_rows_are_moved_once(spark, large_plan):  # noqa: F811
    df = spark.range(1000).selectExpr("'s' source", "cast(id % 70 as string) user_id",
                                      "date_add(date'2024-01-01', cast(id % 90 as int)) event_date")
    p = _plan(marts.retention(df))
    keyed = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert _exchanges(p) == 4 and sum("user_id" in k for k in keyed) == 1
    # one window, over the aggregated cells
    assert p.count("Window [") == 1 and "Expand" not in p


def _active(rows):
    days = defaultdict(lambda: [None, None])
    seen = defaultdict(set)
    for s, u, d in rows:
        if d is not None:
            lo, hi = days[s]
            days[s] = [min(lo or d, d), max(hi or d, d)]
            if u is not None:
                seen[s, d].add(u)
    out = []
    for s, (lo, hi) in days.items():
        for k in range((hi - lo).days + 1):
            day = lo + dt.timedelta(days=k)
            out.append((s, day, *[len(set().union(*[seen[s, day - dt.timedelta(days=j)] for j in range(n)]))
                                  for n in (1, 7, 30)]))
    return sorted(out)


def _out(df):
    return sorted(tuple(r) for r in df.collect())


def test_day_bitmaps_merge_in_any_order(spark, scratch):
    rows = _rows(2, 500, 70)
    store, taken = active_bitmaps.ActiveUsers(spark, os.path.join(scratch, "a")), []
    for part in (rows[:200], rows[200:210], rows[210:], rows[:40], []):  # late, new and replayed events
        store.flush(spark.createDataFrame(part, SCHEMA))
        taken += part
        assert _out(store.active_users()) == _active(taken)
    df = spark.createDataFrame(rows, SCHEMA)
    assert _out(active_bitmaps.active_users(df, marts.date_spine(df.where("event_date is not null")))) == _active(rows)


def test_numbers_stay_and_are_dense(spark):
    users = spark.range(40_000).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("user_id"))
    first = active_bitmaps.number_users(users.where("id < 33000"))
    last = first.groupBy("source").agg(F.max("number").alias("last"))
    more = active_bitmaps.number_users(users.where("id >= 33000"), last)
    got = sorted(r["number"] for r in first.unionByName(more).collect())
    assert got == list(range(1, 40_001))
    # two bitmaps hold them, and the count is exact
    days = users.withColumn("d", F.lit(dt.date(2024, 1, 1)))
    maps = active_bitmaps.day_bitmaps(days, first.unionByName(more))
    assert sorted(r["bucket"] for r in maps.select("bucket").collect()) == [1, 2]
    spine = spark.createDataFrame([("s", dt.date(2024, 1, 30)), ("s", dt.date(2024, 1, 31))], "source string, date_day date")
    assert _out(active_bitmaps.trailing_counts(maps, spine)) == [
        ("s", dt.date(2024, 1, 30), 0, 0, 40_000), ("s", dt.date(2024, 1, 31), 0, 0, 0)]


def test_a_new_day_reads_its_own_events_and_29_days_of_bitmaps(spark, scratch, monkeypatch):
    rows = [("s", f"u{d % 7}", dt.date(2024, 1, 1) + dt.timedelta(days=d)) for d in range(60)]
    store = active_bitmaps.ActiveUsers(spark, os.path.join(scratch, "a"))
    store.flush(spark.createDataFrame(rows, SCHEMA))
    asked = []
    read = active_bitmaps.read_published
    monkeypatch.setattr(active_bitmaps, "read_published", lambda s, r, table, v, parts=None: (
        asked.append((table, parts)), read(s, r, table, v, parts))[1])
    day = dt.date(2024, 3, 1)
    assert store.flush(spark.createDataFrame([("s", "u1", day), ("s", "new", day)], SCHEMA)) == ["2024-03-01"]
    assert ("days", ["2024-03-01"]) in asked
    asked.clear()
    got = _out(store.active_users(["2024-03-01"]))
    assert got == [r for r in _active([*rows, ("s", "u1", day), ("s", "new", day)]) if r[1] == day]
    (parts,) = [p for t, p in asked if t == "days"]
    assert parts == [str(day - dt.timedelta(days=k)) for k in range(29, -1, -1)]
