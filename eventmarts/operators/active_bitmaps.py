"""Exact active users from mergeable day bitmaps.

Every user of a source has a dense number, so a day's users are the bits of a few bitmaps
(32,768 users in 4 KB).  Bitmaps of a day merge by OR -- with each other when events come
late, and into trailing windows: 7 and 30 days are the OR of 7 and 30 days' bitmaps.
Numbers are given once and stay; new users continue after the last one.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.plans.ordered import split_row_number
from eventmarts.session import materialize
from eventmarts.sinks.publish import Version, current, publish, read_published

WINDOWS = (("dau", 1), ("wau", 7), ("mau", 30))
LONGEST = max(n for _, n in WINDOWS)
_USERS = "source string, user_id string, number long"
_DAYS = "source string, d date, bucket long, bitmap binary"


def user_days(events: DataFrame) -> DataFrame:
    """Distinct (source, user, day).  A NULL user is nobody, a NULL day in no window."""
    return (events.select("source", "user_id", F.col("event_date").alias("d"))
            .where(F.col("user_id").isNotNull() & F.col("d").isNotNull()).distinct())


def number_users(users: DataFrame, after: DataFrame | None = None) -> DataFrame:
    """``users(source, user_id)``, distinct, with numbers from 1 per source, or from the end of
    ``after(source, last)``.  The ordered scan numbers a source without one task for it."""
    rows = split_row_number(users.select("source", "user_id", F.col("user_id").alias("_o")),
                            ["source"], "user_id", "_o", "number").drop("_o")
    if after is None:
        return rows
    return (rows.join(F.broadcast(after), "source", "left")  # a row per source
            .select("source", "user_id", (F.col("number") + F.coalesce("last", F.lit(0))).alias("number")))


def day_bitmaps(days: DataFrame, users: DataFrame) -> DataFrame:
    """``source, d, bucket, bitmap`` of user-days."""
    return (days.join(users, ["source", "user_id"])
            .groupBy("source", "d", F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")))


def merge_bitmaps(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.groupBy("source", "d", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def trailing_counts(bitmaps: DataFrame, spine: DataFrame) -> DataFrame:
    """dau, wau and mau of every day of ``spine(source, date_day)``; 0 when idle."""
    nothing = F.unhex(F.lit(""))
    cover = bitmaps.select("source", "bucket", "bitmap", "d", F.explode(F.sequence(
        "d", F.date_add("d", LONGEST - 1))).alias("date_day"))
    age = F.datediff("date_day", "d")
    merged = (cover.join(spine, ["source", "date_day"]).groupBy("source", "date_day", "bucket")
              .agg(*[F.bitmap_or_agg(F.when(age < n, F.col("bitmap")).otherwise(nothing)).alias(name)
                     for name, n in WINDOWS]))
    counts = merged.groupBy("source", "date_day").agg(
        *[F.sum(F.bitmap_count(name)).alias(name) for name, _ in WINDOWS])
    return (spine.join(counts, ["source", "date_day"], "left")
            .select("source", "date_day", *[F.coalesce(name, F.lit(0)).cast("long").alias(name)
                                            for name, _ in WINDOWS]))


def active_users(events: DataFrame, spine: DataFrame) -> DataFrame:
    """C10 over all ``events`` by bitmaps.  User-days are written, as numbers and bitmaps both
    come from them."""
    days = materialize(user_days(events), "user-days")
    users = number_users(days.select("source", "user_id").distinct())
    return trailing_counts(day_bitmaps(days, users), spine)


class ActiveUsers:
    """Numbers, day bitmaps and the calendar of a growing set of events, published under
    ``root``: a flush reads its own events, the numbers, and the bitmaps of its own days."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _read(self, version: Version, table: str, schema: str, parts=None) -> DataFrame:
        found = read_published(self.spark, self.root, table, version, parts)
        return self.spark.createDataFrame([], schema) if found is None else found

    def flush(self, events: DataFrame) -> list[str]:
        """Add events; returns the days whose bitmaps were rewritten."""
        version = current(self.spark, self.root)
        run = os.path.join("_runs", uuid.uuid4().hex)
        tables = {t: dict(parts) for t, parts in version.tables.items()}
        events = materialize(events.select("source", "user_id", "event_date"), "flush-days")
        days = user_days(events)
        known = self._read(version, "users", _USERS)
        fresh = days.select("source", "user_id").distinct().join(known, ["source", "user_id"], "left_anti")
        last = known.groupBy("source").agg(F.max("number").alias("last"))
        self._add(tables, "users", run, number_users(fresh, last))
        users = self._read(Version(0, tables), "users", _USERS)

        dates = sorted(str(r["d"]) for r in days.select("d").distinct().collect())  # calendar days
        old = self._read(version, "days", _DAYS, dates)
        merged = merge_bitmaps(day_bitmaps(days, users).unionByName(old))
        path = os.path.join(run, "days")
        (merged.withColumn("_part", F.col("d").cast("string")).write.partitionBy("_part")
         .parquet(os.path.join(self.root, path)))
        tables.setdefault("days", {}).update({d: os.path.join(path, f"_part={d}") for d in dates})
        bounds = events.where(F.col("event_date").isNotNull()).groupBy("source").agg(
            F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
        self._add(tables, "bounds", run, bounds)
        publish(self.spark, self.root, tables, version.number)
        return dates

    def _add(self, tables: dict, name: str, run: str, rows: DataFrame) -> None:
        path = os.path.join(run, name)
        rows.write.parquet(os.path.join(self.root, path))
        tables.setdefault(name, {})[path] = path

    def spine(self, version: Version | None = None) -> DataFrame:
        """Every day from each source's first to last event date."""
        version = version or current(self.spark, self.root)
        bounds = self._read(version, "bounds", "source string, lo date, hi date")
        return bounds.groupBy("source").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(
            "source", F.explode(F.sequence("lo", "hi")).alias("date_day"))

    def active_users(self, days: list[str] | None = None) -> DataFrame:
        """C10 of all days, or of some (``YYYY-MM-DD``): then only the bitmaps of those days and
        of the 29 before each are read."""
        version = current(self.spark, self.root)
        spine = self.spine(version)
        parts = None
        if days is not None:
            spine = spine.where(F.col("date_day").cast("string").isin(list(days)))
            near = {dt.date.fromisoformat(d) - dt.timedelta(days=k) for d in days for k in range(LONGEST)}
            parts = sorted(map(str, near))
        return trailing_counts(self._read(version, "days", _DAYS, parts), spine)
