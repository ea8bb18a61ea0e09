"""Skew-proof ordered scans: per-key running state without one task per key.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; a key
holding a third of all rows then becomes one huge sort.  Here rows are range
partitioned by ``(keys, order)`` with sampled bounds, and the number of a row's range
is kept.  Windows run per ``(key, range)``, so one task sorts at most the rows of one
range of one key: a burst of one key, rows of one instant and rows without a time are
split like any others, at every size of input.  Only rows equal in keys *and* whole
order (the same event id at the same instant) cannot be split.

What a range needs from the rows before it (previous timestamp, running counts, last
marker) comes from a *carry table*: one row per (key, range) of the keys that lie in
several ranges.  Each bound between two ranges is crossed by at most one key, so with n
ranges this table has at most ``2 * (n - 1)`` rows: it is broadcast with that bound.
All other keys need nothing carried.

Event rows cross the network twice (range, then the hash exchange of the window) and
are then written to the shared folder once, since the carry table and the final rows
must see the same ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmarts.session import materialize

PK = "_pk"
_RANGE = "_range"


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str],
           ranges: int | None = None) -> DataFrame:
    """``df`` with ``_pk = struct(keys..., range)``.

    One struct column is the partition key of the windows, the grouping key of the
    carry table and the join key between them: it is never NULL and compares NULL
    fields as equal.  ``ranges``: the session's shuffle partitions by default.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) for c in df.columns]
    split = df.repartitionByRange(n, *[F.col(c) for c in (*keys, *order)])
    pk = F.struct(*[F.col(k).alias(k) for k in keys], F.spark_partition_id().alias(_RANGE))
    return split.select(*cols, pk.alias(PK))


def _carry(rows: DataFrame, keys: Sequence[str], *aggs) -> DataFrame:
    """One row per (key, range) of the keys in several ranges, with the key's fields as
    ``_k0``... and ``_r``, so that windows over it share one partitioning."""
    table = rows.groupBy(PK).agg(*aggs).select(
        "*", *[F.col(PK)[k].alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(PK)[_RANGE].alias("_r"))
    whole = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))])
    return table.withColumn("_ranges", F.count(F.lit(1)).over(whole)).where(F.col("_ranges") > 1)


def _per_key(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_r")


def _with_carry(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Rows with what their range needs; keys of one range get NULLs."""
    return rows.join(F.broadcast(carry), PK, "left")


def numbered(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str,
             ranges: int | None = None) -> DataFrame:
    """Rows with their number within (key, range): the frame that is written."""
    w = Window.partitionBy(PK).orderBy(ts, tiebreak)
    return ranged(df, keys, [ts, tiebreak], ranges).withColumn("_lrank", F.row_number().over(w))


def split_row_number(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str,
                     name: str, ranges: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by ts, tiebreak)`` without
    sending a whole key to one task."""
    cols = [F.col(c) for c in df.columns]
    e = materialize(numbered(df, keys, ts, tiebreak, ranges), "numbered")
    before = _per_key(keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (_carry(e, keys, F.count(F.lit(1)).alias("_cnt"))
               .select(PK, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset")))
    offset = F.coalesce(F.col("_offset"), F.lit(0))
    return _with_carry(e, offsets).select(*cols, (offset + F.col("_lrank")).cast("long").alias(name))


def gap_windows(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, is_break,
                ranges: int | None = None) -> DataFrame:
    """Rows with all that their own range tells: the frame that is written."""
    tcol = F.col(ts)
    w = Window.partitionBy(PK).orderBy(ts, tiebreak)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    e = ranged(df, keys, [ts, tiebreak], ranges).select(
        "*", F.row_number().over(w).alias("_lrank"), F.lag(ts).over(w).alias("_lprev"),
        F.first(ts).over(run).alias("_first"))
    # Rows after a range's first: break when either timestamp is NULL or the rule
    # says so.  (A range's first row is decided by the carry table.)
    new = (F.col("_lrank") > 1) & F.coalesce(is_break(F.col("_lprev"), tcol), F.lit(True))
    return e.select("*", new.alias("_new")).select(
        *[c for c in e.columns if c != "_lprev"],
        F.max(F.when(F.col("_new"), tcol)).over(run).alias("_start"),
        F.max(F.when(F.col("_new"), F.col("_lrank"))).over(run).alias("_start_rank"))


def split_gap_sessions(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str,
                       is_break, start_col: str = "session_start_at",
                       seq_col: str = "event_sequence_number", rank_col: str | None = None,
                       ranges: int | None = None) -> DataFrame:
    """Gap sessionization of each key's ordered rows.

    ``is_break(prev_ts, ts) -> Column`` says whether a row starts a new session
    given the previous row's timestamp (the first row of a key always does).
    Adds ``start_col`` (timestamp of the session's first row; unique per key,
    since a row at the same instant as its predecessor never breaks) and
    ``seq_col`` (1-based position in the session, same total order) and, if
    ``rank_col`` is given, the session's start position in the key's order
    (unique per session even when start timestamps are NULL).  A NULL
    timestamp -- on the row or its predecessor -- always breaks, as a NULL
    difference does in SQL; NULL timestamps come first in a key's order.

    Every row but a range's first knows its predecessor within the range.  The carry
    table decides each range's first row against the last timestamp of the key's
    previous range and carries the row count and the last session start forward.
    """
    cols = [F.col(c) for c in df.columns]
    e = materialize(gap_windows(df, keys, ts, tiebreak, is_break, ranges), "gap-windows")

    wk = _per_key(keys)
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    ks = [*[f"_k{i}" for i in range(len(keys))], "_r"]
    b = _carry(e, keys, F.count(F.lit(1)).alias("_cnt"), F.first("_first").alias("_b_first"),
               F.max(ts).alias("_b_last"), F.max("_start").alias("_b_start"),
               F.max("_start_rank").alias("_b_rank"))
    b = b.select(PK, *ks, "_b_first", "_b_start", "_b_rank",
                 F.lag("_b_last").over(wk).alias("_prev_last"),
                 F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"))
    opens = F.coalesce(is_break(F.col("_prev_last"), F.col("_b_first")), F.lit(True))
    b = b.select(PK, *ks, "_offset", opens.alias("_opens"),
                 F.when(F.col("_b_rank").isNotNull(), F.col("_b_start"))
                 .when(opens, F.col("_b_first")).alias("_last_start"),
                 (F.col("_offset") + F.coalesce(F.col("_b_rank"), F.when(opens, F.lit(1))))
                 .alias("_last_rank"))
    b = b.select(PK, "_opens", "_offset", F.max("_last_start").over(before).alias("_carry_start"),
                 F.max("_last_rank").over(before).alias("_carry_rank"))
    e = _with_carry(e, b)

    local = F.col("_start_rank").isNotNull()
    opens = F.coalesce(F.col("_opens"), F.lit(True))  # a key of one range opens with its first row
    offset = F.coalesce(F.col("_offset"), F.lit(0))
    start = (F.when(local, F.col("_start")).when(opens, F.col("_first"))
             .otherwise(F.col("_carry_start")))
    rank = (F.when(local, offset + F.col("_start_rank")).when(opens, offset + 1)
            .otherwise(F.col("_carry_rank")))
    seq = offset + F.col("_lrank") - rank + 1
    extra = [rank.cast("long").alias(rank_col)] if rank_col else []
    return e.select(*cols, start.alias(start_col), seq.cast("long").alias(seq_col), *extra)


def split_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
              name: str, ranges: int | None = None) -> DataFrame:
    """``lag(value) over (partition by keys order by order)`` without sending a whole
    key to one task: a range's first row takes the value of the last row of the key's
    previous range (``max_by`` over the order, a partial aggregate)."""
    cols = [F.col(c) for c in df.columns]
    w = Window.partitionBy(PK).orderBy(*order)
    e = materialize(ranged(df, keys, order, ranges)
                    .select("*", F.row_number().over(w).alias("_lrank"),
                            F.lag(value).over(w).alias("_lag")), "lagged")
    last = (_carry(e, keys, F.max_by(value, F.col("_lrank")).alias("_last"))
            .select(PK, F.lag("_last").over(_per_key(keys)).alias("_before")))
    return _with_carry(e, last).select(
        *cols, F.when(F.col("_lrank") == 1, F.col("_before")).otherwise(F.col("_lag")).alias(name))


def split_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str,
               counted: Column | None = None, since: str = "since", ranges: int | None = None) -> DataFrame:
    """The last non-NULL ``value`` at or before each row of its key's order, without
    sending a whole key to one task: an as-of join, if ``df`` is the union of both sides.
    ``since`` is the number of ``counted`` rows after the one that gave the value, up to the row
    itself.  The carry table holds each range's last value and its count of rows.
    """
    cols = [F.col(c) for c in df.columns]
    one = F.lit(0) if counted is None else F.when(counted, 1).otherwise(0)
    w = Window.partitionBy(PK).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    e = ranged(df, keys, order, ranges).withColumn("_one", one).select(
        "*", F.row_number().over(w).alias("_lrank"), F.sum("_one").over(run).alias("_run"))
    given = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col("_run").alias("at")))
    e = materialize(e.withColumn("_given", given)
                    .withColumn("_seen", F.last("_given", ignorenulls=True).over(run)), "last-values")
    wk = _per_key(keys)
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    ks = [*[f"_k{i}" for i in range(len(keys))], "_r"]
    b = _carry(e, keys, F.sum("_one").alias("_cnt"),
               F.max_by("_given", F.when(F.col("_given").isNotNull(), F.col("_lrank"))).alias("_last"))
    b = b.select(PK, *ks, "_last", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"))
    b = b.withColumn("_last", F.when(F.col("_last").isNotNull(), F.struct(
        F.col("_last.v").alias("v"), (F.col("_offset") + F.col("_last.at")).alias("at"))))
    b = b.select(PK, "_offset", F.last("_last", ignorenulls=True).over(before).alias("_before"))
    out = _with_carry(e, b)
    here = F.col("_seen").isNotNull()
    number = F.when(here, F.col("_run") - F.col("_seen.at")).otherwise(
        F.coalesce("_offset", F.lit(0)) + F.col("_run") - F.col("_before.at"))
    return out.select(*cols, F.when(here, F.col("_seen.v")).otherwise(F.col("_before.v")).alias(name),
                      number.cast("long").alias(since))
