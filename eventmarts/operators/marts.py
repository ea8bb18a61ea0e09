"""Core and product marts: event/session facts (C8), the per-source calendar
spine (C7), funnel conversion (C9), DAU/WAU/MAU (C10) and weekly cohort
retention (C11)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmarts.functions import pct, second_boundaries, week_start
from eventmarts.operators.sessions import MASK_BITS, event_masks, session_masks
from eventmarts.schema import (
    DEFAULT_SESSION_GAP_MINUTES,
    EVENT_FACT_FIELDS,
    FUNNEL_STEPS,
    SESSION_FIELDS,
)

# ---------------------------------------------------------------------------
# Facts and calendar
# ---------------------------------------------------------------------------


def event_fact(sessionized: DataFrame) -> DataFrame:
    """The 13-column event fact."""
    return sessionized.select(*EVENT_FACT_FIELDS)


def session_fact(sessions: DataFrame) -> DataFrame:
    """Sessions + ``duration_seconds`` (second boundaries, start -> end)."""
    return sessions.select(*SESSION_FIELDS,
                           second_boundaries("session_start_at", "session_end_at")
                           .cast("long").alias("duration_seconds"))


def sessions_from_fact(fact: DataFrame) -> DataFrame:
    """Session rows aggregated back from an event fact (one row per
    session_id, user_id, source) -- lets a pipeline derive sessions from the
    written fact instead of recomputing the session scan."""
    return (fact.groupBy("session_id", "user_id", "source")
            .agg(F.min("event_timestamp").alias("session_start_at"),
                 F.max("event_timestamp").alias("session_end_at"),
                 F.count(F.lit(1)).alias("event_count"))
            .select(*SESSION_FIELDS))


def date_spine(events: DataFrame, date_col: str = "event_date",
               source_col: str = "source") -> DataFrame:
    """C7 (A11 + D3): every day from each source's first to last event date."""
    bounds = events.groupBy(source_col).agg(F.min(date_col).alias("_lo"),
                                            F.max(date_col).alias("_hi"))
    return bounds.select(F.col(source_col).alias("source"),
                         F.explode(F.sequence("_lo", "_hi")).alias("date_day"))


# ---------------------------------------------------------------------------
# Funnel
# ---------------------------------------------------------------------------


def funnel(fact: DataFrame, steps: DataFrame | Iterable[tuple[str, int, str]] = FUNNEL_STEPS) -> DataFrame:
    """Sessions reaching each step and conversion percentages, from an event fact.

    A session reaches a step if it has at least one event of the step's type
    (order inside the session is not required).  Steps nobody reached are
    absent, so "start" and "previous" refer to present steps.  A step list is
    answered from session masks; a caller's own frame of steps may be of any size
    and is joined.
    """
    if not isinstance(steps, DataFrame):
        steps = list(steps)
        return funnel_of_masks(session_masks(fact, step_types(steps)), steps)
    reached = (fact.select("source", "event_type", "session_id")
               .join(steps, ["source", "event_type"])
               .groupBy("source", "step_number", F.col("event_type").alias("step_name"))
               .agg(F.countDistinct("session_id").alias("sessions_reached")))
    return _conversion(reached)


def step_types(steps: Iterable[tuple[str, int, str]]) -> list[str]:
    """The event types of a step list, in order of first use."""
    return list(dict.fromkeys(t for _, _, t in steps))


def funnel_of_masks(masks: DataFrame, steps: Iterable[tuple[str, int, str]] = FUNNEL_STEPS) -> DataFrame:
    """C9 from session masks over :func:`step_types`: any step list of the masks' types is
    answered by counting bits, one partial aggregate per source."""
    steps = list(steps)
    types = step_types(steps)
    if not steps:
        return _conversion(masks.sparkSession.createDataFrame(
            [], "source string, step_number int, step_name string, sessions_reached long"))

    def holds(i: int):
        word, bit = divmod(i, MASK_BITS)
        return F.getbit(F.col(f"mask{word}"), F.lit(bit)).cast("long")

    per_source = masks.groupBy("source").agg(
        *[F.sum(holds(i)).alias(f"_n{i}") for i in range(len(types))])
    cells = [F.struct(F.lit(source).alias("source"), F.lit(int(n)).cast("int").alias("step_number"),
                      F.lit(t).alias("step_name"), F.col(f"_n{types.index(t)}").alias("sessions_reached"))
             for source, n, t in steps]
    listed = per_source.select(F.col("source").alias("_s"), F.explode(F.array(*cells)).alias("c"))
    return _conversion(listed.where((F.col("_s") == F.col("c.source")) & (F.col("c.sessions_reached") > 0))
                       .select("c.*"))


def funnel_of_events(events: DataFrame, gap_minutes: int = DEFAULT_SESSION_GAP_MINUTES,
                     steps: Iterable[tuple[str, int, str]] = FUNNEL_STEPS) -> DataFrame:
    """C9 straight from conformed events: the funnel of their sessionized table without
    building that table."""
    steps = list(steps)
    return funnel_of_masks(event_masks(events, step_types(steps), gap_minutes), steps)


def _conversion(reached: DataFrame) -> DataFrame:
    w = Window.partitionBy("source").orderBy("step_number")
    return reached.select(
        "source", "step_number", "step_name", "sessions_reached",
        pct("sessions_reached", F.first("sessions_reached").over(w)).alias("pct_of_funnel_start"),
        pct("sessions_reached", F.lag("sessions_reached").over(w)).alias("pct_of_previous_step"),
    )


# ---------------------------------------------------------------------------
# Active users
# ---------------------------------------------------------------------------


def _user_days(fact: DataFrame) -> DataFrame:
    """Distinct (source, user, day).  A NULL user is nobody (a distinct count
    ignores NULL) and a NULL day lies in no window."""
    return (fact.select("source", "user_id", F.col("event_date").alias("d"))
            .where(F.col("user_id").isNotNull() & F.col("d").isNotNull()).distinct())


def dau(fact: DataFrame) -> DataFrame:
    """A3: distinct users per source and day (days with events only)."""
    return (fact.groupBy("source", F.col("event_date").alias("date_day"))
            .agg(F.countDistinct("user_id").alias("dau")))


def trailing_active(fact: DataFrame, spine: DataFrame, days: int, name: str) -> DataFrame:
    """W6 sweep: distinct users active in ``[d - days + 1, d]`` for every spine day.

    Each user's distinct active days are turned into disjoint coverage
    intervals ``[d, min(d + days, next active day))``; +1/-1 deltas at the
    interval ends, summed per day and run over the spine, count each user at
    most once per day.  Work is linear in user-days (no k-fold expansion), and
    the only per-key window is over one user's distinct days.
    """
    ud = _user_days(fact)
    nxt = F.lead("d").over(Window.partitionBy("source", "user_id").orderBy("d"))
    iv = ud.select("source", "d", F.least(F.date_add("d", days), nxt).alias("e"))
    deltas = (iv.select("source", F.col("d").alias("date_day"), F.lit(1).alias("x"))
              .unionByName(iv.select("source", F.col("e").alias("date_day"), F.lit(-1).alias("x")))
              .groupBy("source", "date_day").agg(F.sum("x").alias("x")))
    w = Window.partitionBy("source").orderBy("date_day").rowsBetween(Window.unboundedPreceding, 0)
    return (spine.join(deltas, ["source", "date_day"], "left")
            .select("source", "date_day",
                    F.sum(F.coalesce("x", F.lit(0))).over(w).cast("long").alias(name)))


def trailing_active_range_join(fact: DataFrame, spine: DataFrame, days: int, name: str) -> DataFrame:
    """J3/J4 + A4/A5 as a range join (spine day d joined to user-days in
    ``[d - days + 1, d]``), rewritten as an equi-join: each distinct user-day
    is listed under the ``days`` spine days it counts for.  k-fold rows, but
    hash-partitioned on (source, day) -- never one task per source."""
    ud = _user_days(fact)
    cover = ud.select("source", "user_id",
                      F.explode(F.sequence("d", F.date_add("d", days - 1))).alias("date_day"))
    return (cover.join(spine, ["source", "date_day"])
            .groupBy("source", "date_day").agg(F.countDistinct("user_id").alias(name)))


def _active_users_range_join(fact: DataFrame, spine: DataFrame | None) -> DataFrame:
    """J3-J5 in one pass: each distinct user-day is listed under the 30 spine
    days it counts for, joined to the spine once; per (day, user) the youngest
    coverage decides dau (age 0), wau (< 7) and mau (< 30)."""
    ud = _user_days(fact)
    spine = date_spine(fact) if spine is None else spine  # days of all events
    cover = ud.select("source", "user_id", "d",
                      F.explode(F.sequence("d", F.date_add("d", 29))).alias("date_day"))
    # Youngest coverage per (day, user): one grouping instead of three
    # distinct counts (which would expand every row once per count).
    ages = (cover.join(spine, ["source", "date_day"])
            .groupBy("source", "date_day", "user_id")
            .agg(F.min(F.datediff("date_day", "d")).alias("age")))
    counts = (ages.groupBy("source", "date_day")
              .agg(F.count(F.when(F.col("age") == 0, 1)).alias("dau"),
                   F.count(F.when(F.col("age") < 7, 1)).alias("wau"),
                   F.count(F.lit(1)).alias("mau")))
    return (spine.join(counts, ["source", "date_day"], "left")
            .select("source", "date_day",
                    *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                      for c in ("dau", "wau", "mau")]))


def active_users(fact: DataFrame, spine: DataFrame | None = None, method: str = "sweep") -> DataFrame:
    """One row per spine day with dau, wau (7 days), mau (30 days); 0 when idle.

    ``sweep`` (default) works from the distinct user-days in one pass: each
    user-day emits its DAU mark and the +1/-1 deltas of both trailing
    windows as three exploded rows.  One aggregate per (source, day) and one
    running sum over the spine give all three measures.  ``range_join`` is
    the range-join formulation (k-fold expansion per window).
    """
    if method != "sweep":
        return _active_users_range_join(fact, spine)

    ud = _user_days(fact)
    if spine is None:
        spine = date_spine(fact)  # days of all events, of users or not
    nxt = F.lead("d").over(Window.partitionBy("source", "user_id").orderBy("d"))
    iv = ud.select("source", "d", nxt.alias("n"))

    def mark(day, a, w, m):
        return F.struct(day.alias("date_day"), F.lit(a).alias("a"), F.lit(w).alias("w"),
                        F.lit(m).alias("m"))

    marks = iv.select("source", F.explode(F.array(
        mark(F.col("d"), 1, 1, 1),
        mark(F.least(F.date_add("d", 7), F.col("n")), 0, -1, 0),
        mark(F.least(F.date_add("d", 30), F.col("n")), 0, 0, -1))).alias("x"))
    per_day = (marks.groupBy("source", F.col("x.date_day").alias("date_day"))
               .agg(F.sum("x.a").alias("a"), F.sum("x.w").alias("w"), F.sum("x.m").alias("m")))
    run = Window.partitionBy("source").orderBy("date_day").rowsBetween(Window.unboundedPreceding, 0)
    return (spine.join(per_day, ["source", "date_day"], "left")
            .select("source", "date_day",
                    F.coalesce(F.col("a"), F.lit(0)).cast("long").alias("dau"),
                    F.sum(F.coalesce(F.col("w"), F.lit(0))).over(run).cast("long").alias("wau"),
                    F.sum(F.coalesce(F.col("m"), F.lit(0))).over(run).cast("long").alias("mau")))


# ---------------------------------------------------------------------------
# Retention
# ---------------------------------------------------------------------------


def user_weeks(fact: DataFrame, user_col: str = "user_id", date_col: str = "event_date",
               source_col: str = "source") -> DataFrame:
    """Distinct (source, user, Monday of activity week)."""
    return fact.select(F.col(source_col).alias("source"), F.col(user_col).alias("user_id"),
                       week_start(date_col).alias("activity_week")).distinct()


def cohorts(weeks: DataFrame) -> DataFrame:
    """Each user's cohort week (first activity week), as a window over the
    user's distinct weeks -- no join back.  A join by user drops rows without a
    user, and one by cohort week drops users without any dated week."""
    w = Window.partitionBy("source", "user_id")
    return (weeks.where(F.col("user_id").isNotNull())
            .withColumn("cohort_week", F.min("activity_week").over(w))
            .where(F.col("cohort_week").isNotNull()))


#: A Monday; weeks are counted from here.
_WEEK_ZERO = "1970-01-05"
#: Weeks per mask word: the bits of a long without its sign.
_WEEK_BITS = 63


def _user_weeks_set(fact: DataFrame, user_col: str, date_col: str, source_col: str) -> DataFrame:
    """One row per (source, user): ``weeks``, the numbers of its active weeks, and
    ``undated``, whether an event has no date.  The set is built map-side and holds a user's
    weeks, 53 a year at most, however many events the user has."""
    week = F.expr(f"cast(datediff(_week, date'{_WEEK_ZERO}') div 7 as int)")
    rows = fact.select(F.col(source_col).alias("source"), F.col(user_col).alias("user_id"),
                       week_start(date_col).alias("_week"))
    return rows.groupBy("source", "user_id").agg(
        F.collect_set(week).alias("weeks"), F.max(F.col("_week").isNull()).alias("undated"))


def _week_date(number) -> Column:
    return F.date_add(F.lit(_WEEK_ZERO).cast("date"), (number * 7).cast("int"))


def cohort_sizes(fact: DataFrame, user_col: str = "user_id", date_col: str = "event_date",
                 source_col: str = "source") -> DataFrame:
    """Distinct users per (source, cohort week).  Users without a dated week
    form the NULL cohort; the NULL user has a cohort but counts for nobody."""
    per_user = _user_weeks_set(fact, user_col, date_col, source_col)
    return (per_user.select("source", "user_id", _week_date(F.array_min("weeks")).alias("cohort_week"))
            .groupBy("source", "cohort_week").agg(F.count("user_id").alias("cohort_size")))


def week_masks(fact: DataFrame, user_col: str = "user_id", date_col: str = "event_date",
               source_col: str = "source") -> DataFrame:
    """``source, cohort, mask, undated, users``: how many users share an activity pattern.

    ``mask`` is an array of longs: bit ``i`` of word ``k`` says whether the user was active
    ``63 k + i`` weeks after the cohort week, so its lowest bit is the cohort week itself.
    User rows are moved once (the grouping by user); patterns are few and are summed
    map-side."""
    per_user = _user_weeks_set(fact, user_col, date_col, source_col).where(
        F.col("user_id").isNotNull() & (F.size("weeks") > 0))
    since = per_user.select("source", "undated", F.array_min("weeks").alias("cohort"),
                            F.expr("transform(weeks, w -> w - array_min(weeks))").alias("since"))
    mask = F.expr(f"""transform(sequence(0, array_max(since) div {_WEEK_BITS}), k -> cast(aggregate(
        filter(since, x -> x div {_WEEK_BITS} = k), 0L,
        (word, x) -> word | shiftleft(1L, x % {_WEEK_BITS})) as bigint))""")
    return (since.select("source", "cohort", mask.alias("mask"), "undated")
            .groupBy("source", "cohort", "mask", "undated").agg(F.count(F.lit(1)).alias("users")))


def retention(fact: DataFrame, user_col: str = "user_id", date_col: str = "event_date",
              source_col: str = "source") -> DataFrame:
    """C11: retained users and rate per (source, cohort week, weeks since cohort).

    From week masks: a cell is the number of users whose mask has its bit.  The cohort size is
    the week-0 cell (every user is active in their cohort week), spread over its cohort
    by a window over the small aggregated table instead of a join.  Weeks without a date
    form a cell of their own (NULL weeks since).  Empty cells are absent.
    """
    set_bits = F.expr(f"""flatten(transform(mask, (word, k) -> transform(
        filter(sequence(0, {_WEEK_BITS - 1}), i -> getbit(word, i) = 1),
        i -> cast(k * {_WEEK_BITS} + i as bigint))))""")
    nothing = F.array(F.lit(None).cast("long"))
    weeks = F.when(F.col("undated"), F.concat(set_bits, nothing)).otherwise(set_bits)
    cells = (week_masks(fact, user_col, date_col, source_col)
             .select("source", "cohort", "users", F.explode(weeks).alias("weeks_since_cohort"))
             .groupBy("source", "cohort", "weeks_since_cohort").agg(F.sum("users").alias("retained_users")))
    w = Window.partitionBy("source", "cohort")
    size = F.max(F.when(F.col("weeks_since_cohort") == 0, F.col("retained_users"))).over(w)
    return (cells.withColumn("cohort_size", size)
            .select("source", _week_date(F.col("cohort")).alias("cohort_week"), "weeks_since_cohort",
                    "cohort_size", "retained_users",
                    pct("retained_users", "cohort_size").alias("retention_rate")))
