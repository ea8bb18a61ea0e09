"""Serving reads over the marts (C12): one DataFrame per dashboard question.

Each takes the mart frames (or tables) and an optional ``source`` filter.
Orders are explicit because a table has no order of its own in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _src(df: DataFrame, source: str | None) -> DataFrame:
    return df if source is None else df.where(F.col("source") == F.lit(source))


def list_sources(fct_events: DataFrame) -> DataFrame:
    """Distinct sources, ordered."""
    return fct_events.select("source").distinct().orderBy("source")


def overview_kpis(fct_events: DataFrame, fct_sessions: DataFrame,
                  source: str | None = None) -> DataFrame:
    """A12 + A13 in one row per source: events, sessions, first and last date.

    Without ``source`` every source gets its row (one pass over each fact)."""
    ev = (_src(fct_events, source).groupBy("source")
          .agg(F.count(F.lit(1)).alias("total_events"),
               F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date")))
    se = _src(fct_sessions, source).groupBy("source").agg(F.count(F.lit(1)).alias("total_sessions"))
    return (ev.join(se, "source", "full")
            .select("source", F.coalesce("total_events", F.lit(0)).alias("total_events"),
                    F.coalesce("total_sessions", F.lit(0)).alias("total_sessions"),
                    "min_date", "max_date"))


def event_mix(fct_events: DataFrame, source: str | None = None) -> DataFrame:
    """Events per type, most frequent first (type breaks ties)."""
    mix = (_src(fct_events, source).groupBy("source", "event_type")
           .agg(F.count(F.lit(1)).alias("event_count")))
    return ranked(mix, F.desc("event_count"), "event_type")


def ranked(df: DataFrame, *order) -> DataFrame:
    """``df`` in ``order`` with its place there as ``position`` (1, 2, ...).

    For the aggregated marts of the serving layer: a few thousand rows, and one
    window per source.
    """
    w = Window.partitionBy("source").orderBy(*order)
    return (df.withColumn("position", F.row_number().over(w).cast("long"))
            .orderBy("source", "position"))


def read_funnel(mart: DataFrame, source: str | None = None) -> DataFrame:
    return ranked(_src(mart, source), "step_number")


def read_active_users(mart: DataFrame, source: str | None = None) -> DataFrame:
    return ranked(_src(mart, source), "date_day")


def read_retention(mart: DataFrame, source: str | None = None) -> DataFrame:
    return ranked(_src(mart, source), "cohort_week", "weeks_since_cohort")


def matrix_weeks(mart: DataFrame, source: str | None = None) -> list[int]:
    """Weeks 0 to the mart's own last one (one aggregate, one number)."""
    last = _src(mart, source).agg(F.max("weeks_since_cohort")).first()[0]
    return list(range(int(last) + 1)) if last is not None else []


def retention_matrix(mart: DataFrame, weeks: Sequence[int] | None = None,
                     source: str | None = None) -> DataFrame:
    """Cohort x weeks-since pivot of the retention rate.

    Without ``weeks`` the columns run to the mart's last week.  A given list fixes
    the schema; it is refused if it leaves a cell out.  Columns are named
    ``w<k>``; empty cells are NULL.  (The cell of undated weeks has no column.)
    """
    rows = _src(mart, source)
    if weeks is None:
        weeks = matrix_weeks(rows)
    else:
        weeks = [int(w) for w in weeks]
        missed = rows.where(~F.col("weeks_since_cohort").isin(weeks)).limit(1).collect()
        if missed:
            raise ValueError(f"week {missed[0]['weeks_since_cohort']} has no column")
    p = (rows.groupBy("source", "cohort_week")
         .pivot("weeks_since_cohort", weeks or [0]).agg(F.first("retention_rate")))
    return p.select("source", "cohort_week", *[F.col(str(w)).alias(f"w{w}") for w in weeks])


def register_models(models: dict[str, DataFrame]) -> None:
    """K5: expose models as temporary views (staging/intermediate are views
    in the original warehouse) so serving SQL can address them by name."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)


def serve(spark, table: str, source: str, order_by: Sequence[str] = ()) -> DataFrame:
    """P10: read a registered model for one source through parameterized SQL
    (table name and source are bound parameters, never interpolated text)."""
    df = spark.sql("SELECT * FROM IDENTIFIER(:table) WHERE source = :source",
                   args={"table": table, "source": source})
    return df.orderBy(*order_by) if order_by else df
