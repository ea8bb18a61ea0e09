"""End-to-end jobs: historical ingest (C2) and the model build (C14).

``run_pipeline``: quality gate -> build models -> model tests -> publish.  Every model
is written once, in its final layout, to a folder of the run and read back from there,
which cuts lineage (a lost executor recomputes from the written table, not from bronze)
and lets every later model and test scan columnar data.  After all tests have passed one
small file makes the run's folders the current version (:mod:`eventmarts.sinks.publish`):
readers see all of the old tables or all of the new ones.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventmarts.operators import historical, marts, quality, sessions, staging
from eventmarts.schema import DEFAULT_CHUNK_SIZE, DEFAULT_SESSION_GAP_MINUTES
from eventmarts.sinks.bronze import observed, write_historical_bronze, write_mart
from eventmarts.sinks.publish import current, publish
from eventmarts.sources.bronze import read_historical_bronze, read_stream_bronze
from eventmarts.sources.raw import read_raw_csv


@dataclass
class IngestResult:
    rows_read: int
    rows_dropped: int
    rows_written: int
    files: int


def ingest_historical(spark: SparkSession, csv_path: str, out: str,
                      max_records_per_file: int = DEFAULT_CHUNK_SIZE) -> IngestResult:
    """Raw CSV -> filtered, deduplicated, keyed bronze JSON by event date.

    Counts come from ``observe`` metrics of the write itself (A18), so the
    input is not scanned a second time for them.
    """
    seen = Observation("rows_read")
    raw = historical.keep_known_events(read_raw_csv(spark, csv_path))
    raw = raw.observe(seen, F.count(F.lit(1)).alias("n"))
    dedup = historical.dedup_natural_key(raw)
    n_kept, files = write_historical_bronze(historical.to_bronze(dedup), out, max_records_per_file)
    n_read = int(observed(seen, n=0)["n"])
    return IngestResult(n_read, n_read - n_kept, n_kept, files)


@dataclass
class Paths:
    stream_bronze: str
    historical_bronze: str
    warehouse: str


def build_models(stream_bronze: DataFrame, historical_bronze: DataFrame,
                 gap_minutes: int = DEFAULT_SESSION_GAP_MINUTES) -> dict[str, DataFrame]:
    """All models, lazily, keyed by their warehouse names."""
    stg_s = staging.stage_stream(stream_bronze)
    stg_h = staging.stage_historical(historical_bronze)
    unioned = staging.conform(stg_s, stg_h)
    fct = marts.event_fact(sessions.sessionize(unioned, gap_minutes))
    sess = sessions.sessions(unioned, gap_minutes)
    return {
        "stg_events_stream": stg_s,
        "stg_events_historical": stg_h,
        "int_events_unioned": unioned,
        "int_sessions": sess,
        "int_sessionized_events": fct,
        "fct_events": fct,
        "fct_sessions": marts.session_fact(sess),
        "dim_date": marts.date_spine(unioned),
    }


def run_pipeline(spark: SparkSession, paths: Paths,
                 gap_minutes: int = DEFAULT_SESSION_GAP_MINUTES, gate: bool = True,
                 tests: Sequence[tuple] = quality.MODEL_TESTS) -> dict[str, str]:
    """C14: stage and gate the bronze trees, build and test the models, publish them.

    Returns table name -> Parquet path (staged tables, facts, spine, marts) of this run;
    ``read_mart(spark, f"{warehouse}/{table}")`` reads whatever version is current.
    Raises on a failed gate or test, and then leaves the published version alone.
    """
    before = current(spark, paths.warehouse)
    run = os.path.join("_runs", uuid.uuid4().hex)
    built: dict[str, DataFrame] = {}

    def build(name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = os.path.join(paths.warehouse, run, name)
        write_mart(df, path, partition_by)
        built[name] = spark.read.parquet(path)
        return built[name]

    # Each bronze tree is parsed once; the gate reads the staged columns.
    stg_s = build("stg_events_stream", staging.stage_stream(
        read_stream_bronze(spark, paths.stream_bronze)))
    stg_h = build("stg_events_historical", staging.stage_historical(
        read_historical_bronze(spark, paths.historical_bronze)))
    if gate:
        quality.raise_on_failure(quality.bronze_checks(stg_h))
    unioned = staging.conform(stg_s, stg_h)

    # The event fact is written once; sessions and marts are derived from the written
    # table (no second session scan).  It is partitioned by source, which serving reads
    # filter on, and clustered by date, so that a dated read prunes.
    fct = build("fct_events", marts.event_fact(sessions.sessionize(unioned, gap_minutes))
                .repartitionByRange("source", "event_date", "event_id"), ("source",))
    # Sessions of events that cannot be attached (NULL user or time) exist in
    # the session table but not in the fact; a pushed-down NULL filter finds them.
    unattached = sessions.gap_sessions(
        unioned.where(F.col("user_id").isNull() | F.col("event_timestamp").isNull()), gap_minutes)
    fs = build("fct_sessions", marts.session_fact(
        marts.sessions_from_fact(fct).unionByName(unattached)), ("source",))
    dd = build("dim_date", marts.date_spine(unioned))  # days of all events, attached or not
    build("mart_funnel_analysis", marts.funnel(fct))
    build("mart_dau_wau_mau", marts.active_users(fct, dd))
    build("mart_retention", marts.retention(fct))

    results = quality.run_model_tests(
        {**built, "int_events_unioned": unioned, "int_sessionized_events": fct, "int_sessions": fs},
        tests)
    bad = results.where(~F.col("passed")).collect()  # at most one row per declared test
    if bad:
        raise AssertionError("model tests failed: " + "; ".join(
            f"{r['model']}.{r['column']} {r['test']} ({r['failures']})" for r in bad))

    publish(spark, paths.warehouse, {name: {"": os.path.join(run, name)} for name in built}, before.number)
    return {name: os.path.join(paths.warehouse, run, name) for name in built}
