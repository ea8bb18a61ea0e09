"""Raw inputs: the historical CSV (S4), the event stream (S5) and the
constant funnel-step relation (S7)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.schema import FUNNEL_STEPS, RAW_CSV


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The raw historical CSV with an explicit schema (no inference).

    Transaction ids may be written with a fraction (``4000.0``); they are whole
    numbers."""
    raw = (spark.read.schema(RAW_CSV).option("header", "true")
           .option("mode", "FAILFAST").csv(path))
    return raw.withColumn("transactionid", F.col("transactionid").cast("long"))


def read_event_stream(spark: SparkSession, kind: str = "kafka", *,
                      path: str | None = None, topic: str | None = None,
                      bootstrap_servers: str | None = None,
                      min_offsets_per_trigger: int | None = None,
                      max_trigger_delay: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """An unbounded frame with one STRING column ``value`` (the raw event JSON).

    ``kind='kafka'`` subscribes to ``topic`` from the earliest offset; the pair
    ``min_offsets_per_trigger`` / ``max_trigger_delay`` gives the "N messages or
    T seconds, whichever first" flush rule.  ``kind='text'`` reads newline
    records from files landing in ``path`` (tests, or a landing bucket).
    Records without a value are skipped.
    """
    if kind == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap_servers)
                  .option("subscribe", topic)
                  .option("startingOffsets", "earliest"))
        if min_offsets_per_trigger is not None:
            reader = reader.option("minOffsetsPerTrigger", str(min_offsets_per_trigger))
        if max_trigger_delay is not None:
            reader = reader.option("maxTriggerDelay", max_trigger_delay)
        df = reader.load().select(F.col("value").cast("string").alias("value"))
    elif kind == "text":
        reader = spark.readStream.format("text")
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        df = reader.load(path)
    else:
        raise ValueError(f"unknown stream kind {kind!r}")
    return df.where(F.col("value").isNotNull())


def funnel_steps(spark: SparkSession,
                 steps: Iterable[tuple[str, int, str]] = FUNNEL_STEPS) -> DataFrame:
    """The per-source step list as a small constant relation."""
    return spark.createDataFrame(
        list(steps), "source string, step_number int, event_type string")
