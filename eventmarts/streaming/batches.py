"""Stream ingest by whole micro-batches: replays of any age (T5, K3) and a quality gate (Q1-Q4, Q14).

Each micro-batch owns one folder ``run=<query>/batch=<n>`` of the bronze tree and replaces it as a
whole, so a batch that is tried again changes nothing.  ``run`` is the query's id, which lives in its
checkpoint: a new checkpoint is a new run and never meets the folders of another.

With ``landed`` (a folder of :mod:`eventmarts.streaming.landed`) an event id of an event date lands once,
however late its replay and whichever run brings it; the tree and its state belong together.  Of
several records of one id in a batch the least text lands.  A batch writes its folder first and its
state second; a crash between them is mended by the retry, and without one (the checkpoint is lost
as well) the batch's records may land again but are never missing.  Records without an id cannot be
told apart and all land.

With ``gated`` every line is judged on the way: good lines lie under ``verdict=good``, the others,
verbatim, beside them under the reason, in the same folder by the same write.  The counts are observed
by that write and kept per batch (``gate_report``).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmarts.schema import EVENT_TYPES, REQUIRED_FIELDS
from eventmarts.sinks.bronze import observed
from eventmarts.sources.bronze import read_stream_bronze
from eventmarts.streaming.ingest import bronze_frame
from eventmarts.streaming.landed import LandedIds, event_date, placed

GOOD, MALFORMED, MISSING, UNKNOWN = "good", "malformed", "missing_field", "unknown_type"
VERDICTS = (GOOD, MALFORMED, MISSING, UNKNOWN)
REPORTS = "_gate"  # a leading underscore: no reader of the tree sees it


def verdict(value: Column, required: Sequence[str] = REQUIRED_FIELDS,
            allowed: Sequence[str] = EVENT_TYPES) -> Column:
    """The gate's word on a raw line: no JSON object, a required field that is absent or null, an
    event type outside the vocabulary, or good."""
    absent = [F.get_json_object(value, f"$.{c}").isNull() for c in required]
    missing = absent[0]
    for a in absent[1:]:
        missing = missing | a
    return (F.when(F.json_object_keys(value).isNull(), MALFORMED)
            .when(missing, MISSING)
            .when(~F.get_json_object(value, "$.event_type").isin(list(allowed)), UNKNOWN)
            .otherwise(GOOD))


def ingest_batches(raw: DataFrame, out: str, checkpoint: str, *, landed: str | None = None,
                   gated: bool = False, trigger: dict | None = None) -> StreamingQuery:
    """C1 by batches: stream ``raw`` (one STRING ``value`` per record) into the tree ``out``."""

    def take(batch: DataFrame, number: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        land_batch(batch, out, run, number, landed, gated)

    return (raw.select("value").writeStream.foreachBatch(take)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def land_batch(batch: DataFrame, out: str, run: str, number: int, landed: str | None = None,
               gated: bool = False) -> None:
    """What one micro-batch does; doing it again leaves the same rows."""
    if landed is None:
        _write(batch.select("value"), out, run, number, gated)
        return
    spark = batch.sparkSession
    state = LandedIds(spark, landed, run, number)
    event_id = F.get_json_object("value", "$.event_id")
    once = (batch.where(event_id.isNotNull())
            .groupBy(event_date(F.col("value")).alias("event_date"), event_id.alias("event_id"))
            .agg(F.min("value").alias("value")))
    try:
        records = state.keep(placed(once), "records")  # parsed and grouped once
        fresh = state.unseen(records)
        _write(fresh.select("value").unionByName(batch.where(event_id.isNull()).select("value")),
               out, run, number, gated)
        ids = fresh if fresh is records else state.keep(fresh.drop("value"), "fresh")
        state.add(ids)
        state.merge(sorted(r[0] for r in ids.select("event_date").distinct().collect()))
    finally:
        state.release()


def _write(lines: DataFrame, out: str, run: str, number: int, gated: bool) -> None:
    place = os.path.join(f"run={run}", f"batch={number}")
    rows, by = bronze_frame(lines), ["dt", "hour"]
    if gated:
        rows, by = rows.withColumn("verdict", verdict(F.col("value"))), ["verdict", *by]
        counts = Observation("gate")
        rows = rows.observe(counts, *[F.count(F.when(F.col("verdict") == v, 1)).alias(v) for v in VERDICTS])
    rows.write.mode("overwrite").partitionBy(*by).text(os.path.join(out, place))
    if gated:
        got = observed(counts, **dict.fromkeys(VERDICTS, 0))
        (lines.sparkSession.createDataFrame([(v, int(got[v])) for v in VERDICTS], "verdict string, lines long")
         .coalesce(1).write.mode("overwrite").parquet(os.path.join(out, REPORTS, place)))


def read_gated(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(good, dead): the good records with the bronze schema, and the other lines with their reason."""
    good = read_stream_bronze(spark, out).where(F.col("verdict") == GOOD)
    dead = spark.read.text(out).where(F.col("verdict") != GOOD)
    return good, dead


def gate_report(spark: SparkSession, out: str) -> DataFrame:
    """``run, batch, verdict, lines``: what the gate counted while it wrote."""
    return spark.read.parquet(os.path.join(out, REPORTS))
