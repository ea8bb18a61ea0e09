"""Binding of the driver's generic tables to the two bronze input shapes.

Used by ``__spark_entry__`` and the benchmark only; the library itself reads
bronze.  Both bindings read the *whole* ``events`` table:

* stream: every row becomes one stream bronze record (native session id =
  user + calendar day, event types mapped to the conformed vocabulary);
* historical: every row becomes one raw CSV record (the raw vocabulary, so the
  membership filter drops signup/error as the real dataset's extra types).

``props`` holds ``{"k": <int>}``; ``k`` feeds item ids and payload fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.functions import iso_millis
from eventmarts.sinks.bronze import record_json


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, as the scan splits it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k():
    return F.get_json_object(F.col("props"), "$.k")


def stream_bronze(events: DataFrame) -> DataFrame:
    """events -> stream bronze records (+ ``dt`` DATE, ``hour`` INT).

    ``dt``/``hour`` play the flush partition; with prompt flushing they are the
    event's own UTC date and hour.
    """
    ts = F.col("ts").cast("timestamp")  # NTZ wall time read as UTC instant
    et = (F.when(F.col("event_type") == "view", "page_view")
          .when(F.col("event_type") == "error", "add_to_cart")
          .otherwise(F.col("event_type")))
    k = _k()
    props = (
        F.when(et == "page_view", F.to_json(F.struct(
            F.concat(F.lit("/p/"), k).alias("url"), F.lit("direct").alias("referrer"))))
        .when(et == "click", F.to_json(F.struct(F.concat(F.lit("e"), k).alias("element_id"))))
        .when(et == "add_to_cart", F.to_json(F.struct(
            F.concat(F.lit("p"), k).alias("product_id"),
            F.concat(F.lit("product "), k).alias("product_name"),
            F.col("value").alias("price"), F.lit(1).alias("quantity"))))
        .when(et == "purchase", F.to_json(F.struct(
            F.concat(F.lit("o"), F.col("event_id").cast("string")).alias("order_id"),
            F.col("value").alias("total_amount"), F.lit(1).alias("item_count"),
            F.lit("card").alias("payment_method"))))
        .when(et == "signup", F.to_json(F.struct(F.lit("direct").alias("referral_source"))))
        .otherwise(F.lit("{}"))
    )
    uid = F.col("user_id").cast("string")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        uid.alias("user_id"),
        F.concat(uid, F.lit("-"), F.date_format(ts, "yyyyMMdd")).alias("session_id"),
        et.alias("event_type"),
        iso_millis(ts).alias("event_timestamp"),
        props.alias("event_properties"),
        F.lit("stream").alias("source"),
        F.to_date(ts).alias("dt"),
        F.hour(ts).alias("hour"),
    )


def raw_csv(events: DataFrame) -> DataFrame:
    """events -> raw historical CSV rows (timestamp ms, visitorid, event, itemid, transactionid)."""
    ts = F.col("ts").cast("timestamp")
    ev = (F.when(F.col("event_type") == "click", "addtocart")
          .when(F.col("event_type") == "purchase", "transaction")
          .otherwise(F.col("event_type")))
    return events.select(
        F.unix_millis(ts).alias("timestamp"),
        F.col("user_id").cast("long").alias("visitorid"),
        ev.alias("event"),
        _k().cast("long").alias("itemid"),
        F.when(ev == "transaction", F.col("event_id").cast("long")).alias("transactionid"),
    )


def replayed_raw_csv(events: DataFrame) -> DataFrame:
    """Raw rows plus a second copy of every page-view beacon (double-fired beacons)."""
    raw = raw_csv(events)
    return raw.unionByName(raw.where(F.col("event") == "view"))


def stream_records(events: DataFrame) -> DataFrame:
    """The stream binding as raw topic records: one JSON text ``value`` per event."""
    b = stream_bronze(events)
    return b.select(record_json(b).alias("value"), F.col("event_id").cast("long").alias("arrival"))


def dirty_stream_bronze(events: DataFrame) -> DataFrame:
    """A deliberately broken stream binding for the bronze gate: ``error`` rows
    keep an unknown type name, purchases lose their user, and every signup
    record is replayed once (duplicate ids)."""
    renamed = events.withColumn(
        "event_type", F.when(F.col("event_type") == "error", F.lit("error_event"))
        .otherwise(F.col("event_type")))
    b = stream_bronze(renamed)
    b = b.withColumn("user_id", F.when(F.col("event_type") == "purchase", F.lit(None).cast("string"))
                     .otherwise(F.col("user_id")))
    return b.unionByName(b.where(F.col("event_type") == "signup"))
