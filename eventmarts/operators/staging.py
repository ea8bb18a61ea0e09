"""Staging (C3) and conforming (C4): bronze records -> one typed event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmarts.schema import CART_PROPS, CONFORMED_FIELDS, HISTORICAL, PURCHASE_PROPS, STREAM


def _maybe(df: DataFrame, name: str, cast: str):
    return (F.col(name) if name in df.columns else F.lit(None)).cast(cast)


def _typed_time(df: DataFrame):
    # ANSI cast: an unparseable timestamp raises rather than becoming NULL.
    ts = F.col("event_timestamp").cast("timestamp")
    return ts, F.to_date(ts)


def _json(key: str):
    return F.get_json_object(F.col("event_properties"), f"$.{key}")


def stage_stream(bronze: DataFrame) -> DataFrame:
    """Stream bronze -> 12 conformed columns + ``_ingested_dt``, ``_ingested_hour``.

    ``source`` is the tree's provenance literal, never the payload's own field.
    """
    ts, d = _typed_time(bronze)
    return bronze.select(
        "event_id", "user_id", "session_id", "event_type",
        ts.alias("event_timestamp"), d.alias("event_date"),
        _json("element_id").alias("element_id"),
        _json("url").alias("url"),
        _json("referrer").alias("referrer"),
        F.lit(None).cast("string").alias("item_id"),
        F.lit(None).cast("string").alias("transaction_id"),
        F.lit(STREAM).alias("source"),
        _maybe(bronze, "dt", "date").alias("_ingested_dt"),
        _maybe(bronze, "hour", "int").alias("_ingested_hour"),
    )


def stage_historical(bronze: DataFrame) -> DataFrame:
    """Historical bronze -> 12 conformed columns + ``_ingested_dt``."""
    ts, d = _typed_time(bronze)
    return bronze.select(
        "event_id", "user_id", "session_id", "event_type",
        ts.alias("event_timestamp"), d.alias("event_date"),
        F.lit(None).cast("string").alias("element_id"),
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("referrer"),
        _json("item_id").alias("item_id"),
        _json("transaction_id").alias("transaction_id"),
        F.lit(HISTORICAL).alias("source"),
        _maybe(bronze, "dt", "date").alias("_ingested_dt"),
    )


def conform(*staged: DataFrame) -> DataFrame:
    """Explicit 12-column projection of each staged frame, then UNION ALL."""
    out = None
    for df in staged:
        part = df.select(*CONFORMED_FIELDS)
        out = part if out is None else out.unionByName(part)
    return out


def cart_items(events_bronze: DataFrame) -> DataFrame:
    """Typed add_to_cart payload rows (session, product, price, quantity)."""
    p = F.from_json(F.col("event_properties"), CART_PROPS)
    return (events_bronze.where(F.col("event_type") == "add_to_cart")
            .select("event_id", "user_id", "session_id", p.alias("p"))
            .select("event_id", "user_id", "session_id", "p.*"))


def purchases(events_bronze: DataFrame, *keep: str) -> DataFrame:
    """Typed purchase payload rows (session, order, total, item count), with the
    columns named in ``keep``."""
    p = F.from_json(F.col("event_properties"), PURCHASE_PROPS)
    names = ("event_id", "user_id", "session_id", *keep)
    return (events_bronze.where(F.col("event_type") == "purchase")
            .select(*names, p.alias("p")).select(*names, "p.*"))
