"""Historical CSV -> bronze records (the batch half of C2).

Row-wise mapping of the original becomes one projection of native
expressions: UUIDv5 ids, the event-type lookup, the ISO text and the
properties object are all JVM-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmarts.functions import iso_millis, uuid5
from eventmarts.schema import EVENT_ID_NAMESPACE, HISTORICAL, NATURAL_KEY, RAW_EVENT_TYPE_MAP


def keep_known_events(raw: DataFrame) -> DataFrame:
    """Keep only raw events that map to a conformed type."""
    return raw.where(F.col("event").isin(list(RAW_EVENT_TYPE_MAP)))


def dedup_natural_key(raw: DataFrame) -> DataFrame:
    """One row per natural key (visitor, timestamp, event, item).

    Exact duplicates can differ only in ``transactionid``; the survivor keeps
    the smallest non-NULL one, so the result does not depend on file order.
    An aggregate, not a window: partial aggregation collapses a hot key
    map-side before the shuffle.
    """
    return raw.groupBy(*NATURAL_KEY).agg(F.min("transactionid").alias("transactionid"))


def event_type_of(raw_event) -> F.Column:
    """Raw event name -> conformed event type (NULL when unmapped)."""
    m = F.create_map(*[F.lit(x) for kv in RAW_EVENT_TYPE_MAP.items() for x in kv])
    return m[raw_event]


def historical_event_id(raw: DataFrame | None = None) -> F.Column:
    """UUIDv5 of ``visitorid-timestamp-event-itemid`` under the fixed namespace.
    A NULL part is spelled out, so that no two keys share an id."""
    key = F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in
                            ("visitorid", "timestamp", "event", "itemid")])
    return uuid5(EVENT_ID_NAMESPACE, key)


def to_bronze(raw: DataFrame) -> DataFrame:
    """Deduplicated raw rows -> historical bronze records + partition ``dt``.

    ``event_properties`` is JSON text ``{"item_id": "..", "transaction_id": ".."}``
    with ``transaction_id`` present only when the raw row has one.
    """
    ts = F.timestamp_millis(F.col("timestamp"))
    props = F.to_json(F.struct(
        F.col("itemid").cast("string").alias("item_id"),
        F.col("transactionid").cast("string").alias("transaction_id"),
    ))
    return raw.select(
        historical_event_id().alias("event_id"),
        F.concat(F.lit("hist-"), F.col("visitorid").cast("string")).alias("user_id"),
        F.lit(None).cast("string").alias("session_id"),
        event_type_of(F.col("event")).alias("event_type"),
        iso_millis(ts).alias("event_timestamp"),
        props.alias("event_properties"),
        F.lit(HISTORICAL).alias("source"),
        F.date_format(ts, "yyyy-MM-dd").alias("dt"),
    )


def transform(raw: DataFrame) -> DataFrame:
    """Filter, deduplicate and map raw CSV rows into historical bronze records."""
    return to_bronze(dedup_natural_key(keep_known_events(raw)))
