"""Schemas and fixed vocabularies of the event model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the modelled pipeline's constants exactly.
# ---------------------------------------------------------------------------
# Closed set of conformed event types.
EVENT_TYPES = ("page_view", "click", "add_to_cart", "signup", "purchase")

# Raw historical CSV event name -> conformed event type.
RAW_EVENT_TYPE_MAP = {
    "view": "page_view",
    "addtocart": "add_to_cart",
    "transaction": "purchase",
}

# Namespace of the deterministic UUIDv5 historical event ids.
EVENT_ID_NAMESPACE = "6f1c1f0e-2b3a-4b8a-9c7a-8e5f6a1d2c3b"

# Provenance literals, one per bronze tree.
STREAM = "stream"
HISTORICAL = "batch_historical"

# Per-source funnel definitions: (source, step_number, event_type).
FUNNEL_STEPS = (
    ("stream", 1, "page_view"),
    ("stream", 2, "click"),
    ("stream", 3, "add_to_cart"),
    ("stream", 4, "purchase"),
    ("batch_historical", 1, "page_view"),
    ("batch_historical", 2, "add_to_cart"),
    ("batch_historical", 3, "purchase"),
)

# Fields every bronze record must carry (quality gate).
REQUIRED_FIELDS = ("event_id", "user_id", "event_type", "event_timestamp")

# Default inactivity gap for inferred sessions, minutes.
DEFAULT_SESSION_GAP_MINUTES = 30

# Default rows per written historical bronze file.
DEFAULT_CHUNK_SIZE = 50_000
# ---------------------------------------------------------------------------

_s = T.StringType()

# Bronze record as read from newline-JSON; everything pinned to STRING, the
# payload object kept as raw JSON text.
BRONZE = T.StructType([
    T.StructField("event_id", _s),
    T.StructField("user_id", _s),
    T.StructField("session_id", _s),
    T.StructField("event_type", _s),
    T.StructField("event_timestamp", _s),
    T.StructField("event_properties", _s),
    T.StructField("source", _s),
])

BRONZE_FIELDS = tuple(f.name for f in BRONZE.fields)

# Raw historical CSV with an explicit schema (no inference).
RAW_CSV = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("visitorid", T.LongType()),
    T.StructField("event", _s),
    T.StructField("itemid", T.LongType()),
    T.StructField("transactionid", T.DecimalType(28, 6)),
])

NATURAL_KEY = ("visitorid", "timestamp", "event", "itemid")

CONFORMED = T.StructType([
    T.StructField("event_id", _s),
    T.StructField("user_id", _s),
    T.StructField("session_id", _s),
    T.StructField("event_type", _s),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("element_id", _s),
    T.StructField("url", _s),
    T.StructField("referrer", _s),
    T.StructField("item_id", _s),
    T.StructField("transaction_id", _s),
    T.StructField("source", _s),
])

CONFORMED_FIELDS = tuple(f.name for f in CONFORMED.fields)

EVENT_FACT_FIELDS = (
    "event_id", "user_id", "session_id", "event_sequence_number", "event_type",
    "event_timestamp", "event_date", "element_id", "url", "referrer", "item_id",
    "transaction_id", "source",
)

SESSION_FIELDS = ("session_id", "user_id", "source", "session_start_at",
                  "session_end_at", "event_count")

# Typed projections of the cart / purchase payload keys.
CART_PROPS = "product_id string, product_name string, price double, quantity int"
PURCHASE_PROPS = ("order_id string, total_amount double, item_count int, "
                  "payment_method string")
