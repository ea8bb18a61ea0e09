"""Column expressions: all JVM-side, no Python UDFs."""

from eventmarts.functions.time import (
    iso_millis,
    minute_boundaries,
    second_boundaries,
    week_start,
    weeks_between,
)
from eventmarts.functions.keys import surrogate_key, ts_key_text, uuid5
from eventmarts.functions.math import pct

__all__ = [
    "iso_millis", "minute_boundaries", "second_boundaries", 
    "week_start", "weeks_between", "surrogate_key", "ts_key_text", "uuid5", "pct",
]
