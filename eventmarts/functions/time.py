"""Time arithmetic with the boundary-count semantics of SQL ``datediff(unit, a, b)``.

``datediff('minute', a, b)`` counts minute boundaries crossed between a and b,
not whole elapsed minutes: 10:00:59 -> 10:31:01 is 31, although only 30 min 2 s
elapsed.  Spark's ``timestampdiff`` counts elapsed units, so it is not used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS_PER_MINUTE = 60_000_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minute_boundaries(a, b) -> Column:
    """Number of minute boundaries between timestamps a and b (b - a)."""
    a, b = _col(a), _col(b)
    # date_trunc makes the micros an exact multiple, so integral division is exact.
    return (F.unix_micros(F.date_trunc("minute", b)).cast("long") / F.lit(_MICROS_PER_MINUTE)).cast("long") - (
        F.unix_micros(F.date_trunc("minute", a)).cast("long") / F.lit(_MICROS_PER_MINUTE)
    ).cast("long")


def second_boundaries(a, b) -> Column:
    """Number of second boundaries between timestamps a and b (b - a)."""
    return F.unix_seconds(_col(b)) - F.unix_seconds(_col(a))


def week_start(d) -> Column:
    """Monday of the ISO week containing date/timestamp d, as DATE."""
    return F.trunc(F.to_date(_col(d)), "week")


def weeks_between(a, b) -> Column:
    """Whole weeks between two Mondays a <= b."""
    return F.floor(F.datediff(_col(b), _col(a)) / F.lit(7)).cast("long")


def iso_millis(ts) -> Column:
    """ISO-8601 UTC text with millisecond precision and a 'Z' suffix."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
