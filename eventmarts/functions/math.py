"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct(part, whole, digits: int = 2) -> Column:
    """round(100 * part / whole, digits) as DOUBLE; NULL when whole is 0 or NULL."""
    return F.round(F.lit(100.0) * _col(part) / F.nullif(_col(whole), F.lit(0)), digits)
