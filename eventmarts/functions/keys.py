"""Deterministic keys built from native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the null placeholder of the surrogate-key convention being matched.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_key_text(ts) -> Column:
    """Text of a UTC instant the way a timestamptz prints: ``2015-01-05 10:16:40.1+00``.

    Spark's cast to string trims trailing fractional zeros like the SQL engine
    does; the zone suffix is appended (session zone must be UTC).
    """
    return F.concat(_col(ts).cast("string"), F.lit("+00"))


def surrogate_key(*parts) -> Column:
    """md5 of the parts' text joined by '-', NULL parts replaced by a placeholder."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit(NULL_KEY_TEXT)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def uuid5(namespace: str, name) -> Column:
    """RFC 4122 version-5 UUID of ``name`` (text column) under ``namespace``.

    sha1(namespace bytes || utf-8 name), first 16 bytes, version nibble set to 5,
    variant bits set to 10xx, printed 8-4-4-4-12.
    """
    ns_hex = namespace.replace("-", "")
    h = F.sha1(F.concat(F.unhex(F.lit(ns_hex)), F.encode(_col(name), "UTF-8")))
    variant_nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
    new_variant = F.element_at(
        F.array(F.lit("8"), F.lit("9"), F.lit("a"), F.lit("b")), (variant_nibble % 4) + 1
    )
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"),
        F.substring(h, 9, 4), F.lit("-"),
        F.lit("5"), F.substring(h, 14, 3), F.lit("-"),
        new_variant, F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12),
    )
