"""Bloom filters over 64-bit hashes: a bounded broadcast in front of a large exchange.

The filter is built by Spark's bitmap aggregates (one row of 4 KB per 32,768 bits, combined
map-side), comes to the driver as at most ``2**MOST_BITS / 8`` bytes and is tested in
Arrow batches of the hash column alone.  It may let a row through that is not among the
hashes (rarely, while they are fewer than a tenth of its bits; ever more often beyond that),
and never holds one back: a caller settles the rows that pass exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS, HASHES = 15, 28, 4
_BITMAP = 32_768  # bits per bitmap of the bitmap aggregates


def _probes(h: Column, bits: int) -> list[Column]:
    mask = F.lit((1 << bits) - 1).cast("long")
    step = F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1).cast("long"))
    return [(h.bitwiseAND(mask) + step.bitwiseAND(mask) * k).bitwiseAND(mask) for k in range(HASHES)]


class Bloom:
    """The filter of a column of 64-bit hashes."""

    def __init__(self, hashes: DataFrame, column: str):
        spark = hashes.sparkSession
        n = hashes.count()
        self.bits = min(max((10 * n).bit_length(), LEAST_BITS), MOST_BITS)
        places = F.array(*[p + 1 for p in _probes(F.col(column), self.bits)])
        rows = (hashes.select(F.explode(places).alias("p"))
                .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))
                .collect())  # at most 2**MOST_BITS bits in all
        filled = np.zeros(1 << (self.bits - 3), np.uint8)
        for r in rows:
            at = (r["bucket"] - 1) * (_BITMAP // 8)
            filled[at:at + _BITMAP // 8] = np.frombuffer(r["bitmap"], np.uint8)
        self._shared = spark.sparkContext.broadcast(filled)

    def may_hold(self, h: Column) -> Column:
        """False only for hashes that were not among the filter's."""
        shared, mask = self._shared, np.uint64((1 << self.bits) - 1)

        @F.pandas_udf("boolean")
        def test(values: pd.Series) -> pd.Series:
            filled = shared.value
            x = values.to_numpy(np.int64).view(np.uint64)
            step = ((x >> np.uint64(32)) | np.uint64(1)) & mask
            out = np.ones(len(x), bool)
            for k in range(HASHES):
                p = ((x & mask) + step * np.uint64(k)) & mask
                out &= (filled[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
            return pd.Series(out)

        return test(h)
