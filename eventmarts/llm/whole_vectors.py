"""Embeddings as whole numbers, for operators whose results are exact.

``floor(scale * c) + shift`` of each component as a long.  A vector counts if it is not
null or empty, holds no null or non-finite component, and has the table's length: the
length that most such vectors have (ties: the longer), since vectors of other lengths
lie in another space.  Components beyond ``limit`` times 1/scale cannot be carried exactly
and count as non-finite.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Default bound on |scale * c|.
LIMIT = 2.0 ** 50


def sound(embedding: str, scale: float, limit: Column) -> Column:
    """No null, no non-finite and no overly large component."""
    v = F.col(embedding).cast("array<double>")
    within = F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c * scale) < limit), F.lit(False)))
    return F.coalesce((F.size(embedding) > 0) & within, F.lit(False))


def quantised(vectors: DataFrame, scale: int, shift: int = 0, limit: Column | None = None,
              name: str = "x", embedding: str = "embedding") -> DataFrame:
    """Rows of ``vectors`` that count, with ``name`` (array of longs) in place of the embedding."""
    others = [F.col(c) for c in vectors.columns if c != embedding]
    whole = F.transform(F.col(embedding).cast("array<double>"),
                        lambda c: F.floor(c * F.lit(float(scale))) + F.lit(shift).cast("long"))
    return (vectors.where(sound(embedding, float(scale), F.lit(LIMIT) if limit is None else limit))
            .select(*others, whole.alias(name)))


def of_common_length(rows: DataFrame, name: str = "x") -> tuple[DataFrame, int]:
    """The rows of the table's length, and that length (0: no rows)."""
    lengths = (rows.groupBy(F.size(name).alias("d")).count()
               .orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    dim = lengths[0]["d"] if lengths else 0
    return rows.where(F.size(name) == dim), dim


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) longs of an Arrow list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
