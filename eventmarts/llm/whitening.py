"""Embedding whitening: principal components of quantised vectors, scaled to unit variance.

1. Vectors become whole numbers ``x = floor(64 * c) + 1000000``; the fit list is each
   distinct ``x`` once (a hot vector collapses in the map-side part of the aggregate).
2. Tasks sum ``x`` and, centred at the rounded mean, the products of its entries as whole
   numbers.  The sums are exact, so they do not depend on how rows are split or on retries;
   the covariance comes from them with one rounding per entry.
3. The driver, which holds one covariance (dimension squared), finds the leading eigenpairs by
   spectrum slicing (:mod:`eventmarts.llm.spectrum`).
4. Tasks project every row; the covariance of the projected fit list is measured against
   the identity.

The number of components is ``COMPONENTS`` at most, the dimension at most, and at most
the rank: a direction without variance (``e`` below ``dim * 2**-52 * trace``) cannot be scaled to one.

Defined results: a vector that is null, empty, or holds a null, a non-finite or (beyond
``2**50 / 64``) an overly large component is dropped, as is one of another length than
most have.  Repeated rows and rows with equal or null ids are rows each.  An empty table,
or one whose vectors are all equal, gives no rows.  Only ``vec_id`` and ``embedding`` are
read.  ``deviation`` is exact as a decimal; :func:`as_long` gives null beyond a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmarts.llm.common import stored
from eventmarts.llm.spectrum import leading
from eventmarts.llm.whole_vectors import matrix, of_common_length, quantised

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Rows multiplied at once; with entries up to 2**20 their float products sum exactly.
CHUNK, SMALL = 1 << 13, 1 << 20
_DECIMAL = pa.decimal128(38, 0)


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(number of vectors, exact sum per dimension)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(dim, np.int64), np.zeros(dim, np.int64), 0
        for batch in batches:
            x = matrix(batch.column(0), dim)
            high += (x >> 31).sum(axis=0)
            low += (x & 0x7FFFFFFF).sum(axis=0)
            n += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim, dtype=np.int32)), pa.array(high), pa.array(low),
             pa.array(np.full(dim, n))], names=["i", "high", "low", "n"])

    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = (fit.select("x").mapInArrow(run, "i int, high long, low long, n long")
            .groupBy("i").agg(whole("high"), whole("low"), whole("n")).orderBy("i").collect())
    return int(rows[0]["n"]), [int(r["high"]) * 2 ** 31 + int(r["low"]) for r in rows]


def _products(y: np.ndarray) -> np.ndarray:
    """Exact ``y' y`` of whole numbers, as Python integers."""
    total = np.zeros((y.shape[1],) * 2, object)
    for begin in range(0, len(y), CHUNK):
        part = y[begin:begin + CHUNK]
        if np.abs(part).max() <= SMALL:
            part = part.astype(float)
            total = total + (part.T @ part).astype(np.int64)
        else:
            part = part.astype(object)
            total = total + part.T @ part
    return total


def covariance(fit: DataFrame, dim: int, n: int, sums: list[int]) -> np.ndarray:
    """Covariance (divisor n) of the fit list, each entry the rounding of its exact value."""
    centre = [round_half(s, n) for s in sums]
    at = np.array(centre, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), object)
        for batch in batches:
            total = total + _products(matrix(batch.column(0), dim) - at)
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
             pa.array([Decimal(int(v)) for v in total[i, j]], _DECIMAL)], names=["i", "j", "s"])

    # dim * (dim + 1) / 2 rows come to the driver, whatever the size of the table
    rows = (fit.select("x").mapInArrow(run, "i int, j int, s decimal(38,0)")
            .groupBy("i", "j").agg(F.sum("s").alias("s")).collect())
    rest = [s - n * c for s, c in zip(sums, centre)]
    v = np.zeros((dim, dim))
    for r in rows:
        i, j = r["i"], r["j"]
        v[i, j] = v[j, i] = (int(r["s"]) * n - rest[i] * rest[j]) / (n * n)
    return v


def round_half(a: int, b: int) -> int:
    """``a / b`` to the nearest whole number."""
    return (2 * a + b) // (2 * b)


class Model:
    """What a fit gives: exact mean, leading components, their variances, the trace."""

    def __init__(self, n: int, sums: list[int], v: np.ndarray, components: int):
        self.n, self.dim, self.trace = n, len(sums), float(np.trace(v))
        values, vectors = leading(v, components)
        some = values > self.dim * np.finfo(float).eps * self.trace
        self.values, self.vectors = values[some], vectors[:, some]
        self.centre = np.array([round_half(s, n) for s in sums], np.int64)
        self.rest = [s - n * int(c) for s, c in zip(sums, self.centre)]

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: longs where they fit, else Python integers."""
        y = x - self.centre
        if len(y) and int(np.abs(y).max()) < 2 ** 61 // self.n:
            return y * self.n - np.array(self.rest, np.int64)
        return y.astype(object) * self.n - np.array(self.rest, object)

    def whiten(self, offsets: np.ndarray) -> np.ndarray:
        return (offsets / self.n).astype(float) @ (self.vectors / np.sqrt(self.values))

    @staticmethod
    def deviation(offsets: np.ndarray) -> list[int]:
        """Exact sum of squares of each row."""
        if offsets.dtype == object or int(np.abs(offsets).max(initial=0)) ** 2 * offsets.shape[1] >= 2 ** 63:
            offsets = offsets.astype(object)
        return [int(d) for d in (offsets * offsets).sum(axis=1)]


def identity_error(fit: DataFrame, model: Model) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = model.whiten(model.offsets(matrix(batch.column(0), model.dim)))
            w = np.concatenate([w, np.ones((len(w), 1))], axis=1)
            total += w.T @ w
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
            names=["i", "j", "s"])

    m = np.zeros((k + 1, k + 1))
    for r in (fit.select("x").mapInArrow(run, "i int, j int, s double")
              .groupBy("i", "j").agg(F.sum("s").alias("s")).collect()):
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["s"] / model.n
    centred = m[:k, :k] - np.outer(m[:k, k], m[:k, k])  # the mean is zero but for rounding
    return float(np.abs(centred - np.eye(k)).max())


def as_long(column: str):
    """A decimal as a long, null where it is none."""
    return F.expr(f"try_cast({column} as bigint)")


OUT = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
       "explained double, identity_error double")


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component (module docstring)."""
    rows, dim = of_common_length(stored(
        quantised(vectors.select("vec_id", "embedding"), SCALE, SHIFT), "whiten-rows"))
    nothing = vectors.sparkSession.createDataFrame([], OUT)
    if not dim:
        return nothing
    fit = stored(rows.select("x").distinct(), "whiten-fit")
    n, sums = _sums(fit, dim)
    model = Model(n, sums, covariance(fit, dim, n, sums), components)
    if not len(model.values):
        return nothing
    error, k = identity_error(fit, model), len(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                offsets = model.offsets(matrix(part.column(1), dim))
                each = pa.array(np.repeat(np.arange(len(offsets)), k))
                deviation = pa.array([Decimal(d) for d in model.deviation(offsets)], _DECIMAL)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(offsets))),
                    pa.array(np.full(len(each), n)), deviation.take(each),
                    pa.array(model.whiten(offsets).ravel()),
                    pa.array(np.tile(explained, len(offsets))),
                    pa.array(np.full(len(each), error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, OUT)
