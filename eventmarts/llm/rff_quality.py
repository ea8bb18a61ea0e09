"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

1. Every whole text becomes a fixed vector of document statistics (``STATS``).
2. Statistics are standardised by their mean and deviation over the labelled rows.
3. Random Fourier features approximate a Gaussian kernel of the standardised
   statistics.
4. Tasks sum their rows' normal equations; the partial matrices are added row by
   row, spread over tasks, so no task or driver holds more than one matrix.  The
   driver solves one system of ``features + 1`` unknowns.
5. Raw scores of the labelled rows are counted in ``BINS`` fixed bins; pool-adjacent-
   violators over the bins gives a monotone calibration to [0, 1].

The fit uses all labelled rows outside the held-out fold (crc32 of the id as text
modulo 5 is 0).  Labels, lang, source and ids are never inputs of a score.

Defined results: a null text is empty and gets the score of an empty text; rows are
scored each, repeated or not; several labels of an id are averaged, null labels are
ignored; without any usable label every score is 0.5; an empty table gives an empty
table.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmarts.llm.common import stored
from eventmarts.llm.words import Texts, chunks

STATS = ("log_chars", "log_words", "word_length", "upper", "symbols", "exclaim", "digits",
         "stops", "repeat_next", "repeat_second", "repeat_window", "top_word", "distinct",
         "lines", "wide_chars", "shouted", "long_words", "spaces")
FEATURES = 256
BANDWIDTH = 4.0  # of the Gaussian kernel, in standard deviations
RIDGE = 1e-3
BINS = 1024
FOLDS = 5
THRESHOLD = 0.3
_SUM_TASKS = 16


def _marks(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.float64)
    table[list(chars)] = 1
    return table


_UPPER = _marks(bytes(range(65, 91)))
_ALPHA = _marks(bytes([*range(65, 91), *range(97, 123)]))
_TABLES = {
    "symbols": _marks(b"#*$%&|<>~^{}[]\\=_@"), "exclaim": _marks(b"!?"), "digits": _marks(b"0123456789"),
    "stops": _marks(b".,;:"), "lines": _marks(b"\n"), "spaces": _marks(b" \t\r\n\x0b\x0c"),
}


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the bounds ``first``."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def statistics(texts: Texts) -> np.ndarray:
    """(texts, len(STATS)) document statistics."""
    n, data, bounds = len(texts), texts.data, texts.offsets
    words = np.maximum(texts.count, 1).astype(float)
    size = np.maximum(np.diff(bounds), 1).astype(float)
    out = {}
    lead = _sums((data & 0xC0) != 0x80, bounds)
    out["log_chars"] = np.log1p(lead)
    out["log_words"] = np.log1p(texts.count)
    length = texts.end - texts.start
    out["word_length"] = _sums(length, texts.first) / words
    letters = np.maximum(_sums(_ALPHA[data], bounds), 1)
    out["upper"] = _sums(_UPPER[data], bounds) / letters
    for name, table in _TABLES.items():
        out[name] = _sums(table[data], bounds) / (words if name in ("exclaim", "lines", "stops") else size)
    out["wide_chars"] = _sums(data >= 0x80, bounds) / size
    h, owner = texts.hash, texts.text_of_word()
    for name, step in (("repeat_next", 1), ("repeat_second", 2)):
        same = np.zeros(len(h))
        if len(h) > step:
            same[step:] = (h[step:] == h[:-step]) & (owner[step:] == owner[:-step])
        out[name] = _sums(same, texts.first) / words
    for name, key, first in (("word", h, texts.first), ("window", *texts.shingles())):
        mine = np.repeat(np.arange(n), np.diff(first))
        order = np.lexsort((key, mine))
        key, mine = key[order], mine[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (mine[1:] != mine[:-1])
        kinds = _sums(new, first)
        if name == "window":
            total = np.diff(first)
            out["repeat_window"] = np.where(total > 0, 1 - kinds / np.maximum(total, 1), 0.0)
        else:
            out["distinct"] = kinds / np.sqrt(words)
            runs = np.diff(np.concatenate([np.flatnonzero(new), [len(key)]]))
            top = np.zeros(n)
            np.maximum.at(top, mine[new], runs)
            out["top_word"] = top / words
    caps = np.concatenate([[0.0], np.cumsum(_UPPER[data])])
    ascii_letters = np.concatenate([[0.0], np.cumsum(_ALPHA[data])])
    up = caps[texts.end] - caps[texts.start]
    alpha = ascii_letters[texts.end] - ascii_letters[texts.start]
    out["shouted"] = _sums((up >= 2) & (up == alpha), texts.first) / words
    out["long_words"] = _sums(length > 25, texts.first) / words
    return np.column_stack([out[s] for s in STATS])


def measure(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col, stats`` for every row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for _, t in chunks(batch.column(1))]
            if not rows:
                continue
            flat = pa.array(np.concatenate(rows).ravel())
            stats = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(STATS)), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), stats], names=[id_col, "stats"])

    return docs.select(id_col, "text").mapInArrow(run, f"`{id_col}` {id_type}, stats array<double>")


def held_out(id_col: Column, folds: int = FOLDS) -> Column:
    """True where crc32 of the id as text modulo ``folds`` is 0; a null id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(True))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    edges: np.ndarray | None = None  # calibration knots: raw score and value
    values: np.ndarray | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2.0 / len(self.phases))
        return np.column_stack([z, np.ones(len(x))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.values is None:
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.raw(stats), self.edges, self.values), 0.0, 1.0)


def _stack(batch: pa.RecordBatch, name: str = "stats") -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _sum_rows(rows: DataFrame) -> DataFrame:
    """Element-wise sums of ``(i, v array)`` by ``i``; each task streams its rows of the matrix."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), _stack(b, "v")):
                total[i] = total[i] + v if i in total else v
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()),
                 pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))],
                names=["i", "v"])

    return rows.repartition(_SUM_TASKS, F.col("i")).mapInArrow(add, "i int, v array<double>")


def fit(labelled: DataFrame, features: int = FEATURES, bandwidth: float = BANDWIDTH,
        ridge: float = RIDGE, bins: int = BINS, seed: int = 7) -> Model:
    """Fit on ``labelled(stats, label)``."""
    n_stats = len(STATS)
    moments = labelled.agg(
        F.count(F.lit(1)).alias("n"), F.avg("label").alias("y"),
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(n_stats)],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(n_stats)]).first()
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((n_stats, features)) / bandwidth
    phases = rng.uniform(0, 2 * np.pi, features)
    if not moments["n"]:
        return Model(np.zeros(n_stats), np.ones(n_stats), directions, phases)
    mean = np.array([moments[f"m{i}"] for i in range(n_stats)])
    scale = np.maximum([moments[f"s{i}"] for i in range(n_stats)], 1e-6)
    model = Model(mean, scale, directions, phases)
    size = features + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for b in batches:
            z = model.features(_stack(b))
            y = b.column(1).to_numpy(zero_copy_only=False)
            total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size), pa.int32()),
             pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "v"])

    rows = _sum_rows(labelled.select("stats", "label").mapInArrow(
        equations, "i int, v array<double>")).collect()  # size x (size + 1) numbers
    system = np.array([r["v"] for r in sorted(rows, key=lambda r: r["i"])])
    gram = system[:, :size] + ridge * moments["n"] / size * np.eye(size)
    model.weights = np.linalg.solve(gram, system[:, size])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, y = np.zeros(bins), np.zeros(bins)
        for b in batches:
            at = np.clip(((model.raw(_stack(b)) + 0.5) * (bins / 2)).astype(int), 0, bins - 1)
            n += np.bincount(at, minlength=bins)
            y += np.bincount(at, weights=b.column(1).to_numpy(zero_copy_only=False), minlength=bins)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(n[some]), pa.array(y[some])], names=["bin", "n", "y"])

    counts = (labelled.select("stats", "label").mapInArrow(binned, "bin int, n double, y double")
              .groupBy("bin").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
              .orderBy("bin").collect())  # at most `bins` rows
    at = np.array([r["bin"] for r in counts], float)
    n, y = np.array([r["n"] for r in counts]), np.array([r["y"] for r in counts])
    model.edges = (at + 0.5) * (2 / bins) - 0.5
    model.values = isotonic(n, (y + moments["y"] * 0.5) / (n + 0.5))
    return model


def isotonic(weight: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Non-decreasing least-squares fit (pool adjacent violators)."""
    pools: list[list[float]] = []
    for w, v in zip(weight, value):
        pools.append([w, v, 1])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            w2, v2, c2 = pools.pop()
            w1, v1, c1 = pools.pop()
            pools.append([w1 + w2, (w1 * v1 + w2 * v2) / (w1 + w2), c1 + c2])
    return np.concatenate([np.full(int(c), v) for _, v, c in pools]) if pools else np.zeros(0)


def predict(measured: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    id_type = measured.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(model.score(_stack(b)))], names=[id_col, "score"])

    return measured.select(id_col, "stats").mapInArrow(run, f"`{id_col}` {id_type}, score double")


def score_documents(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
                    id_col: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row of ``docs``."""
    measured = stored(measure(docs, id_col), "quality-stats")
    known = (labels.where(F.col(label_col).isNotNull()).groupBy(id_col)
             .agg(F.avg(F.col(label_col).cast("double")).alias("label")))
    labelled = stored(measured.where(~held_out(F.col(id_col))).join(known, id_col)
                      .select("stats", "label"), "quality-labelled")
    model = fit(labelled)
    return (predict(measured, model, id_col)
            .select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay.

    The score of a row is computed from the row itself, so nothing is joined back.
    """
    measured = stored(measure(docs), "quality-stats")
    known = (labels.where(F.col("quality").isNotNull()).groupBy("doc_id")
             .agg(F.avg(F.col("quality").cast("double")).alias("label")))
    model = fit(stored(measured.where(~held_out(F.col("doc_id"))).join(known, "doc_id")
                       .select("stats", "label"), "quality-labelled"))
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [model.score(statistics(t))
                      for _, t in chunks(b.column(b.schema.get_field_index("text")))]
            if scores:
                yield b.filter(pa.array(np.concatenate(scores) >= threshold)).select(columns)

    return docs.mapInArrow(run, docs.schema)
