"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Sources share ``SHARE`` of all words by weight; no target exceeds ``MAX_EPOCHS``
   times its source's size, and what is cut off is shared again (water filling, in
   exact integers).
2. A source's documents are laid on a word axis in the order of a seeded hash, i.e.
   as a random permutation.  The axis is numbered by a prefix sum in two levels (hash
   prefix, then document), so no source is ever one task.  The mix takes the
   first ``target`` words of the axis, going round a second time if need be.
3. The axis is cut into blocks of ``BLOCK_WORDS``.  The exact block quotas of all
   sources are split among output shards by a binary tree: a node's left half receives
   a multivariate-hypergeometric draw of the node's quotas, its right half the rest.
   So every shard holds a random mixture with exact totals, and shards are disjoint.
4. A shard's blocks of a source are consecutive on its axis, so documents are cut
   only at shard borders and at the end of a quota.  Rows are shuffled within a shard
   by a seeded hash.

Nothing but its run's start is joined to place a document: its interval on the axis and the plan of its
source (broadcast; one row per source and shard) give its segments.  The plan is made
on the driver from one row per source, in numpy arrays.  ``max_plan`` bounds sources x
shards; more words make larger shards, more sources than that raise an error before any of
them comes to the driver.

Defined results: a null text has size 0 and nothing is taken of it; a null source is
a source, last in order; repeated rows are documents each; an empty table gives an
empty table.  Only ``doc_id``, ``text`` and ``source`` are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from eventmarts.llm.common import stored

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # 150 %
MAX_EPOCHS = 2
BLOCK_WORDS = 1024
SHARD_WORDS = 1 << 16
MAX_PLAN = 1 << 18
SEED = 17

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
SEGMENTS = "array<struct<shard:int,epoch:int,first_word:long,n_words:long>>"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


@dataclass
class SourcePlan:
    size: int
    target: float
    quota: int  # words to take
    ends: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # of each shard's part, in words
    shards: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))

    def segments(self, at: int, size: int) -> list[tuple[int, int, int, int]]:
        """(shard, epoch, first word, words) of a document at [at, at + size) of the axis."""
        out = []
        for epoch in range(MAX_EPOCHS):
            begin = epoch * self.size + at
            end = min(begin + size, self.quota)
            k = int(np.searchsorted(self.ends, begin, side="right"))
            x = begin
            while x < end:
                stop = min(end, int(self.ends[k]))
                out.append((int(self.shards[k]), epoch, x - begin, stop - x))
                x, k = stop, k + 1
        return out


def targets(sizes: list[int], weights: list[int], share: tuple[int, int] = SHARE,
            epochs: int = MAX_EPOCHS) -> list[float]:
    """Words wanted of each source; each a single rounding of an exact fraction."""
    up, down = share
    goal, rest = up * sum(sizes), sum(weights)  # goal in units of 1 / down words
    out = [float(epochs * n) for n in sizes]
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i] / weights[i], i))
    for k, i in enumerate(order):
        # the rest's level is below this cap, so it and all later ones are below theirs
        if goal * weights[i] <= down * rest * epochs * sizes[i]:
            for j in order[k:]:
                out[j] = weights[j] * goal / (down * rest)
            break
        goal -= down * epochs * sizes[i]
        rest -= weights[i]
    return out


def _stirling_rest(n: float) -> float:
    """``log n!`` less Stirling's formula, to double precision."""
    if n < 16:
        return math.lgamma(n + 1) - ((n + 0.5) * math.log(n) - n + 0.5 * math.log(2 * math.pi)) if n else 0.0
    q = 1 / (n * n)
    return (1 / 12 - (1 / 360 - (1 / 1260 - q / 1680) * q) * q) / n


def _deviance(x: float, mean: float) -> float:
    """``x log(x / mean) + mean - x`` without cancellation."""
    if abs(x - mean) < 0.1 * (x + mean):
        v = (x - mean) / (x + mean)
        total, term, k = (x - mean) * v, 2 * x * v, 1
        while True:
            term *= v * v
            k += 2
            more = total + term / k
            if more == total:
                return total
            total = more
    return x * math.log(x / mean) + mean - x


def _log_binomial(x: int, n: int, p: float, q: float) -> float:
    """Log probability of ``x`` of ``n`` (C. Loader, 2000): exact to rounding at any size."""
    if x == 0 or x == n:
        return -_deviance(n, n * (q if x == 0 else p)) - n * (p if x == 0 else q) if n else 0.0
    return (_stirling_rest(n) - _stirling_rest(x) - _stirling_rest(n - x) - _deviance(x, n * p)
            - _deviance(n - x, n * q) + 0.5 * math.log(n / (2 * math.pi * x * (n - x))))


def log_hypergeometric(x: int, good: int, bad: int, draws: int) -> float:
    """Log probability of ``x`` good ones among ``draws`` without replacement, as a ratio of
    three binomial terms, none of which loses digits where the counts are large."""
    if not max(0, draws - bad) <= x <= min(good, draws):
        return -math.inf
    total = good + bad
    p, q = draws / total, (total - draws) / total
    return (_log_binomial(x, good, p, q) + _log_binomial(draws - x, bad, p, q)
            - _log_binomial(draws, total, p, q))


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """An exact draw for urns of any size, by the ratio of uniforms (E. Stadlober, 1989)."""
    total = good + bad
    if not 0 < draws < total or not good or not bad:
        return good if draws == total else draws if not bad else 0
    few, n = min(good, bad), min(draws, total - draws)  # by symmetry
    mean = n * (few / total)
    spread = math.sqrt(mean * ((total - few) / total) * ((total - n) / max(total - 1, 1)) + 0.5)
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    peak = (n + 1) * (few + 1) // (total + 2)
    top = log_hypergeometric(peak, few, total - few, n)
    while True:
        u, v = rng.random(2)
        if not u:
            continue
        x = math.floor(mean + 0.5 + width * (v - 0.5) / u)
        if 0 <= x <= min(few, n) and 2 * math.log(u) <= log_hypergeometric(x, few, total - few, n) - top:
            break
    if few != good:  # x counts the bad ones
        x = n - x
    return x if n == draws else good - x


def split_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources) blocks: row sums as equal as possible, column sums ``quotas``."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    rest, take = int(quotas.sum()), int(quotas.sum()) * left // shards
    half = np.zeros_like(quotas)
    for i, quota in enumerate(quotas.tolist()):  # multivariate: source by source
        rest -= quota
        half[i] = hypergeometric(rng, quota, rest, take)
        take -= int(half[i])
    return np.vstack([split_tree(half, left, rng), split_tree(quotas - half, shards - left, rng)])


def make_plan(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS,
              block: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, max_plan: int = MAX_PLAN,
              seed: int = SEED) -> dict[str | None, SourcePlan]:
    """The plan of every source from its size in words."""
    sizes = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    if len(sizes) > max_plan:
        raise ValueError(f"{len(sizes)} sources; the plan holds at most {max_plan} parts")
    wanted = targets([n for _, n in sizes], [weights[i % len(weights)] for i in range(len(sizes))])
    plan = {s: SourcePlan(n, t, math.floor(t + 0.5)) for (s, n), t in zip(sizes, wanted)}
    blocks = np.array([-(-p.quota // block) for p in plan.values()], np.int64)
    words = sum(p.quota for p in plan.values())
    shards = max(1, min(-(-words // shard_words), max_plan // max(len(plan), 1)))
    if blocks.sum():
        parts = split_tree(blocks, shards, np.random.default_rng(seed))
        for p, counts in zip(plan.values(), parts.T):
            some = np.flatnonzero(counts)
            p.shards = some.astype(np.int32)
            p.ends = np.cumsum(counts[some]) * block
    return plan


def _measured(docs: DataFrame, columns: tuple[str | Column, ...], seed: int) -> DataFrame:
    """``columns, source, size, _order`` of every row."""
    order = F.md5(F.concat(F.lit(f"mix:{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
                  .cast("binary"))
    return docs.select(*columns, "source", word_count(F.col("text")).alias("size"), order.alias("_order"))


def _runs(narrow: DataFrame, digits: int | None = None
          ) -> tuple[list[tuple[str | None, int]], Column, DataFrame]:
    """Every source's size; the run of a row; ``_key, _base``: where each run starts on its axis.

    A run is the documents of a source with the same first ``digits`` hex digits of the
    hash: about the square root of all documents by default, so that neither a run nor
    the list of a source's runs is large.
    """
    per_source = stored(narrow.groupBy("source").agg(F.sum("size").alias("n")), "mix-sources")
    if (n := per_source.count()) > MAX_PLAN:
        raise ValueError(f"{n} sources; the plan holds at most {MAX_PLAN} parts")
    sizes = [(r["source"], r["n"]) for r in per_source.collect()]  # a row per source
    if digits is None:
        digits = math.ceil(math.log(max(narrow.count(), 1), 16) / 2)
    run = F.substring("_order", 1, digits) if digits else F.lit("")
    before = Window.partitionBy("source").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (narrow.groupBy("source", run.alias("_run")).agg(F.sum("size").alias("_n"))
            .select(F.struct("source", "_run").alias("_key"),
                    F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    return sizes, F.struct("source", run.alias("_run")), runs  # a struct is never null


def _starts(rows: DataFrame, key: Column, runs: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``rows`` with their ``start`` on the axis; equal ones in ``order`` in any order."""
    within = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_key", key)
            .withColumn("_local", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .join(runs, "_key").withColumn("start", F.col("_base") + F.col("_local")))


def lay_out(docs: DataFrame, id_cols: tuple[str, ...] = ("doc_id",), seed: int = SEED,
            digits: int | None = None) -> tuple[DataFrame, list[tuple[str | None, int]]]:
    """Documents with their start on their source's axis, and every source's size."""
    narrow = stored(_measured(docs, id_cols, seed), "mix-sizes")
    sizes, key, runs = _runs(narrow, digits)
    placed = _starts(narrow, key, runs, ("_order", "doc_id", "size"))
    return placed.select(*id_cols, "source", "size", "start"), sizes


def mix(docs: DataFrame, id_cols: tuple[str, ...] = ("doc_id",), weights: tuple[int, ...] = WEIGHTS,
        block: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """``id_cols, source, size, source_size, target, segments`` for every row of ``docs``.

    ``segments`` lists the parts that the mix takes: shard, epoch, first word, words.
    """
    placed, sizes = lay_out(docs, id_cols, seed)
    plan = docs.sparkSession.sparkContext.broadcast(
        make_plan(sizes, weights, block, shard_words, seed=seed))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema if f.name != "start"]
    names = [f.name for f in placed.schema]
    at = {c: names.index(c) for c in ("source", "size", "start")}
    part = pa.list_(pa.struct([("shard", pa.int32()), ("epoch", pa.int32()), ("first_word", pa.int64()),
                               ("n_words", pa.int64())]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [plan.value[s] for s in batch.column(at["source"]).to_pylist()]
            segments = [[dict(zip(("shard", "epoch", "first_word", "n_words"), s)) for s in p.segments(a, n)]
                        for p, a, n in zip(own, batch.column(at["start"]).to_pylist(),
                                           batch.column(at["size"]).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i, c in enumerate(names) if c != "start"],
                 pa.array([p.size for p in own], pa.int64()), pa.array([p.target for p in own], pa.float64()),
                 pa.array(segments, part)],
                names=[*[c for c in names if c != "start"], "source_size", "target", "segments"])

    return placed.mapInArrow(
        place, ", ".join([*kept, "source_size long", "target double", f"segments {SEGMENTS}"]))


def words_taken(segments: Column) -> Column:
    return F.aggregate(segments, F.lit(0).cast("long"), lambda acc, s: acc + s["n_words"])


def cut_words(text: str, parts: list[tuple[int, int]]) -> list[str]:
    """Words ``first`` to ``first + n`` of ``text`` for each ``(first, n)``, with the white
    space between them.  The text is read once, whatever the number of parts."""
    matches, at = _WORD.finditer(text), 0
    spans: dict[int, tuple[int, int]] = {}
    for k in sorted({w for first, n in parts for w in (first, first + n - 1)}):
        spans[k] = next(islice(matches, k - at, None)).span()
        at = k + 1
    return [text[spans[first][0]:spans[first + n - 1][1]] for first, n in parts]


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix itself: rows with the columns of ``docs``, shuffled within output shards.

    A document that is taken whole is returned as it is, once per epoch.  Of one that is
    cut at the end of a quota or a shard, the text holds the words taken, and ``n_chars``
    their length.

    ``docs`` is read twice, for the sizes and for the rows, so it is a stored table or an
    expression that gives the same rows again.  Texts move to their place on the axis, where
    they are cut, and the parts taken to their shard; no copy of ``docs`` is written.
    """
    columns = docs.columns
    # the caller's columns travel in one struct, so no name of theirs meets one of ours
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"))
            .select("doc", "doc.doc_id", "doc.text", "doc.source"))
    sizes, key, runs = _runs(stored(_measured(rows, ("doc_id",), seed), "mix-sizes"))
    plan = docs.sparkSession.sparkContext.broadcast(make_plan(sizes, weights, seed=seed))
    # rows that tie in ``mix`` too are told apart by their content: a task that runs again
    # places them alike
    whole = _measured(rows, ("doc_id", "doc", F.xxhash64("doc").alias("_same")), seed)
    placed = (_starts(whole, key, runs, ("_order", "doc_id", "size", "_same"))
              .select("source", "size", "start", "doc"))
    fields = {c: i for i, c in enumerate(columns)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, size, start, doc = batch.columns
            arrays = doc.flatten()
            taken, shard, epoch, first = [], [], [], []
            parts: dict[int, list[tuple[int, int, int]]] = {}  # of a document: part, first word, words
            for i, (s, n, at) in enumerate(zip(source.to_pylist(), size.to_pylist(), start.to_pylist())):
                for k, e, f, words in plan.value[s].segments(at, n):
                    if words < n:
                        parts.setdefault(i, []).append((len(taken), f, words))
                    taken.append(i)
                    shard.append(k)
                    epoch.append(e)
                    first.append(f)
            text: list[str | None] = [None] * len(taken)
            length: list[int | None] = [None] * len(taken)
            for i, own in parts.items():
                words_of = cut_words(arrays[fields["text"]][i].as_py(), [(f, n) for _, f, n in own])
                for (j, _, _), t in zip(own, words_of):
                    text[j], length[j] = t, len(t)
            part = pa.array([n is not None for n in length], pa.bool_())
            index = pa.array(taken, pa.int64())
            out = [a.take(index) for i, a in enumerate(arrays) if i != fields["text"]]
            # a cut text is not copied whole for each of its parts
            uncut = arrays[fields["text"]].take(pc.if_else(part, pa.scalar(None, pa.int64()), index))
            out.insert(fields["text"], pc.if_else(part, pa.array(text, uncut.type), uncut))
            if "n_chars" in fields:
                old = out[fields["n_chars"]]
                out[fields["n_chars"]] = pc.if_else(part, pa.array(length, pa.int64()).cast(old.type), old)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), source.take(index), start.take(index), pa.array(epoch, pa.int32()),
                 pa.array(first, pa.int64()), pa.StructArray.from_arrays(out, fields=list(doc.type))],
                names=["shard", "source", "start", "epoch", "first", "doc"])

    schema = StructType([StructField("shard", IntegerType()), StructField("source", placed.schema["source"].dataType),
                         StructField("start", LongType()), StructField("epoch", IntegerType()),
                         StructField("first", LongType()), StructField("doc", docs.schema, False)])
    # within a shard, a seeded hash is the local shuffle
    place = F.xxhash64(F.lit(seed), "source", "start", "epoch", "first").alias("place")
    return (placed.mapInArrow(cut, schema).select("shard", place, "doc")
            .repartition("shard").sortWithinPartitions("shard", "place").select("doc.*"))
