"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

1. Vectors become whole numbers, are put on a Hilbert curve through all dimensions, and are range
   partitioned by (label, curve, id).  Each run of ``BLOCK_ROWS`` rows in that order is one
   row of a Parquet table: a block with its ids, labels, entries and zone map (least and
   greatest value of every dimension, and of the label).  ``SHELF_BLOCKS`` blocks form a shelf.
2. A search has, per anchor, windows of scores and asks for the best ``k`` rows in each.  By
   interval arithmetic the products of an anchor with all vectors of a zone lie between two
   bounds; a shelf, and in it a block, is read only if they meet a window.  The plan joins anchors
   with pages of shelf zones, so no task holds all zones, and sends each anchor to the
   shelves it must read.
3. A first wave reads the most promising shelf of each page; the ``k``-th score found
   there raises the windows' lower ends for the second wave, which reads the rest.
4. Positives are a search of one open window among the same label; negatives one with a window
   per positive among other labels.

The number of blocks follows from the rows, not from the partitions.  A shelf's blocks are all
that a task holds; anchors stream past.  With fewer shelves than tasks, a shelf is copied to several
tasks which share its anchors.

Defined results: a vector that is null, empty, or holds a null, a non-finite component or one so
large that a score could leave the longs takes no part, nor does one of another length
than most have, nor a row without label.  Rows with equal ids are rows each; ties between them go by their
place on the curve.  A row without id is a candidate (last among ties), not an anchor.  An
empty table gives none.  Only ``vec_id``, ``embedding`` and ``label`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmarts.llm.common import spread, stored
from eventmarts.llm.whole_vectors import matrix, of_common_length, quantised

SCALE = 256
BLOCK_ROWS, SHELF_BLOCKS, PAGE_SHELVES = 512, 16, 256
CURVE_BITS = 4  # cells of the curve per dimension, as a power of two
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
NONE, ANY = -(1 << 62), 1 << 62  # below and above every score

BLOCK = ("block long, ids array<long>, labels array<long>, x array<long>, low array<long>, "
         "high array<long>, label_low long, label_high long")
ANCHOR = ("apos long, anchor_id long, label long, x array<long>, lows array<long>, "
          "highs array<long>")


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index (big-endian bytes) of unsigned grid cells, one row each: bits of all
    dimensions, by John Skilling's transform (AIP Conf. Proc. 707, 2004)."""
    x = cells.astype(np.uint32).T.copy()
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        below = np.uint32(q - 1)
        for i in range(len(x)):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & below).astype(np.uint32)
            x[0] ^= np.where(up, below, swap).astype(np.uint32)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    q = top
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= turn
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of whole numbers whose products fit a long."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2.0 ** 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each row of ``a`` with vectors of each zone."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _extent(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each dimension over the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dim, ANY), np.full(dim, -ANY)
        for batch in batches:
            x = matrix(batch.column(0), dim)
            low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(low),
                                          pa.array(high)], names=["i", "low", "high"])

    got = (rows.select("x").mapInArrow(run, "i int, low long, high long").groupBy("i")
           .agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect())
    return np.array([r["low"] for r in got]), np.array([r["high"] for r in got])


def placed(rows: DataFrame, dim: int) -> DataFrame:
    """``rows(vec_id, label, x)`` with ``pos``, their place by (label, Hilbert curve, id)."""
    low, high = _extent(rows, dim)
    width = np.maximum(high - low, 0).astype(float) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = ((matrix(batch.column(2), dim) - low) / width * (1 << CURVE_BITS)).astype(np.int64)
            curve = hilbert(np.clip(cells, 0, (1 << CURVE_BITS) - 1), CURVE_BITS)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([c.tobytes() for c in curve], pa.binary())],
                names=["vec_id", "label", "x", "curve"])

    curved = rows.select("vec_id", "label", "x").mapInArrow(
        run, "vec_id long, label long, x array<long>, curve binary")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "curve", "vec_id"]
    numbered = stored(curved.repartitionByRange(n, *order).sortWithinPartitions(*order)
                      .withColumn("_m", F.monotonically_increasing_id()).drop("curve"), "mine-ordered")
    part = F.shiftright("_m", 33)
    # one row per partition
    counts = numbered.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("n")).orderBy("_p").collect()
    offsets, total = [], 0
    for r in counts:
        offsets.append((r["_p"], total - (r["_p"] << 33)))
        total += r["n"]
    table = rows.sparkSession.createDataFrame(offsets, "_p long, _o long")
    return (numbered.withColumn("_p", part).join(F.broadcast(table), "_p")
            .select("vec_id", "label", "x", (F.col("_m") + F.col("_o")).alias("pos")))


def blocks(rows: DataFrame, dim: int, block_rows: int) -> DataFrame:
    """The block table (``BLOCK``) of placed rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = None

        def out() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            x, labels = matrix(t["x"].combine_chunks(), dim), t["label"].to_numpy()
            one = lambda v: pa.array([v], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([
                pa.array([at], pa.int64()), pa.ListArray.from_arrays([0, len(x)], t["vec_id"].combine_chunks()),
                one(labels), one(x.ravel()), one(x.min(axis=0)), one(x.max(axis=0)),
                pa.array([labels.min()]), pa.array([labels.max()])],
                names=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if held and ids[begin] != at:
                    yield out()
                    held = []
                at = int(ids[begin])
                held.append(batch.slice(begin, end - begin))
        if held:
            yield out()

    cut = rows.select(F.floor(F.col("pos") / block_rows).cast("long").alias("block"), "pos", "vec_id", "label", "x")
    return spread(cut, "block").sortWithinPartitions("block", "pos").mapInArrow(run, BLOCK)


def _meet(held: DataFrame, asking: DataFrame, key: str, order: str, keys: int, run: Callable,
          schema: str) -> DataFrame:
    """Stream the ``asking`` rows of a key past its ``held`` rows.

    ``run(held: Table, asking: RecordBatch)`` yields record batches.  With fewer keys
    than tasks the held rows of a key are copied to several tasks, which share its asking rows."""
    n = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = max(1, n // max(keys, 1))
    a = held.withColumn("_kind", F.lit(0)).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    b = asking.withColumn("_kind", F.lit(1)).withColumn(
        "_copy", F.pmod(F.xxhash64("apos"), F.lit(copies)).cast("int"))
    both = a.unionByName(b, allowMissingColumns=True)
    names = both.columns
    mark = [names.index(c) for c in (key, "_copy", "_kind")]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, table, parts = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(i).to_numpy() for i in mark])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                k, copy, kind = marks[:, begin].tolist()
                if (k, copy) != at:
                    at, table, parts = (k, copy), None, []
                rows = batch.slice(begin, end - begin)
                if kind == 0:
                    parts.append(rows)
                elif parts:
                    if table is None:
                        table = pa.Table.from_batches(parts).combine_chunks()
                    for first in range(0, rows.num_rows, 512):
                        yield from run(table, rows.slice(first, 512))

    return (spread(both, key, "_copy").sortWithinPartitions(key, "_copy", "_kind", order)
            .mapInArrow(stream, schema))


def _lists(column) -> np.ndarray:
    """An Arrow list column of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _asked(rows: pa.RecordBatch) -> dict[str, np.ndarray]:
    at = rows.schema.get_field_index
    return {"apos": rows.column(at("apos")).to_numpy(), "label": rows.column(at("label")).to_numpy(),
            **{c: _lists(rows.column(at(c))) for c in ("x", "lows", "highs")}}


def _eligible(label: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool) -> np.ndarray:
    """Whether zones of labels low..high can hold a row of the label / of another label."""
    if same:
        return (low[None] <= label[:, None]) & (label[:, None] <= high[None])
    return (low[None] != label[:, None]) | (high[None] != label[:, None])


def _met(least: np.ndarray, most: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Whether bounds (anchors, zones) meet any of the anchor's windows."""
    return ((most[:, :, None] >= lows[:, None]) & (least[:, :, None] <= highs[:, None])
            & (lows <= highs)[:, None]).any(axis=2)


class Index:
    """Block table of a set of vectors, its shelves and their zones."""

    def __init__(self, rows: DataFrame, dim: int):
        self.dim, self.block_rows = dim, BLOCK_ROWS
        self.rows = placed(rows, dim)
        table = stored(blocks(self.rows, dim, BLOCK_ROWS), "mine-blocks")
        self.blocks = table.withColumn("shelf", F.floor(F.col("block") / SHELF_BLOCKS).cast("long"))
        spans = (self.blocks.groupBy("shelf").agg(
            F.collect_list("low").alias("lows_"), F.collect_list("high").alias("highs_"),
            F.min("label_low").alias("label_low"), F.max("label_high").alias("label_high")))

        def fold(column: str, pick) -> F.Column:  # SHELF_BLOCKS arrays, entry by entry
            return F.aggregate(F.slice(column, 2, SHELF_BLOCKS), F.element_at(column, 1),
                               lambda acc, v: F.zip_with(acc, v, lambda a, b: pick(a, b)))

        self.zones = stored(spans.select(
            "shelf", F.floor(F.col("shelf") / PAGE_SHELVES).cast("long").alias("page"),
            fold("lows_", F.least).alias("low"), fold("highs_", F.greatest).alias("high"),
            "label_low", "label_high"), "mine-zones")
        self.shelves = self.zones.count()

    def plan(self, asking: DataFrame, same: bool, first: bool) -> DataFrame:
        """``asking`` once per shelf that must be read: the most promising shelf of each page
        (``first``) or the others."""
        pages = -(-self.shelves // PAGE_SHELVES)

        def run(zones: pa.Table, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ask, shelf = _asked(rows), zones["shelf"].to_numpy()
            least, most = bounds(ask["x"], _lists(zones["low"]), _lists(zones["high"]))
            some = _eligible(ask["label"], zones["label_low"].to_numpy(), zones["label_high"].to_numpy(), same)
            promising = np.where(some, most, NONE).argmax(axis=1)[:, None] == np.arange(len(shelf))[None]
            some &= (promising if first else ~promising) & _met(least, most, ask["lows"], ask["highs"])
            a, z = np.nonzero(some)
            each = rows.take(pa.array(a))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shelf[z]), *[each.column(each.schema.get_field_index(c.split()[0]))
                                       for c in ANCHOR.split(", ")]],
                names=["shelf", *[c.split()[0] for c in ANCHOR.split(", ")]])

        last = F.lit(max(pages, 1) - 1).cast("long")
        each = asking.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        return _meet(self.zones, each, "page", "shelf", pages, run, f"shelf long, {ANCHOR}")

    def visit(self, requests: DataFrame, same: bool, k: int) -> DataFrame:
        """``apos, w, score, found_id, found_pos``: best k of each window within a shelf."""
        dim, block_rows = self.dim, self.block_rows

        def run(shelf: pa.Table, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ask, block = _asked(rows), shelf["block"].to_numpy()
            sizes = np.diff(shelf["labels"].combine_chunks().offsets.to_numpy())
            flat = lambda c: shelf[c].combine_chunks().flatten()
            x = flat("x").to_numpy(zero_copy_only=False).reshape(-1, dim)
            labels, ids = flat("labels").to_numpy(zero_copy_only=False), flat("ids")
            pos = np.concatenate([b * block_rows + np.arange(s) for b, s in zip(block, sizes)])
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            id_ = ids.fill_null(0).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            least, most = bounds(ask["x"], _lists(shelf["low"]), _lists(shelf["high"]))
            some = _eligible(ask["label"], shelf["label_low"].to_numpy(), shelf["label_high"].to_numpy(), same)
            lows, highs, m = ask["lows"].copy(), ask["highs"], rows.num_rows
            scores = np.full((m, len(pos)), NONE)
            for b in np.argsort(-np.where(some, most, NONE).max(axis=0), kind="stable"):
                need = np.flatnonzero(some[:, b] & _met(least[:, [b]], most[:, [b]], lows, highs)[:, 0])
                if not len(need):
                    continue
                part = slice(starts[b], starts[b + 1])
                s = products(ask["x"][need], x[part])
                allowed = (labels[part][None] == ask["label"][need, None]) == same
                s = np.where(allowed & (pos[part][None] != ask["apos"][need, None]), s, NONE)
                scores[need, part] = s
                if s.shape[1] >= k:  # what the block holds lifts the windows' lower ends
                    for w in range(lows.shape[1]):
                        inside = np.where(s <= highs[need, w, None], s, NONE)
                        kth = -np.partition(-inside, k - 1, axis=1)[:, k - 1]
                        lows[need, w] = np.maximum(lows[need, w], kth)
            out: list[list] = [[], [], []]
            for w in range(lows.shape[1]):
                inside = (scores > NONE) & (scores >= lows[:, w, None]) & (scores <= highs[:, w, None])
                for i in np.flatnonzero(inside.any(axis=1)):
                    at = np.flatnonzero(inside[i])
                    at = at[np.lexsort((pos[at], id_[at], no_id[at], -scores[i, at]))[:k]]
                    out[0].append(np.full(len(at), i))
                    out[1].append(np.full(len(at), w, np.int32))
                    out[2].append(at)
            if out[0]:
                i, w, at = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ask["apos"][i]), pa.array(w), pa.array(scores[i, at]),
                    ids.take(pa.array(at)), pa.array(pos[at])],
                    names=["apos", "w", "score", "found_id", "found_pos"])

        return _meet(self.blocks, requests, "shelf", "block", self.shelves, run,
                     "apos long, w int, score long, found_id long, found_pos long")

    def search(self, asking: DataFrame, same: bool, k: int, name: str) -> DataFrame:
        """Best k of each window over the whole table, with their ``rank`` from 1."""
        order = Window.partitionBy("apos", "w").orderBy(
            F.desc("score"), F.asc_nulls_last("found_id"), "found_pos")

        def best(found: DataFrame) -> DataFrame:
            return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

        wave = stored(best(self.visit(self.plan(asking, same, True), same, k)), f"mine-{name}-first")
        full = wave.where(F.col("rank") == k).groupBy("apos").agg(
            F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("_full"))
        raised = F.transform("lows", lambda low, w: F.greatest(
            low, F.coalesce(F.try_element_at("_full", w.cast("int")), low)))
        rest = asking.join(full, "apos", "left").withColumn("lows", F.when(
            F.col("_full").isNull(), F.col("lows")).otherwise(raised)).drop("_full")
        others = self.visit(self.plan(rest, same, False), same, k)
        return stored(best(wave.drop("rank").unionByName(others)), f"mine-{name}")


def mine(vectors: DataFrame) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    spark = vectors.sparkSession
    limit = F.sqrt(F.lit(2.0 ** 55) / F.greatest(F.size("embedding"), F.lit(1)))
    named = vectors.where(F.col("label").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows, dim = of_common_length(stored(quantised(named.withColumn("label", moved), SCALE, limit=limit), "mine-rows"))
    if not dim:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    index = Index(rows, dim)
    anchors = index.rows.where(F.col("vec_id") % ANCHOR_EVERY == 0).select(
        F.col("pos").alias("apos"), F.col("vec_id").alias("anchor_id"), "label", "x")
    anchors = stored(anchors, "mine-anchors")
    whole = lambda n: F.array(F.lit(n).cast("long"))
    positives = index.search(anchors.withColumn("lows", whole(NONE + 1)).withColumn("highs", whole(ANY)),
                             True, POSITIVES, "positives")
    # 50 p <= 100 n <= 95 p in whole numbers
    windows = positives.groupBy("apos").agg(F.sort_array(F.collect_list(F.struct(
        "rank", F.expr("(score + pmod(score, 2L)) div 2").alias("low"),
        F.expr("(95 * score - pmod(95 * score, 100L)) div 100").alias("high")))).alias("_w"))
    # every anchor gets the same number of windows, so that batches are matrices; the rest are empty
    pad = lambda field, none: F.transform(
        F.sequence(F.lit(0), F.lit(POSITIVES - 1)),
        lambda i: F.coalesce(F.get(F.col("_w"), i)[field], F.lit(none).cast("long")))
    asking = anchors.join(windows, "apos").select(
        "apos", "anchor_id", "label", "x", pad("low", ANY).alias("lows"), pad("high", NONE).alias("highs"))
    negatives = index.search(stored(asking, "mine-windows"), False, NEGATIVES, "negatives")
    pairs = anchors.select("apos", "anchor_id").join(positives.select(
        "apos", (F.col("rank") - 1).alias("w"), F.col("found_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "apos")
    return pairs.join(negatives, ["apos", "w"]).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
