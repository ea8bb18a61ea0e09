"""Exact dedup by an extendible-hash index on shared files.

1. One scan writes ``rows``: id, 64-bit key and SHA-256 of every text, no text.  Rows of
   equal key and digest become one entry (a map-side aggregate, so a hot text is one entry per
   task before the exchange).
2. Texts whose key occurs more than once are read again (a Bloom filter of those keys holds
   back the others), collapse per task, then per key and block of tasks, and meet in the
   task of their key.  It chains the texts of a key, comparing bytes; a chain has one link
   unless two texts collide.  So a hot text reaches that task at most ``TILES`` times, however
   many rows hold it.
3. The key space is cut into ranges by leading bits, each owned by one task.  The owner brings
   the entries of its range into buckets of ``BUCKET_KEYS`` keys: it starts with one bucket,
   and while one is overfull its directory doubles and overfull buckets split by the next bit.
   A key is never split: its chain may be longer than a bucket.  Index rows (bucket,
   key, place in the chain, size and survivor) are written to the shared folder in key order;
   :func:`directory` reads the directory off them.
4. Every row probes the index by key and digest.  Each entry's size must equal the
   number of texts that its owner compared; a difference raises.

The owner holds the entries of one range (``RANGE_KEYS`` keys or so); the number of ranges
follows from the number of keys.

Defined results: a null text counts as empty, so null and empty texts are equal; texts of any
length are compared whole.  The row with the largest id stays; null ids come last, and of
rows with one id, or of rows without ids only, exactly one stays.  An empty table gives
none.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmarts.llm.common import grouped, spread, stored
from eventmarts.plans.bloom import Bloom

BUCKET_KEYS = 64
RANGE_KEYS = 1 << 17
LEAST_RANGE_BITS = 3
TILES = 256

INDEX = ("owner long, prefix long, depth int, key long, place int, sha binary, "
         "n long, keep_id long, keep_row long")


def _body() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def _key(body: str) -> Column:
    return F.xxhash64(body)


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, row, key, sha`` of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.monotonically_increasing_id().alias("row"), _body().alias("body")).select(
        "doc_id", "row", _key("body").alias("key"),
        F.unhex(F.sha2("body", 256)).alias("sha"))


def chains(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``key, place, sha, n``: the different texts of every repeated key, told apart by their
    bytes, and how many rows hold each."""
    bodies = docs.select(_body().alias("body")).select(_key("body").alias("key"), "body")
    some = bodies.where(Bloom(repeated, "key").may_hold(F.col("key")))
    merged = (some.withColumn("tile", F.spark_partition_id() % TILES)
              .groupBy("key", "tile", "body").agg(F.count(F.lit(1)).alias("n")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chain = None, []  # the chain at hand: [text, rows]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([key] * len(chain), pa.int64()),
                pa.array(range(len(chain)), pa.int32()),
                pa.array([hashlib.sha256(t).digest() for t, _ in chain], pa.binary()),
                pa.array([n for _, n in chain], pa.int64())], names=["key", "place", "sha", "n"])

        for batch in batches:
            keys, sizes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, k in enumerate(keys):
                if k != key:
                    if chain:
                        yield out()
                    key, chain = k, []
                text = batch.column(1)[i].as_py()
                link = next((c for c in chain if c[0] == text), None)
                if link is None:
                    chain.append([text, sizes[i]])
                else:
                    link[1] += sizes[i]
        if chain:
            yield out()

    return (spread(merged.select("key", "body", "n"), "key").sortWithinPartitions("key")
            .mapInArrow(run, "key long, place int, sha binary, n long"))


def split_buckets(keys: np.ndarray, bits: int, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, depth) of the buckets of sorted distinct unsigned keys that agree in their
    leading ``bits``.

    Every round doubles the directory (one more bit) and splits the overfull buckets by
    that bit; an empty half is a bucket as well, though no index row shows it."""
    settled, open_ = [], [(0, len(keys))]
    depth = bits
    while open_:
        overfull = []
        for low, high in open_:
            if high - low <= capacity or depth == 64:
                if high > low:
                    settled.append((low, depth))
            else:
                bit = np.uint64(1 << (63 - depth))
                middle = low + int(np.searchsorted((keys[low:high] & bit) != 0, True))
                overfull += [(low, middle), (middle, high)]
        open_, depth = overfull, depth + 1
    settled.sort()
    return np.array([s for s, _ in settled], np.int64), np.array([d for _, d in settled], np.int32)


def _leading(keys: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The leading ``depth`` bits of unsigned keys (depth 1 to 64)."""
    return (keys >> (np.uint64(64) - depth.astype(np.uint64))).view(np.int64)


def build_index(entries: DataFrame, links: DataFrame) -> DataFrame:
    """Index rows (``INDEX``) of ``entries(key, sha, n, keep)`` and ``links(key, place, sha, n)``."""
    keys = entries.select("key").distinct().count()
    bits = max(LEAST_RANGE_BITS, (keys // RANGE_KEYS).bit_length())
    owner = F.shiftrightunsigned("key", 64 - bits).alias("owner")
    rows = entries.select(owner, "key", "sha", "n", F.col("keep.doc_id").alias("keep_id"),
                          F.col("keep.row").alias("keep_row"), F.lit(None).cast("int").alias("place"))
    compared = links.select(owner, "key", "sha", "n", F.lit(None).cast("long").alias("keep_id"),
                            F.lit(None).cast("long").alias("keep_row"), "place")
    capacity = BUCKET_KEYS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "owner"):
            group = group.combine_chunks()
            key, n = group["key"].to_numpy(), group["n"].to_numpy()
            place = group["place"].to_pylist()
            sha = group["sha"].to_pylist()
            seen = {(k, s): (p, m) for k, s, p, m in zip(key.tolist(), sha, place, n.tolist())
                    if p is not None}
            at = [i for i, p in enumerate(place) if p is None]
            for i in at:
                if (n[i] > 1 or (int(key[i]), sha[i]) in seen) and seen.get((int(key[i]), sha[i]), (0, 0))[1] != n[i]:
                    raise RuntimeError("rows of one digest differ in their bytes, or the input changed between two reads")
            unsigned = key[at].astype(np.int64).view(np.uint64)
            distinct, first = np.unique(unsigned, return_inverse=True)
            start, depth = split_buckets(distinct, bits, capacity)
            bucket = np.searchsorted(start, first, side="right") - 1
            depths = depth[bucket]
            rows = group.take(pa.array(at))
            # a single text of a key heads its chain
            places = [seen.get((int(key[i]), sha[i]), (0, 0))[0] for i in at]
            yield pa.RecordBatch.from_arrays([
                rows["owner"].combine_chunks(), pa.array(_leading(unsigned, depths)), pa.array(depths),
                rows["key"].combine_chunks(), pa.array(places, pa.int32()), rows["sha"].combine_chunks(),
                rows["n"].combine_chunks(), rows["keep_id"].combine_chunks(),
                rows["keep_row"].combine_chunks()], names=[c.split()[0] for c in INDEX.split(", ")])

    return (spread(rows.unionByName(compared), "owner").sortWithinPartitions("owner", "key")
            .mapInArrow(run, INDEX))


def directory(index: DataFrame) -> DataFrame:
    """The directory: ``owner, prefix, depth`` of every bucket with rows, its keys, and the
    depth of the owner's directory."""
    buckets = index.groupBy("owner", "prefix", "depth").agg(F.count_distinct("key").alias("keys"))
    tops = buckets.groupBy("owner").agg(F.max("depth").alias("global_depth"))
    return buckets.join(tops, "owner")


def index_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, index) tables of ``docs`` in the shared folder."""
    rows = stored(keyed(docs), "exact-rows")
    entries = stored(rows.groupBy("key", "sha").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("keep")), "exact-entries")
    repeated = stored(entries.groupBy("key").agg(F.sum("n").alias("n"))
                      .where(F.col("n") > 1).select("key"), "exact-repeated")
    return rows, stored(build_index(entries, chains(docs, repeated)), "exact-index")


def dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every document."""
    rows, index = index_documents(docs)
    found = rows.join(index.select("key", "sha", "n", "keep_id", "keep_row"), ["key", "sha"])
    return found.select("doc_id", "keep_id", F.col("n").alias("group_size"),
                        (F.col("row") == F.col("keep_row")).alias("kept"),
                        F.lower(F.hex("sha")).alias("text_sha256"))
