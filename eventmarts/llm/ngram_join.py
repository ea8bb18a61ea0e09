"""N-gram Jaccard join: a MinHash LSH forest with exact verification.

1. Whole texts become sets of five-word shingles.  Texts with the same words are one
   distinct text (128-bit identity) with a count, so copies are never paired.
2. A distinct text has ``TREES * DEPTH`` minima, i.e. one label of ``DEPTH`` symbols
   per tree.  In a sorted prefix trie of labels, two texts of similarity s share a
   prefix of length k in some tree with probability 1 - (1 - s**k)**TREES.
   ``stop_depth`` shortens prefixes from ``DEPTH`` to the longest k at which this
   reaches the target recall at the threshold.
3. Texts that share a prefix of that length meet in one trie node.  There, subtrees are
   joined from the deepest prefix upwards: texts already joined at a deeper one are not
   compared with each other again, the others by their signatures, with
   ``SLACK`` below the threshold.  Only a spanning forest of edges leaves the node.
4. Connected candidates are brought together with their texts, and all of their pairs are
   verified by exact Jaccard.  What leaves a task is one row per text: its number of
   links (copies counted) and its least linked text.

Large trie nodes and candidate groups are split into tiles of two blocks, so no task
holds a whole group and every pair meets once.  No pairs are emitted.

A class is a connected component of verified links; its id is its smallest doc_id.

Defined results: texts of one to four words have one shingle, all their words.  A
text without words (null, empty, blank) links to nothing and is its own class.  Rows
with the same words link to each other whatever their ids.  A null id never becomes a
class id unless all ids of the class are null.  An empty table gives an empty table.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmarts.llm.common import components, grouped, spread, stored, tiles
from eventmarts.llm.words import Texts, chunks, mix, stream

THRESHOLD = (4, 5)  # 0.8
TREES = 16
DEPTH = 8
RECALL = 0.999
SLACK = 0.15  # four deviations of a similarity estimated from 128 minima
NODE_TEXTS = 4096  # texts per block of a trie node
TILE_SHINGLES = 2_000_000  # shingles per block of a candidate group

_MULTIPLIERS = stream(3, TREES * DEPTH) | np.uint64(1)


def stop_depth(recall: float = RECALL, similarity: float = THRESHOLD[0] / THRESHOLD[1],
               trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which the forest finds a pair of ``similarity`` with ``recall``."""
    for k in range(depth, 1, -1):
        if 1 - (1 - similarity ** k) ** trees >= recall:
            return k
    return 1


def minima(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(texts, TREES * DEPTH) mixed minima and the number of shingles of each text."""
    hashes, first = texts.shingles()
    n = np.diff(first)
    out = np.zeros((len(texts), len(_MULTIPLIERS)), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        at = first[:-1][some]
        for k, m in enumerate(_MULTIPLIERS):
            out[some, k] = np.minimum.reduceat(hashes * m, at)
    return mix(out), n


def signatures(docs: DataFrame, depth: int, id_col: str = "doc_id") -> DataFrame:
    """``id_col, body, tid, shingles, signature, nodes`` of every row.

    ``body`` is a hash of the raw text, ``tid`` identifies the words (null without words); ``signature`` has one byte per
    minimum; ``nodes`` one key per tree, of the prefix of ``depth`` labels.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    trees = stream(4, TREES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in chunks(batch.column(1)):
                low, n = minima(texts)
                same = texts.identity()
                prefix = low.reshape(len(texts), TREES, DEPTH)[:, :, :depth]
                key = np.broadcast_to(trees, (len(texts), TREES))
                for k in range(depth):
                    key = mix(key ^ prefix[:, :, k])
                blank = texts.count == 0
                rows = len(texts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, rows), batch.column(2).slice(row, rows),
                    pa.array([None if b else i.tobytes() for i, b in zip(same, blank)], pa.binary()),
                    pa.array(n, pa.int64()),
                    pa.array([s.tobytes() for s in low.astype(np.uint8)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * TREES),
                                             pa.array(np.ascontiguousarray(key).view(np.int64).ravel())),
                ], names=[id_col, "body", "tid", "shingles", "signature", "nodes"])

    return docs.select(id_col, "text", F.xxhash64("text").alias("body")).mapInArrow(
        run, f"`{id_col}` {id_type}, body long, tid binary, shingles long, signature binary, "
             "nodes array<bigint>")


def _forest(signature: np.ndarray, tree: int, depth: int, least: float) -> list[tuple[int, int]]:
    """Spanning edges among texts that share a trie node, joined from deep to shallow."""
    m, width = signature.shape
    need = least * width
    if m == 2:
        return [(0, 1)] if (signature[0] == signature[1]).sum() >= need else []
    label = signature[:, tree * DEPTH:(tree + 1) * DEPTH]
    group = np.arange(m)  # least text joined to each so far
    edges = []
    for k in range(DEPTH, depth - 1, -1):
        if k == depth:
            order, cuts = np.arange(m), [0, m]
        else:
            order = np.lexsort(label[:, k - 1::-1].T)
            rows = label[order, :k]
            cuts = [0, *(np.flatnonzero((rows[1:] != rows[:-1]).any(axis=1)) + 1).tolist(), m]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a < 2:
                continue
            own = order[a:b]
            roots, sizes = np.unique(group[own], return_counts=True)
            if len(roots) == 1:
                continue
            largest = roots[sizes.argmax()]
            for i in own[group[own] != largest]:
                other = own[group[own] != group[i]]
                if not len(other):
                    break
                near = other[(signature[other] == signature[i]).sum(axis=1) >= need]
                # one edge per joined group
                joined, at = np.unique(group[near], return_index=True)
                for g, j in zip(joined, near[at]):
                    edges.append((int(i), int(j)))
                    group[group == g] = group[i]
    return edges


def candidate_edges(texts: DataFrame, depth: int, least: float) -> DataFrame:
    """Edges ``(a, b)`` between distinct texts that are likely to be similar."""
    keyed = texts.select("tid", F.posexplode("nodes").alias("tree", "node"))
    sizes = keyed.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    members = (keyed.join(sizes, "node")
               .join(texts.select("tid", "signature"), "tid"))
    members = tiles(members.withColumn("node", F.col("node").cast("string")), "node", "tid",
                    F.ceil(F.col("n") / NODE_TEXTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for rows in grouped(batches, "tile"):
            if rows.num_rows < 2:
                continue
            ids = rows["tid"].to_pylist()
            signature = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint8)
            for i, j in _forest(signature.reshape(len(ids), -1), rows["tree"][0].as_py(), depth, least):
                a.append(ids[i])
                b.append(ids[j])
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                                 names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                         names=["a", "b"])

    return (spread(members.select("tile", "tree", "tid", "signature"), "tile")
            .sortWithinPartitions("tile", "tid").mapInArrow(run, "a binary, b binary"))


def similar(sets: list[np.ndarray], valid=None, threshold: tuple[int, int] = THRESHOLD
            ) -> Iterator[tuple[int, np.ndarray]]:
    """(i, others) for every set: the sets of Jaccard similarity at the threshold or above.

    Shingles that most sets hold are counted by the sets that lack them, so near copies
    of one text cost their differences only.
    """
    up, down = threshold
    m = len(sets)
    size = np.array([len(s) for s in sets])
    if m <= 6:
        near = np.zeros((m, m), bool)
        for i in range(m):
            for j in range(i + 1, m):
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                near[i, j] = near[j, i] = down * both >= up * (size[i] + size[j] - both)
        for i in range(m):
            yield i, np.flatnonzero(near[i])
        return
    owner = np.repeat(np.arange(m), size)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    heavy = count > m // 2
    n_heavy = int(heavy.sum())
    # posting lists: of the holders of light shingles, of the lackers of heavy ones
    light = ~heavy[code]
    lists, holder = [code[light]], [owner[light]]
    rank = np.cumsum(heavy) - 1
    held = np.zeros((m, n_heavy), bool) if m * n_heavy < 200_000_000 else None
    if held is None:  # too wide for a table: treat every shingle as light
        heavy[:] = False
        n_heavy = 0
        lists, holder = [code], [owner]
        lacks = np.zeros(m, np.int64)
    else:
        held[owner[~light], rank[code[~light]]] = True
        who, what = np.nonzero(~held)
        lists.append(what + len(count))
        holder.append(who)
        lacks = n_heavy - held.sum(axis=1)
    entry, holder = np.concatenate(lists), np.concatenate(holder)
    by_entry = np.argsort(entry, kind="stable")
    posting = holder[by_entry]
    kinds, begin, length = np.unique(entry[by_entry], return_index=True, return_counts=True)
    slot = np.searchsorted(kinds, entry)
    by_owner = np.argsort(holder, kind="stable")
    bounds = np.searchsorted(holder[by_owner], np.arange(m + 1))
    for i in range(m):
        own = slot[by_owner[bounds[i]:bounds[i + 1]]]
        spans = length[own]
        total = int(spans.sum())
        if total:
            skip = np.repeat(begin[own] - (np.cumsum(spans) - spans), spans)
            both = np.bincount(posting[np.arange(total) + skip], minlength=m)
        else:
            both = np.zeros(m, np.int64)
        both = both + n_heavy - lacks[i] - lacks
        near = down * both >= up * (size + size[i] - both)
        near[i] = False
        yield i, np.flatnonzero(near)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text of a tile: links (copies counted) and the least text it is linked with."""
    ids, links, roots = [], [], []
    for rows in grouped(batches, "tile"):
        texts, sets, row_of = {}, [], []
        wanted = rows["tid"].to_pylist()
        for first, part in chunks(rows["text"]):
            same = part.identity()
            hashes, bounds = part.shingles()
            for k in range(len(part)):
                tid = same[k].tobytes()
                # an id may stand for several rows: the text asked for counts, and once
                if tid == wanted[first + k] and tid not in texts:
                    texts[tid] = len(sets)
                    sets.append(np.unique(hashes[bounds[k]:bounds[k + 1]]))
                    row_of.append(first + k)
        if len(sets) < 2:
            continue
        own_ids = [wanted[r] for r in row_of]
        weight = rows["copies"].to_numpy()[row_of]
        block = rows["blk"].to_numpy()[row_of]
        cross = rows["lo"][0].as_py() != rows["hi"][0].as_py()
        group = np.arange(len(sets))
        for i, near in similar(sets):
            if cross:
                near = near[block[near] != block[i]]
            if not len(near):
                continue
            ids.append(own_ids[i])
            links.append(int(weight[near].sum()))
            roots.append(None)
            joined = np.unique(group[np.append(near, i)])
            if len(joined) > 1:
                group[np.isin(group, joined)] = joined[0]
        for i in np.flatnonzero(group != np.arange(len(sets))):
            ids.append(own_ids[i])
            links.append(0)
            roots.append(own_ids[group[i]])
        if len(ids) > 20_000:
            yield _verified(ids, links, roots)
            ids, links, roots = [], [], []
    yield _verified(ids, links, roots)


def _verified(ids: list, links: list, roots: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.binary()), pa.array(links, pa.int64()), pa.array(roots, pa.binary())],
        names=["tid", "links", "linked"])


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", recall: float = RECALL) -> DataFrame:
    """``id_col, class_id, n_links, text_id`` for every row of ``docs``.

    ``n_links``: other rows of similarity 0.8 or more, copies included; ``text_id``
    identifies the words.
    """
    depth = stop_depth(recall)
    least = THRESHOLD[0] / THRESHOLD[1] - SLACK
    rows = stored(signatures(docs, depth, id_col), "join-signatures")
    worded = rows.where(F.col("tid").isNotNull())
    texts = stored(worded.groupBy("tid").agg(
        F.count(F.lit(1)).alias("copies"), F.min(id_col).alias("first_id"),
        F.min(F.struct(id_col, "body")).alias("place"),
        F.first("shingles").alias("shingles"), F.first("signature").alias("signature"),
        F.first("nodes").alias("nodes")), "join-texts")
    edges = candidate_edges(texts, depth, least)
    groups = components(edges, "join-candidates")

    sizes = (groups.join(texts.select(F.col("tid").alias("node"), "shingles"), "node")
             .groupBy("root").agg(F.sum("shingles").alias("total")))
    members = (groups.withColumnRenamed("node", "tid")
               .join(texts.select("tid", "copies", "place"), "tid").join(sizes, "root"))
    members = tiles(members, "root", "tid", F.ceil(F.col("total") / TILE_SHINGLES))
    members = members.select("tile", "blk", "lo", "hi", "tid", "copies", "place")
    # (id, hash of the text) leads to a row with the words; a struct is never null
    bodies = docs.select(F.struct(F.col(id_col), F.xxhash64("text").alias("body")).alias("place"), "text")
    verified = members.join(bodies, "place").drop("place")
    found = stored(spread(verified, "tile").sortWithinPartitions("tile", "tid")
                   .mapInArrow(_verify, "tid binary, links long, linked binary"), "join-verified")
    links = found.groupBy("tid").agg(F.sum("links").alias("links"))
    classes = components(found.where(F.col("linked").isNotNull())
                         .select(F.col("tid").alias("a"), F.col("linked").alias("b")), "join-classes")
    labelled = (texts.select("tid", "copies", "first_id")
                .join(classes.withColumnRenamed("node", "tid"), "tid", "left")
                .join(links, "tid", "left")
                .withColumn("root", F.coalesce("root", "tid")))
    names = labelled.groupBy("root").agg(F.min("first_id").alias("class_id"))
    summary = labelled.join(names, "root").select(
        "tid", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return (rows.select(id_col, "tid").join(summary, "tid", "left")
            .select(id_col,
                    F.when(F.col("tid").isNull(), F.col(id_col)).otherwise(F.col("class_id"))
                    .alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.lower(F.hex("tid")).alias("text_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each class: that of its smallest id; all columns stay.

    Of several rows with that id and the same words, one stays.  Rows without an id stay.
    """
    # the caller's columns travel in one struct, so no name of theirs meets one of ours
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("doc"), F.col(id_col).alias("id"))
    keep = (jaccard_join(docs, id_col).where(F.col(id_col) == F.col("class_id"))
            .groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("rows")))
    named = rows.where(F.col("id").isNotNull()).join(keep, "id")
    # repeated rows: the join has brought equal ids together already
    alike = F.regexp_replace(F.trim(F.translate(F.coalesce("doc.text", F.lit("")), "\t\n\x0b\x0c\r", "     ")),
                             " +", " ")
    again = Window.partitionBy("id", "words").orderBy(F.xxhash64("doc"))
    single = named.where(F.col("rows") == 1)
    repeated = (named.where(F.col("rows") > 1).withColumn("words", F.md5(alike.cast("binary")))
                .withColumn("k", F.row_number().over(again)).where(F.col("k") == 1))
    return (single.select("doc").unionByName(repeated.select("doc"))
            .unionByName(rows.where(F.col("id").isNull()).select("doc")).select("doc.*"))
