"""Embedding near-dedup by lattice hashing.

1. Vectors are scaled to length 1 and, per table, projected to eight dimensions by
   random orthonormal directions, scaled, shifted at random and decoded to
   the nearest point of the E8 lattice.  A vector is stored under its point in every
   table.
2. Each vector also probes the lattice points around its own one that are nearest to its
   projection (``PROBES`` of the 240 neighbours).
3. Vectors and probes that meet in a cell of one label are compared by cosine in double
   precision; a spanning forest of the true links leaves each cell.
4. Components of these links are brought together, and all of their pairs are compared:
   the number of links of each vector is exact within its component.

Large cells and components are split into tiles of two blocks, so no task holds a
whole group, and pairs are counted, never emitted.

The scale puts a pair at the threshold ``APART`` apart in the projection on average (the
lattice's covering radius is 1).  In a simulation such a pair shares a stored or probed
cell in 84 % of the tables, so all ``TABLES`` miss it with a probability below 1e-6;
tests measure recall against brute force.

Defined results: a vector that is null, empty or zero, or holds a null or a
non-finite component, and a vector without label, links with nothing and is kept.
Vectors of different lengths do not link.  Rows with equal ids are vectors each and
link by their values.  An empty table gives an empty table.  Only ``vec_id``,
``embedding`` and ``label`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmarts.llm.common import components, grouped, spread, stored, tiles
from eventmarts.llm.words import mix

THRESHOLD = 0.98
TABLES = 8
PROBES = 4
APART = 0.6  # mean projected distance of a pair at the threshold
CELL_VECTORS = 4096
SEED = 23


def _decode_d8(x: np.ndarray) -> np.ndarray:
    """Nearest point of D8 (integers of even sum)."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    if len(odd):
        gap = x[odd] - near[odd]
        worst = np.abs(gap).argmax(axis=1)
        at = np.arange(len(odd))
        near[odd, worst] += np.where(gap[at, worst] >= 0, 1, -1)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8 = D8 and D8 + 1/2, for rows of eight coordinates."""
    whole, half = _decode_d8(x), _decode_d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for signs in range(256):
        v = np.array([0.5 if signs >> k & 1 else -0.5 for k in range(8)])
        if (v < 0).sum() % 2 == 0:
            out.append(v)
    return np.array(out)


_NEIGHBOURS = neighbours()


def _cells(points: np.ndarray, table: int, label: np.ndarray) -> np.ndarray:
    """64-bit keys of lattice points of a table and a label."""
    key = mix(label.astype(np.int64).view(np.uint64) ^ np.uint64(0x51ED270B * (table + 1)))
    doubled = np.rint(points * 2).astype(np.int64)
    for k in range(8):
        key = mix(key ^ mix(doubled[..., k].view(np.uint64)
                            + np.uint64(0x9E3779B9 * (k + 1))))
    return key.view(np.int64)


def table_directions(dim: int, table: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal directions (dim, 8) and shift of a table."""
    rng = np.random.default_rng([seed, dim, table])
    basis, _ = np.linalg.qr(rng.standard_normal((max(dim, 8), 8)))
    return basis[:dim], rng.uniform(0, 2, 8)


def hash_vectors(unit: np.ndarray, label: np.ndarray, tables: int = TABLES, probes: int = PROBES,
                 threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """((n, tables) stored cells, (n, tables, probes) probed cells) of unit vectors."""
    dim = unit.shape[1]
    apart = np.sqrt(2 - 2 * threshold) * np.sqrt(min(1.0, 8 / dim))
    own = np.empty((len(unit), tables), np.int64)
    near = np.empty((len(unit), tables, probes), np.int64)
    for t in range(tables):
        basis, shift = table_directions(dim, t)
        x = unit @ basis * (APART / apart) + shift
        point = decode_e8(x)
        own[:, t] = _cells(point, t, label)
        # a neighbour p + v is nearer the larger (x - p) . v is; all v have one length
        gain = (x - point) @ _NEIGHBOURS.T
        best = np.argpartition(-gain, probes, axis=1)[:, :probes]
        for k in range(probes):
            near[:, t, k] = _cells(point + _NEIGHBOURS[best[:, k]], t, label)
    return own, near


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def usable(vectors: DataFrame) -> DataFrame:
    """``row, label, v (array<double>)`` of vectors that can link."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != F.lit(float("inf"))))
    return (vectors.where(F.col("label").isNotNull() & F.coalesce(F.size("embedding") > 0, F.lit(False)))
            .where(finite & F.exists(v, lambda x: x != 0))
            .select("row", "label", v.alias("v")))


def cells(rows: DataFrame) -> DataFrame:
    """``nid, cell, probe`` for the stored and probed cells of ``rows(nid, label, v)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = np.array([len(x) for x in lists])
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                some = batch.take(pa.array(at))
                unit = _unit(_matrix(pa.chunked_array([some.column(2)])))
                label = some.column(1).to_numpy(zero_copy_only=False).astype(np.int64) + (int(dim) << 40)
                own, near = hash_vectors(unit, label)
                for begin in range(0, len(unit), 1024):
                    part = slice(begin, begin + 1024)
                    each = np.concatenate([own[part], near[part].reshape(len(own[part]), -1)], axis=1)
                    n = each.shape[1]
                    ids = some.column(0).slice(begin, len(each))
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(np.repeat(np.arange(len(each)), n))),
                        pa.array(each.ravel()),
                        pa.array(np.tile(np.arange(n) >= own.shape[1], len(each))),
                    ], names=["nid", "cell", "probe"])

    return rows.select("nid", F.xxhash64("label").alias("label"), "v").mapInArrow(
        run, "nid long, cell long, probe boolean")


def _linked(unit: np.ndarray, threshold: float, rows: slice) -> np.ndarray:
    """Cosine at the threshold or above, of a block of rows with all."""
    near = unit[rows] @ unit.T >= threshold
    near[np.arange(near.shape[0]), np.arange(rows.start, rows.start + near.shape[0])] = False
    return near


def _forest(unit: np.ndarray, probe: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Spanning edges of the links in a cell; two probes are not compared."""
    m = len(unit)
    group, edges = np.arange(m), []
    for begin in range(0, m, 512):
        near = _linked(unit, threshold, slice(begin, min(begin + 512, m)))
        near &= ~(probe[begin:begin + 512, None] & probe[None, :])
        for i in np.flatnonzero(near.any(axis=1)):
            others = np.flatnonzero(near[i])
            others = others[group[others] != group[begin + i]]
            if not len(others):
                continue
            roots, first = np.unique(group[others], return_index=True)
            edges += [(int(begin + i), int(others[k])) for k in first]
            group[np.isin(group, roots)] = group[begin + i]
    return edges


def cell_links(rows: DataFrame, threshold: float) -> DataFrame:
    """Spanning links ``(a, b)`` of every cell that holds two vectors."""
    found = stored(cells(rows), "lattice-cells")
    sizes = (found.groupBy("cell").agg(F.count(F.lit(1)).alias("n"),
                                       F.count(F.when(~F.col("probe"), 1)).alias("kept"))
             .where((F.col("n") > 1) & (F.col("kept") > 0)))
    members = found.join(sizes, "cell").join(rows.select("nid", "v"), "nid")
    members = tiles(members.withColumn("cell", F.col("cell").cast("string")), "cell", "nid",
                    F.ceil(F.col("n") / CELL_VECTORS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in grouped(batches, "tile"):
            if group.num_rows > 1:
                ids = group["nid"].to_numpy()
                for i, j in _forest(_unit(_matrix(group["v"])),
                                    group["probe"].to_numpy(), threshold):
                    a.append(int(ids[i]))
                    b.append(int(ids[j]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                         names=["a", "b"])

    return (spread(members.select("tile", "nid", "probe", "v"), "tile")
            .sortWithinPartitions("tile", "nid").mapInArrow(run, "a long, b long"))


def component_counts(rows: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """``nid, links`` over all pairs of a component."""
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    members = (groups.withColumnRenamed("node", "nid").join(sizes, "root")
               .join(rows.select("nid", "copies", "v"), "nid"))
    members = tiles(members.withColumn("root", F.col("root").cast("string")), "root", "nid",
                    F.ceil(F.col("n") / CELL_VECTORS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "tile"):
            unit, block = _unit(_matrix(group["v"])), group["blk"].to_numpy()
            cross = group["lo"][0].as_py() != group["hi"][0].as_py()
            copies, links = group["copies"].to_numpy(), np.zeros(len(unit), np.int64)
            for begin in range(0, len(unit), 512):
                near = _linked(unit, threshold, slice(begin, min(begin + 512, len(unit))))
                if cross:
                    near &= block[begin:begin + 512, None] != block[None, :]
                links[begin:begin + 512] = near @ copies
            yield pa.RecordBatch.from_arrays(
                [group["nid"].combine_chunks(), pa.array(links)], names=["nid", "links"])

    return (spread(members.select("tile", "blk", "lo", "hi", "nid", "copies", "v"), "tile")
            .sortWithinPartitions("tile", "nid").mapInArrow(run, "nid long, links long")
            .groupBy("nid").agg(F.sum("links").alias("links")))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``."""
    everything = stored(vectors.select(
        "vec_id", "embedding", "label", F.monotonically_increasing_id().alias("row")), "lattice-rows")
    valid = usable(everything).withColumn("same", F.md5(F.to_json("v").cast("binary")))
    # equal vectors of a label are one node with a count
    nodes = stored(valid.groupBy("label", "same").agg(
        F.min("row").alias("nid"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")),
        "lattice-nodes")
    groups = components(cell_links(nodes, threshold), "lattice-links")
    links = component_counts(nodes, groups, threshold)
    summary = (nodes.select("label", "same", "nid", "copies")
               .join(groups.withColumnRenamed("node", "nid"), "nid", "left")
               .join(links, "nid", "left")
               .select("label", "same", F.coalesce("root", "nid").alias("root"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    named = valid.select("row", "label", "same").join(summary, ["label", "same"])
    placed = everything.select("vec_id", "row").join(
        named.select("row", "root", "n_links"), "row", "left")
    names = (placed.where(F.col("root").isNotNull()).groupBy("root")
             .agg(F.min("vec_id").alias("name")))
    component = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("name"))
    return (placed.join(names, "root", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"),
                    F.col("vec_id").eqNullSafe(component).alias("kept")))
