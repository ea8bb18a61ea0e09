"""Helpers shared by the operators of this subpackage.

* :func:`stored` writes a frame to the shared folder and reads it back, which
  cuts lineage at a table that survives lost executors.
* :func:`grouped` streams key-sorted Arrow batches group by group.
* :func:`tiles` splits large groups into block pairs, so that no task has to
  hold a whole group while every pair of members still meets exactly once.
* :func:`components` labels connected components with joins and aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.session import materialize

#: Arrow batches end at this many bytes, so a task holds few whole texts at once.
BATCH_BYTES = 8 << 20

#: Characters that end a word: tab to carriage return, and space.
SPACES = " \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that Python tasks receive by bytes, not rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back."""
    return materialize(df, f"llm-{name}")


def spread(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Hash ``df`` by ``keys`` into the session's number of shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` from batches that arrive sorted by it.

    Only the rows of the group at hand and one batch are held.
    """
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(key))
        if n > 1:
            differs = pc.not_equal(col.slice(1), col.slice(0, n - 1))
            cuts = (np.flatnonzero(differs.to_numpy(zero_copy_only=False)) + 1).tolist()
        else:
            cuts = []
        begin = 0
        for end in [*cuts, n]:
            k = col[begin].as_py()
            if held and k != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            held_key = k
            begin = end
    if held:
        yield pa.Table.from_batches(held)


def tiles(df: DataFrame, group: str, member: str, blocks: Column) -> DataFrame:
    """One copy of each row for every tile its block belongs to.

    ``blocks`` is the number of blocks of the row's group.  A member lies in
    block ``hash(member) % blocks``; tile (lo, hi) holds blocks lo and hi.  A
    pair of members meets in one tile: that of its two blocks.  Groups of one
    block, i.e. nearly all, stay single rows.  Adds ``tile`` (binary, the key to
    hash and sort by), ``blk``, ``lo`` and ``hi``.
    """
    out = (df.withColumn("_n", F.greatest(blocks.cast("int"), F.lit(1)))
           .withColumn("blk", F.pmod(F.xxhash64(member), F.col("_n")).cast("int"))
           .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
           .withColumn("lo", F.least("blk", "_o"))
           .withColumn("hi", F.greatest("blk", "_o")))
    key = F.concat(F.col(group).cast("binary"), F.encode(
        F.concat_ws(":", F.lit(""), F.col("lo"), F.col("hi")), "utf-8"))
    return out.withColumn("tile", key).drop("_n", "_o")


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, root)``, root the least node.

    Rounds of min-label exchange along edges with pointer jumping.  Every round
    is written to the shared folder, and only the count of changed labels comes
    to the driver.  A star converges in one round; a chain of length n in about
    log n.
    """
    both = (edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
            .where(F.col("a") != F.col("b")).distinct())
    both = stored(both, f"{name}-edges")
    labels = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.min("b"), F.first("a")).alias("root")), f"{name}-labels")
    while True:
        # least label among the neighbours ...
        near = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        step = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        # ... is offered to the old root as well, then labels jump to their root's label
        offered = (step.where(F.col("low") != F.col("root"))
                   .groupBy(F.col("root").alias("node")).agg(F.min("low").alias("offer")))
        # (written, so that the next join has two plain shuffles, which adaptive execution
        # can split where one root has most of the nodes)
        hooked = stored(step.join(offered, "node", "left")
                        .select("node", F.col("root").alias("was"),
                                F.least("low", F.coalesce("offer", "low")).alias("low")),
                        f"{name}-hooked")
        jump = hooked.select(F.col("node").alias("low"), F.col("low").alias("top"))
        labels = stored(hooked.join(jump, "low", "left")
                        .select("node", F.coalesce("top", "low").alias("root"), "was"),
                        f"{name}-labels")
        changed = labels.where(F.col("root") != F.col("was")).limit(1).count()
        labels = labels.select("node", "root")
        if not changed:
            return labels
