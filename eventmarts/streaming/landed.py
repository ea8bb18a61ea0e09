"""Which event ids a bronze tree holds already: the state behind replays of any age (T5, K3).

The state lies under one folder as two Parquet tables by event date, both sets that only grow:

* ``ids``: the landed (event date, event id), with the id's place in the filter;
* ``filter``: a Bloom filter of those ids per event date, as words of 64 bits.  An id has one
  word of its date and four bits in it, so a filter is built by ``bit_or``, several are merged
  by ``bit_or``, and a test is one equi-join and a comparison, all inside the JVM.

A record's date is that of its own ``event_timestamp`` (``undated`` without a readable one), which a
replay repeats; so a batch reads the state of the dates it brings and of no other.  Ids that miss the
filter are new.  The others -- replays, and the few ids whose bits are set by chance --
are settled by a join with the ids of those dates, so no new id is held back however full a
filter is.  If a batch has no such ids, no id is read.  These joins move ids alone, not records.

A batch adds one *piece* to each of its dates, named by the query and the batch.  A batch that
is tried again does not see its own piece and replaces it.  Pieces of a date are merged once there
are more than ``MOST_PIECES``; as both tables are sets, a piece left over by a crash between
writing the merged one and removing the others changes nothing.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.session import shared_dir
from eventmarts.sinks.publish import _hadoop

WORDS = 1 << 26  # words of a date's filter; only those that hold a bit are stored
MOST_PIECES = 32
UNDATED = "undated"
_KEYS = ["event_date", "word"]
_SCHEMAS = {"ids": "event_id string, word long, event_date string, piece string",
            "filter": "word long, bits long, event_date string, piece string"}


def event_date(value: Column) -> Column:
    """The date of a raw record's own time, as text."""
    at = F.try_to_timestamp(F.get_json_object(value, "$.event_timestamp"))
    return F.coalesce(F.to_date(at).cast("string"), F.lit(UNDATED))


def placed(df: DataFrame) -> DataFrame:
    """``df`` with the filter place of its ``event_id``: ``word`` and the four bits ``mask``."""
    other = F.xxhash64("event_id", F.lit(1))
    mask = F.lit(0).cast("long")
    for k in range(4):
        bit = F.shiftrightunsigned(other, 6 * k).bitwiseAND(F.lit(63).cast("long")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return (df.withColumn("word", F.pmod(F.xxhash64("event_id"), F.lit(WORDS).cast("long")))
            .withColumn("mask", mask))


class LandedIds:
    """The state under ``root``, as batch ``batch`` of the query ``run`` sees it."""

    def __init__(self, spark: SparkSession, root: str, run: str, batch: int):
        self.spark, self.root, self.run, self.batch = spark, root, run, batch
        self._scratch = shared_dir(spark, "tables", "landed-batch")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written for the time of this batch, so that it is computed once."""
        path = os.path.join(self._scratch, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _pieces(self, table: str, date: str) -> list[str]:
        """Folders of a date's pieces, without those of this batch."""
        folder, fs = _hadoop(self.spark, os.path.join(self.root, table, f"event_date={date}"))
        if not fs.exists(folder):
            return []
        names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
        return [os.path.join(folder.toString(), n) for n in names
                if n.startswith("piece=") and n != f"piece={self.run}_{self.batch}"]

    def _read(self, table: str, dates: list[str]) -> DataFrame | None:
        paths = [p for d in dates for p in self._pieces(table, d)]
        if not paths:
            return None
        return (self.spark.read.schema(_SCHEMAS[table])
                .option("basePath", os.path.join(self.root, table)).parquet(*paths).drop("piece"))

    def _write(self, table: str, rows: DataFrame, piece: str) -> None:
        (rows.withColumn("piece", F.lit(piece)).repartitionByRange(*_KEYS).sortWithinPartitions(*_KEYS)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date", "piece").parquet(os.path.join(self.root, table)))

    def unseen(self, records: DataFrame) -> DataFrame:
        """The ``records`` (one per event date and id; ``placed``) that have not landed."""
        dates = sorted(r[0] for r in records.select("event_date").distinct().collect())  # a row a day
        words = self._read("filter", dates)
        if words is None:
            return records
        key = [*_KEYS, "event_id"]
        words = words.groupBy(*_KEYS).agg(F.bit_or("bits").alias("bits"))
        suspects = self.keep(records.select(*key, "mask").join(words, _KEYS).where(
            F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select(*key), "suspects")
        if suspects.isEmpty():
            return records
        known = self.keep(suspects.join(self._read("ids", dates), key, "left_semi"), "known")
        return records.join(known, key, "left_anti").select(*records.columns)

    def release(self) -> None:
        """Delete what :meth:`keep` wrote."""
        folder, fs = _hadoop(self.spark, self._scratch)
        fs.delete(folder, True)

    def add(self, records: DataFrame) -> None:
        """Note that ``records`` land with this batch."""
        piece = f"{self.run}_{self.batch}"
        self._write("ids", records.select("event_id", *_KEYS), piece)
        self._write("filter", records.groupBy(*_KEYS).agg(F.bit_or("mask").alias("bits")), piece)

    def merge(self, dates: list[str]) -> list[str]:
        """Merge the pieces of those of ``dates`` that have more than ``MOST_PIECES``; returns them."""
        merged = []
        for table in ("ids", "filter"):
            old = {d: self._pieces(table, d) for d in dates}
            full = [d for d in dates if len(old[d]) > MOST_PIECES]
            if not full:
                continue
            rows = self._read(table, full)
            rows = (rows.distinct() if table == "ids"
                    else rows.groupBy(*_KEYS).agg(F.bit_or("bits").alias("bits")))
            name = f"merged_{self.run}_{self.batch}"
            self._write(table, rows, name)
            for path in (p for d in full for p in old[d]):
                if not path.endswith(f"piece={name}"):
                    folder, fs = _hadoop(self.spark, path)
                    fs.delete(folder, True)
            merged = sorted({*merged, *full})
        return merged
