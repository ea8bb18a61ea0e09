"""Readers of the bronze newline-JSON trees (S1-S3) and of written marts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.schema import BRONZE
from eventmarts.sinks.publish import read_published

# File-name globs of the two trees.  Stream files are either flushed
# ``events-<uuid>.jsonl`` files or the streaming file sink's part files; the
# historical writer's files are Spark part files.
STREAM_GLOB = "{events-*.json*,part-*.txt,part-*.json*}"
HISTORICAL_GLOB = "{part-*.json*,part-*.txt}"
ANY_BRONZE_GLOB = "{*.json*,part-*.txt}"

def read_bronze(spark: SparkSession, root: str, glob: str = STREAM_GLOB,
                on_bad: str = "fail") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Read a Hive-partitioned bronze tree with the fixed bronze schema.

    Partition discovery adds the tree's partition columns (``dt`` DATE and, for
    the stream tree, ``hour`` INT).  ``on_bad='fail'`` raises on a malformed
    line (Spark's default would silently turn it into an all-NULL row);
    ``on_bad='quarantine'`` returns ``(good, bad)`` with the raw bad lines.
    """
    if on_bad == "fail":
        return (spark.read.schema(BRONZE).option("mode", "FAILFAST")
                .option("pathGlobFilter", glob).json(root))
    if on_bad != "quarantine":
        raise ValueError(f"on_bad must be 'fail' or 'quarantine', not {on_bad!r}")
    # Raw lines (partition columns still discovered); a line is good when it is
    # a JSON object.  Bad lines are kept verbatim for inspection.
    lines = spark.read.option("pathGlobFilter", glob).text(root)
    extra = [c for c in lines.columns if c != "value"]
    ok = F.json_object_keys(F.col("value")).isNotNull()
    good = (lines.where(ok)
            .select(F.from_json("value", BRONZE).alias("_r"), *extra)
            .select("_r.*", *extra))
    bad = lines.where(~ok | F.col("value").isNull())
    return good, bad


def read_stream_bronze(spark: SparkSession, root: str, on_bad: str = "fail"):
    """``<root>/dt=*/hour=*/events-*.jsonl``."""
    return read_bronze(spark, root, STREAM_GLOB, on_bad)


def read_historical_bronze(spark: SparkSession, root: str, on_bad: str = "fail"):
    """``<root>/dt=*/part-*.json*``."""
    return read_bronze(spark, root, HISTORICAL_GLOB, on_bad)


def load_bronze_events(spark: SparkSession, root: str) -> DataFrame:
    """S3: every bronze file (``*.json*``, or a part file of our text writers)
    under ``root`` at any depth, for quality checks.

    An empty tree yields an empty frame, and so does a missing one; any other
    failure to read is raised.
    """
    try:
        return (spark.read.schema(BRONZE).option("mode", "FAILFAST")
                .option("recursiveFileLookup", "true")
                .option("pathGlobFilter", ANY_BRONZE_GLOB).json(root))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], BRONZE)


def read_mart(spark: SparkSession, path_or_table: str) -> DataFrame:
    """A written mart, by table name or path.

    A path ``<warehouse>/<table>`` of a published warehouse is the current version's
    table; any other path is read as Parquet."""
    if "/" not in path_or_table:
        return spark.table(path_or_table)
    warehouse, _, table = path_or_table.rstrip("/").rpartition("/")
    published = read_published(spark, warehouse, table)
    return spark.read.parquet(path_or_table) if published is None else published
