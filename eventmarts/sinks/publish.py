"""Publication of a whole set of tables by one small file.

Tables are written, once and in their final layout, to folders of a run.  A version file
``_published/v<number>.json`` under the warehouse then names the folders of every table; it
is moved into place under a name that does not exist yet, which either happens as a whole or
not at all.  The highest number is the current version.  A reader that resolved a version
keeps reading its folders; a crash before the move leaves the old version as it was; of two
writers that started from one version, the second fails and may run again.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

FOLDER = "_published"


class StalePublication(RuntimeError):
    """Another run has published meanwhile."""


@dataclass
class Version:
    """A published version: its number and the folders of each table, by part.

    A table written as a whole has the one part ``""``; a table kept by date has a part
    per date.  Folders are relative to the warehouse."""

    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, warehouse: str) -> list[int]:
    folder, fs = _hadoop(spark, os.path.join(warehouse, FOLDER))
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"v(\d+)\.json", n)))


def _file(warehouse: str, number: int) -> str:
    return os.path.join(warehouse, FOLDER, f"v{number:012d}.json")


def current(spark: SparkSession, warehouse: str) -> Version:
    """The current version; number 0 and no tables before the first one."""
    numbers = _numbers(spark, warehouse)
    if not numbers:
        return Version()
    text = spark.read.text(_file(warehouse, numbers[-1]), wholetext=True).first()["value"]
    return Version(numbers[-1], json.loads(text))


def publish(spark: SparkSession, warehouse: str, tables: dict[str, dict[str, str]],
            after: int) -> Version:
    """Make ``tables`` the version that follows number ``after``.

    Raises :class:`StalePublication` if that number is taken."""
    number = after + 1
    target, fs = _hadoop(spark, _file(warehouse, number))
    draft, _ = _hadoop(spark, os.path.join(warehouse, FOLDER, f".{uuid.uuid4().hex}"))
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
    finally:
        out.close()
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        draft.toUri() if draft.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(draft, target, none)  # fails if the target exists
    except Py4JJavaError as e:
        if fs.exists(target):
            fs.delete(draft, False)
            raise StalePublication(f"version {number} of {warehouse} is already published") from e
        raise
    return Version(number, tables)


def folders(version: Version, warehouse: str, table: str, parts=None) -> list[str]:
    """Folders of a table, or of some of its parts; parts that do not exist are left out."""
    have = version.tables.get(table, {})
    chosen = have if parts is None else {p: have[p] for p in parts if p in have}
    return [os.path.join(warehouse, chosen[p]) for p in sorted(chosen)]


def read_published(spark: SparkSession, warehouse: str, table: str, version: Version | None = None,
                   parts=None, schema: str | None = None) -> DataFrame | None:
    """A table of the current (or a given) version; None if it has no such part.  With its
    ``schema`` no file is opened to find it."""
    paths = folders(version or current(spark, warehouse), warehouse, table, parts)
    if not paths:
        return None
    return (spark.read.schema(schema) if schema else spark.read).parquet(*paths)


def retire(spark: SparkSession, warehouse: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` versions and the run folders that none of those
    names; returns how many folders went.  Not to be called while a run is being built
    or a reader still holds an older version."""
    numbers = _numbers(spark, warehouse)
    kept, gone = numbers[-max(keep, 1):], 0
    if not kept:
        return 0
    held = set()
    for n in kept:
        text = spark.read.text(_file(warehouse, n), wholetext=True).first()["value"]
        held |= {path for parts in json.loads(text).values() for path in parts.values()}
    runs, fs = _hadoop(spark, os.path.join(warehouse, "_runs"))
    for run in fs.listStatus(runs) if fs.exists(runs) else []:
        own = f"_runs/{run.getPath().getName()}/"
        if not any(p.startswith(own) for p in held):
            fs.delete(run.getPath(), True)
            gone += 1
    for n in numbers[:-len(kept)]:
        fs.delete(_hadoop(spark, _file(warehouse, n))[0], False)
    return gone
