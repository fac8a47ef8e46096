"""Versioned tables: a build writes to a new path and counts only once it is whole.

A store is a folder with tables in ``<name>/<version>`` and a log of finished versions, itself a Parquet
table that is only appended to. A table's latest logged version is the table: a build that fails leaves the
one before it in place, and readers of that one are not disturbed. The log also keeps a fingerprint of
the inputs, so a table is built again when they change and skipped while they don't. One writer at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tunelake.sources.parquet import row_count

LOG = "name string, version bigint, path string, rows bigint, inputs string"


def fingerprint(spark: SparkSession, paths: Iterable[str]) -> str:
    """A digest of names, lengths and modification times of all files at or below ``paths``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            raise ValueError(f"missing input {path}")
        if fs.getFileStatus(p).isFile():
            s = fs.getFileStatus(p)
            seen.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
            continue
        files = fs.listFiles(p, True)
        while files.hasNext():
            s = files.next()
            seen.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return hashlib.sha256(repr(sorted(seen)).encode()).hexdigest()


class TableStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def log(self) -> DataFrame:
        """Finished versions of all tables."""
        at = f"{self.base}/_log"
        if row_count(self.spark, at) == 0:
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(at)

    def latest(self, name: str) -> Row | None:
        return self.log().where(F.col("name") == name).orderBy(F.desc("version")).first()

    def path(self, name: str) -> str:
        """Where the table's latest version is."""
        last = self.latest(name)
        if last is None:
            raise ValueError(f"no finished version of {name!r} in {self.base}")
        return last["path"]

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def is_current(self, name: str, inputs: str) -> bool:
        """A finished version for these inputs is there, with all its rows."""
        last = self.latest(name)
        return last is not None and last["inputs"] == inputs and (
            row_count(self.spark, last["path"]) == last["rows"])

    def publish(self, name: str, table: DataFrame, inputs: str = "", min_rows: int = 0,
                write: Callable[[DataFrame, str], object] | None = None) -> str:
        """Write a new version and log it when it is whole; fewer than ``min_rows`` rows raise. ``write``
        stores a table at a path (default: as Parquet)."""
        last = self.latest(name)
        path = f"{self.base}/{name}/{uuid.uuid4().hex}"
        if write is None:
            table.write.parquet(path)
        else:
            write(table, path)
        rows = row_count(self.spark, path)
        if rows < min_rows:
            raise ValueError(f"{name!r} has {rows} rows, fewer than {min_rows}: not published")
        version = 1 if last is None else last["version"] + 1
        self.spark.createDataFrame([(name, version, path, rows, inputs)], LOG).write.mode("append").parquet(f"{self.base}/_log")
        return path

    def ensure(self, name: str, inputs: str, build: Callable[[], DataFrame], min_rows: int = 0, write=None) -> str:
        """The path of the current version for ``inputs``, built if there is none."""
        if self.is_current(name, inputs):
            return self.path(name)
        return self.publish(name, build(), inputs, min_rows, write)


def table_path(spark: SparkSession, base: str, name: str) -> str:
    """The latest version in a store, or the plain folder ``base/name`` of tables written without one."""
    last = TableStore(spark, base).latest(name)
    return f"{base.rstrip('/')}/{name}" if last is None else last["path"]
