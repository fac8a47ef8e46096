"""Parquet scans, sinks and the materialise-if-incomplete helper."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession


# Error classes and messages of an absent or unfinished table.
INCOMPLETE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER", "is not a Parquet file")


def scan(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Full scan, or a pruned one: only ``columns`` reach the ReadSchema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def row_count(spark: SparkSession, path: str) -> int:
    """Rows in a stored table; 0 when the path is absent, holds no data files or a
    file has no valid footer (a write that did not end). Any other error, such as
    a refused or failing read, is raised.

    ``count()`` on Parquet reads no column data (empty ReadSchema).
    """
    try:
        return spark.read.parquet(path).count()
    except Exception as e:  # noqa: BLE001 - sorted out by INCOMPLETE
        if any(mark in str(e) for mark in INCOMPLETE):
            return 0
        raise


def materialise(spark: SparkSession, path: str, build: Callable[[], DataFrame], min_rows: int = 1) -> DataFrame:
    """Reuse the table at ``path`` if it holds at least ``min_rows`` rows, else
    build it, overwrite, and read it back."""
    if row_count(spark, path) < min_rows:
        write(build(), path)
    return spark.read.parquet(path)


def require_tables(spark: SparkSession, base: str, names: Iterable[str]) -> None:
    """Raise ``ValueError`` naming every expected table that is missing."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for n in names:
        p = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{n}")
        if not p.getFileSystem(conf).exists(p):
            missing.append(n)
    if missing:
        raise ValueError(f"missing input tables under {base}: {', '.join(missing)}")
