"""Column helpers shared by the training-data operators (JVM-side expressions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that ends a word.
SPACES = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of ``text`` in order; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP))


def as_row(df: DataFrame, name: str = "_row") -> DataFrame:
    """Every input column packed into one struct, so that no later name can clash."""
    return df.select(F.struct("*").alias(name))


def positions(size: Column) -> Column:
    """0 .. size-1, empty for size 0 or less."""
    return F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
