"""Dense 0-based ids and exact positional ranks without a single-partition window.

A global ``row_number()`` moves every row into one task. Instead the rows are
range-partitioned and sorted (``orderBy``), each row is tagged with its
partition and in-partition position, the tagged table is checkpointed into
``spark.checkpoint.dir`` (positions must not change if a task is re-run), and a
per-partition offset table (one row per partition, broadcast) turns positions
into global ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.session import cut_lineage


def sequential_index(df: DataFrame, order: list, id_col: str, start: int = 0) -> DataFrame:
    """``df`` plus ``id_col`` = position in ``order`` (which must be a total order)."""
    tagged = df.orderBy(*order).select(
        "*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_m"))
    tagged = cut_lineage(tagged)
    per_part = tagged.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"), F.min("_m").alias("_m0"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_p", "_m0", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    # one row per partition: bounded by the partition count
    out = tagged.join(F.broadcast(offsets), "_p")
    pos = (F.col("_off") + F.col("_m") - F.col("_m0") + F.lit(start)).cast("bigint")
    return out.select(*df.columns, pos.alias(id_col))


def dense_ids(values: DataFrame, key: str, id_col: str, as_int: bool = True) -> DataFrame:
    """(key, id_col): 0-based ids of the distinct non-null keys, in key order."""
    keys = values.select(key).where(F.col(key).isNotNull()).distinct()
    ids = sequential_index(keys, [F.asc(key)], id_col)
    if as_int:
        ids = ids.withColumn(id_col, F.col(id_col).cast("int"))
    return ids


def extend_ids(known: DataFrame | None, values: DataFrame, key: str, id_col: str) -> DataFrame:
    """``known`` (key, id_col) with the next free ids for keys of ``values`` it lacks, in key order.

    Old ids never change, so what was encoded with them stays valid. Only new keys are sorted and
    numbered, by range partition and offset. Null keys get no id.
    """
    new = values.select(key).where(F.col(key).isNotNull()).distinct()
    if known is None:
        return sequential_index(new, [F.asc(key)], id_col)
    top = known.agg(F.max(id_col)).first()[0]
    new = new.join(known.select(key), key, "left_anti")
    numbered = sequential_index(new, [F.asc(key)], id_col, start=0 if top is None else top + 1)
    return known.select(key, F.col(id_col).cast("bigint").alias(id_col)).unionByName(numbered)
