"""Labelled texts for training: a bounded sample, by a keyed hash, of rows outside the held-out fold."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, most: int) -> pd.DataFrame:
    """At most ``most`` rows (text, y) per class, least hashes first, and the ``share`` of class 1
    among all training labels. ``train``: condition on doc_id. Rows without a label don't count; of
    repeated ids any text may serve. The rows are collected: the bound is the caller's."""
    lab = labels.where(train & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    lab = lab.groupBy("doc_id").agg(F.max(label).alias("y"))
    share = lab.agg(F.avg("y")).first()[0]
    picked = None
    for y in (0, 1):  # top-k by hash, without a shuffle of all labels
        part = lab.where(F.col("y") == y).orderBy(F.xxhash64(F.lit(3), "doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    # 2 * most ids, a bound of the caller
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    out = rows.groupBy("doc_id", "y").agg(F.max("text").alias("text")).toPandas().sort_values("doc_id", kind="stable")
    out.attrs["share"] = 0.5 if share is None else share
    return out
