"""Loads that add to what is there: listening batches, the merged table, stable ids.

A batch's plays are summed once and stored as a table of their own; the totals are the sum of all
batches by song, so new listening files cost their own size and a merge of sums, never a second
read of the old ones. Loading a batch again changes nothing. The merged table is rebuilt from the totals to
a new version, and published when whole (``sources.store``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.operators import merge
from tunelake.operators.ids import extend_ids
from tunelake.plans.served import ServedTable, store_served
from tunelake.sources.store import TableStore

BATCH = "plays-"


def add_listening(store: TableStore, batch: str, triplets: DataFrame) -> bool:
    """Sum and store one batch of (user_id, song_id, play_count); False if it was loaded before."""
    if store.latest(BATCH + batch) is not None:
        return False
    store.publish(BATCH + batch, merge.sum_play_counts(triplets))
    return True


def total_plays(store: TableStore) -> DataFrame:
    """(song_id, play_count) over all loaded batches."""
    paths = [r["path"] for r in store.log().where(F.col("name").startswith(BATCH)).select("path").collect()]  # a row a batch
    if not paths:
        raise ValueError("no listening batch loaded")
    return merge.sum_play_counts(store.spark.read.parquet(*paths))


def rebuild_merged(store: TableStore, tracks: DataFrame, genres: DataFrame) -> ServedTable:
    """A new version of the served table from all batches; the one before stays until it is whole."""
    merged = merge.merge_track_genres(merge.merge_song_plays(tracks, total_plays(store)), genres)
    path = store.publish("merged", merged, write=store_served)
    return ServedTable(store.spark, path)


def update_dictionary(store: TableStore, name: str, values: DataFrame, key: str, id_col: str) -> DataFrame:
    """The stored dictionary (key, id_col) with ids for the new keys of ``values``; known keys keep theirs."""
    known = None if store.latest(name) is None else store.read(name)
    store.publish(name, extend_ids(known, values, key, id_col))
    return store.read(name)
