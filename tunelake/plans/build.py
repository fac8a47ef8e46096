"""Batch entry points: raw text files -> typed tables -> the served merged table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunelake.operators import merge
from tunelake.plans import served
from tunelake.sources import parquet, text
from tunelake.sources.store import TableStore, fingerprint, table_path

# File-name markers that pick the four raw inputs.
INPUT_MARKERS = {"genres": "msd", "triplets": "triplets", "tracks": "unique", "lyrics": "mxm"}


def build_sources(spark: SparkSession, raw_paths: list[str], out_dir: str, min_rows: dict[str, int] | None = None) -> dict[str, str]:
    """Parse the raw files (picked by name marker) into tables of the store ``out_dir``; returns their paths.

    A table whose raw file is unchanged since its last finished build is skipped. ``min_rows`` gives the
    least rows of a table, by name: a shorter result raises and leaves the table as it was.
    """
    store, least = TableStore(spark, out_dir), min_rows or {}
    raw = {k: text.pick_source(raw_paths, mark) for k, mark in INPUT_MARKERS.items()}
    mark = {k: fingerprint(spark, [path]) for k, path in raw.items()}

    def ensure(name: str, source: str, build) -> str:
        return store.ensure(name, mark[source], build, least.get(name, 0))

    paths = {
        "genres": ensure("genres", "genres", lambda: text.read_genres(spark, raw["genres"])),
        "triplets": ensure("triplets", "triplets", lambda: text.read_triplets(spark, raw["triplets"])),
        "tracks": ensure("tracks", "tracks", lambda: text.read_tracks(spark, raw["tracks"])),
    }
    lines = text.read_lines(spark, raw["lyrics"])
    paths["vocabulary"] = ensure("vocabulary", "lyrics", lambda: text.parse_vocabulary(lines))
    vocab = spark.read.parquet(paths["vocabulary"])
    paths["lyrics"] = ensure("lyrics", "lyrics", lambda: text.parse_lyrics(lines, vocab))
    paths["lyric_tracks"] = ensure("lyric_tracks", "lyrics", lambda: text.parse_lyric_tracks(lines))
    return paths


def build_merged(spark: SparkSession, table_dir: str, out_path: str | None = None) -> DataFrame:
    """Merged table from the typed tables; optionally stored sorted by popularity."""
    base = table_dir.rstrip("/")
    parquet.require_tables(spark, base, ["triplets", "tracks", "genres"])
    m = merge.build_merged(*[spark.read.parquet(table_path(spark, base, n)) for n in ("triplets", "tracks", "genres")])
    return store_sorted(m, out_path) if out_path else m


def store_sorted(merged: DataFrame, path: str) -> DataFrame:
    """Write the table globally sorted by popularity (range-partitioned sort), with the contents of its files
    beside it (``plans.served``), so that scans skip row groups by ``play_count``; read it back.

    Spark cannot overwrite a path it is reading, so ``path`` must be new.
    """
    return served.store_served(merged, path)
