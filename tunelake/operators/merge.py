"""Plays per song and the merged (tracks + plays + genres) table.

Plan shape: one partial+final hash aggregate on ``song_id`` and two left equi
joins. Neither join side is force-broadcast: both dimension sides grow with the
data, so the planner (and AQE at runtime, from real shuffle sizes) picks a
broadcast only when a side is measured small, else a sort-merge join. A hot
``song_id`` is absorbed by the map-side partial aggregate (one row per key per
task before the shuffle); a hot join key on the streamed side is split by AQE's
skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.schemas import MERGED_COLUMNS


def sum_play_counts(triplets: DataFrame) -> DataFrame:
    """(song_id, play_count): total plays per song."""
    return triplets.groupBy("song_id").agg(F.sum("play_count").cast("bigint").alias("play_count"))


def merge_song_plays(tracks: DataFrame, song_plays: DataFrame) -> DataFrame:
    """Every track with its song's total plays (0 if unplayed).

    A song with several tracks gives each track the full total; plays of songs
    without a track are dropped.
    """
    joined = tracks.join(song_plays.select("song_id", "play_count"), "song_id", "left")
    return joined.select(
        "song_id", "track_id", "artist_name", "title",
        F.coalesce(F.col("play_count"), F.lit(0).cast("bigint")).alias("play_count"),
    )


def merge_track_genres(merged_songs: DataFrame, genres: DataFrame) -> DataFrame:
    """Left join on ``track_id``; missing genres are ``""``; duplicate genre rows fan out.

    Written as inner join + anti join (same rows as a left outer join): AQE's
    skew handling can split either side of an inner join, while a left outer
    join cannot split its right side, where a track with very many genre rows
    would sit. Both joins read the same two shuffles (exchange reuse).
    """
    # the explicit non-null filter makes both branches' inputs identical plans, so
    # the shuffles of both sides are computed once and reused (a null key never joins)
    g = genres.select("track_id", "majority_genre", "minority_genre").where(F.col("track_id").isNotNull())
    merged_songs = merged_songs.where(F.col("track_id").isNotNull())
    cols = ["track_id", "song_id", "title", "artist_name"]
    matched = merged_songs.join(g, "track_id").select(*cols, "majority_genre", "minority_genre", "play_count")
    unmatched = merged_songs.join(g, "track_id", "left_anti").select(
        *cols, F.lit("").alias("majority_genre"), F.lit("").alias("minority_genre"), "play_count")
    return matched.unionByName(unmatched)


def build_merged(triplets: DataFrame, tracks: DataFrame, genres: DataFrame) -> DataFrame:
    """The served table: one lazy plan, no intermediate files."""
    plays = sum_play_counts(triplets)
    return merge_track_genres(merge_song_plays(tracks, plays), genres).select(*MERGED_COLUMNS)


def unplayed_tracks(tracks: DataFrame, song_plays: DataFrame) -> DataFrame:
    """Tracks whose song has no plays."""
    return tracks.join(song_plays.select("song_id"), "song_id", "left_anti")


def ungenred_tracks(tracks: DataFrame, genres: DataFrame) -> DataFrame:
    """Tracks without a genre row."""
    return tracks.join(genres.select("track_id"), "track_id", "left_anti")


def sort_by_popularity(merged: DataFrame) -> DataFrame:
    """Global order: plays descending, ``track_id`` as the unique tie-breaker."""
    return merged.orderBy(F.desc("play_count"), F.asc("track_id"))
