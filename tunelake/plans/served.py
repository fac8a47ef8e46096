"""The merged table as it is served: stored by popularity, with what each of its files holds.

Beside the sorted table lies a small one, a row a file and genre: number of tracks, least and
greatest play count. It gives, without a look at the table, a play count that at least n tracks
(of a genre) reach. That goes to the scan as ``play_count >= t``, so row groups below it are never read,
and the top n of what is left are the top n of all. Genre names are resolved on it as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunelake.operators import merge
from tunelake.operators import toptracks as tt


def store_served(merged: DataFrame, path: str) -> DataFrame:
    """Write the table by falling play count to ``path`` and its contents to ``path``_files; read it back.

    A table without its contents is one whose build did not end; it is written again."""
    spark = merged.sparkSession
    merge.sort_by_popularity(merged).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    files = stored.groupBy(F.col("_metadata.file_name").alias("file"), "majority_genre").agg(
        F.count(F.lit(1)).alias("n"), F.min("play_count").alias("low"), F.max("play_count").alias("high"))
    files.coalesce(1).write.mode("overwrite").parquet(f"{path}_files")
    return stored


class ServedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def files(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}_files")

    def reached(self, n: int, genre: str | None = None) -> int | None:
        """A play count that ``n`` tracks have at least, the greatest that the files' bounds prove; None if
        there are not so many tracks."""
        files = self.files() if genre is None else self.files().where(F.col("majority_genre") == genre)
        files = files.groupBy("file").agg(F.sum("n").alias("n"), F.min("low").alias("low"))
        w = Window.orderBy(F.desc("low"), "file")  # a row a file
        enough = files.withColumn("_so_far", F.sum("n").over(w)).where(F.col("_so_far") >= n)
        return enough.agg(F.max("low")).first()[0]

    def best(self, n: int, genre: str | None = None) -> DataFrame:
        """Rows among which are the ``n`` most played (of a genre), read with a pushed play count."""
        rows = self.table() if genre is None else self.table().where(F.col("majority_genre") == F.lit(genre))
        t = self.reached(n, genre)
        return rows if t is None else rows.where(F.col("play_count") >= F.lit(t))

    def top_tracks(self, n: int, index: bool = False) -> DataFrame:
        tt._check_n(n)
        return tt.top_tracks(self.best(n), n, index)

    def top_tracks_by_genre(self, n: int, genre: str, drop_genre: bool = True, cutoff: float = 0.8) -> DataFrame:
        tt._check_n(n)
        resolved = tt.resolve_genre(self.files(), genre, cutoff)
        if resolved == "":
            raise ValueError(f"Genre {genre!r} not found")
        return tt.top_of_genre(self.best(n, resolved), n, resolved, drop_genre)

    def positions(self) -> DataFrame:
        """The table with ``position``, the place of each row in the stored order (from 0)."""
        w = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
        sizes = self.files().groupBy("file").agg(F.sum("n").alias("n"))
        begins = sizes.select("file", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("_first"))  # a row a file
        t = self.table()
        rows = t.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("_row"))
        return rows.join(F.broadcast(begins), "file").select(*t.columns, (F.col("_first") + F.col("_row")).alias("position"))
