"""Lyrics operators on the long bag-of-words table
``lyrics(track_id, mxm_track_id, word_id, word, cnt)``.

Theme scoring, theme top-N (for one or all themes), track lookup, the
vocabulary word filter, document frequency and TF-IDF. The long layout turns
the reference's wide "one column per word" projections into equi-joins with a
small word table, and makes all themes one grouped job.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunelake.functions.strings import is_alpha, py_strip
from tunelake.functions.stopwords import ENGLISH
from tunelake.operators.toptracks import popularity
from tunelake.session import SMALL_ROWS, if_small

HEAVY_SHARE = 0.01       # of the tracks: words in more are joined by broadcast
HEAVY_WORDS = 1_000_000  # of 16 bytes, the most that are broadcast

def stop_words_frame(spark: SparkSession, words: list[str] | None = None) -> DataFrame:
    words = ENGLISH if words is None else words
    return spark.createDataFrame([(w,) for w in words], "stop string")


def filter_vocabulary(vocabulary: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """Keep the original word when ``word.lower().strip()`` is alphabetic and not a stop word."""
    clean = py_strip(F.lower("word"))
    v = vocabulary.withColumn("_clean", clean).where(is_alpha("_clean"))
    stops = F.broadcast(stop_words_frame(vocabulary.sparkSession, stop_words))  # a fixed short list
    return v.join(stops, v["_clean"] == stops["stop"], "left_anti").drop("_clean")


def theme_scores(lyrics: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(theme, track_id, score): per track, the summed counts of the theme's words;
    zero scores dropped. All themes in one aggregate; for a few words the lyrics stay where they are."""
    words = if_small(lexicon.select("theme", F.col("term").alias("word")).distinct())
    joined = lyrics.select("track_id", "word", "cnt").join(words, "word")
    scores = joined.groupBy("theme", "track_id").agg(F.sum("cnt").cast("bigint").alias("score"))
    return scores.where(F.col("score") != 0)


def lookup_tracks(merged: DataFrame, ids: DataFrame, verbose: bool = False, strict: bool = False,
                  bounded: bool = False, most: int | None = None) -> DataFrame:
    """Rows of ``merged`` whose track_id is in ``ids``, most played first, 0-based index.

    ``strict`` reproduces the reference's guard: the number of rows found must
    equal the number of ids (fails on missing tracks and on genre fan-out).
    ``bounded`` says ``ids`` is a small limited set (a top-n, of ``most`` rows if that is known), so a plain
    window may number the rows; otherwise numbering uses ``sequential_index`` (no
    single-partition window).
    """
    from tunelake.operators.ids import sequential_index

    wanted = ids.select("track_id").distinct()
    if bounded:
        wanted = F.broadcast(wanted) if most is not None and most <= SMALL_ROWS else if_small(wanted)
    found = merged.join(wanted, "track_id", "left_semi")
    if strict:
        n_ids, n_found = ids.select("track_id").distinct().count(), found.count()
        if n_ids != n_found:
            raise ValueError(f"track lookup found {n_found} rows for {n_ids} ids")
    cols = ["artist_name", "title", "play_count"] + (["track_id"] if verbose else [])
    found = found.select("track_id", "artist_name", "title", "play_count")
    if bounded:
        w = Window.orderBy(*popularity())
        numbered = found.withColumn("index_number", (F.row_number().over(w) - 1).cast("bigint"))
    else:
        # duplicate merged rows (genre fan-out) are identical here: a unique order needs a row tag
        tagged = found.withColumn("_dup", F.monotonically_increasing_id())
        numbered = sequential_index(tagged, [*popularity(), F.asc("_dup")], "index_number")
    return numbered.select(*cols, "index_number")


def top_scored(scores: DataFrame, theme: str, n: int) -> DataFrame:
    """The ``n`` best-scored tracks of one theme (a top-n, no global sort)."""
    return (scores.where(F.col("theme") == theme)
            .orderBy(F.desc("score"), F.asc("track_id")).limit(n))


def theme_top_tracks(scores: DataFrame, merged: DataFrame, theme: str, n: int = 100,
                     verbose: bool = False, strict: bool = False, with_score: bool = False) -> DataFrame:
    """Take the ``n`` highest scores of ``theme``, return them ordered by plays.

    The reference drops the score; ``with_score`` keeps it as a last column.
    """
    if n <= 0:
        raise ValueError("number of tracks must be positive")
    best = top_scored(scores, theme, n)
    if strict or with_score:  # read more than once
        best = if_small(best)
    out = lookup_tracks(merged, best, verbose or with_score, strict, bounded=True, most=n)
    if not with_score:
        return out
    cols = ["artist_name", "title", "play_count"] + (["track_id"] if verbose else [])
    return out.join(best.select("track_id", "score"), "track_id").select(*cols, "index_number", "score")


def top_scored_per_theme(scores: DataFrame, n: int) -> DataFrame:
    """(theme, track_id, score) of the ``n`` best per theme (WindowGroupLimit)."""
    w = Window.partitionBy("theme").orderBy(F.desc("score"), F.asc("track_id"))
    return scores.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def top_tracks_per_theme(scores: DataFrame, merged: DataFrame, n: int) -> DataFrame:
    """Every theme's top ``n`` by score, re-ranked by plays: one job for all themes."""
    best = top_scored_per_theme(scores, n).select("theme", "track_id")
    rows = merged.select("track_id", "artist_name", "title", "play_count").join(best, "track_id")
    w = Window.partitionBy("theme").orderBy(*popularity())
    return rows.select("theme", "track_id", "artist_name", "title", "play_count",
                       (F.row_number().over(w) - 1).cast("bigint").alias("index_number"))


def weak_labels(scores: DataFrame, merged: DataFrame, n: int = 500) -> DataFrame:
    """(track_id, theme_label): each theme's top ``n`` tracks present in merged,
    all labels stacked in one grouped job (a track may carry two labels)."""
    best = top_scored_per_theme(scores, n).select("track_id", F.col("theme").alias("theme_label"))
    return best.join(merged.select("track_id").distinct(), "track_id", "left_semi")


def label_union(scores: DataFrame, merged: DataFrame, themes: list[str], n: int = 500) -> DataFrame:
    """Same rows as :func:`weak_labels`, built label by label with ``unionByName``
    (the reference's loop shape; duplicates kept)."""
    known = merged.select("track_id").distinct()
    parts = [top_scored(scores, t, n).select("track_id", F.lit(t).alias("theme_label"))
             .join(known, "track_id", "left_semi") for t in themes]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def doc_freq(lyrics: DataFrame) -> DataFrame:
    """(word, df): tracks in which the word occurs (count > 0). A (track, word) pair is one
    row of ``lyrics``, so rows are counted, combined before the shuffle."""
    return lyrics.where(F.col("cnt") > 0).groupBy("word").agg(F.count(F.lit(1)).cast("bigint").alias("df"))


def idf_table(lyrics: DataFrame, tracks: DataFrame | None = None, key: str = "word") -> DataFrame:
    """(key, idf) with smooth idf ln((1+n)/(1+df)) + 1; ``key`` is ``word`` or ``word_id``.

    n counts the rows of ``tracks``; without it, the tracks of ``lyrics`` that
    have a word. It reaches every word as a scalar subquery.
    """
    if tracks is None:
        tracks = lyrics.where(F.col("cnt") > 0).select("track_id").distinct()
    n = tracks.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    idf = F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    df = lyrics.where(F.col("cnt") > 0).groupBy(key).agg(F.count(F.lit(1)).alias("df"))
    return df.select(key, idf.alias("idf"))


def with_idf(cells: DataFrame, idf: DataFrame, key: str, unseen: float | None = None, share: float = HEAVY_SHARE) -> DataFrame:
    """``cells`` with the idf of their word, words in many texts joined apart from the others.

    A word in ``share`` of the fitted tracks or more has an idf of 1 + ln(1 / share) at most. There are no
    more such words than 1 / share times the distinct words of an average track, whatever the corpus: they
    are broadcast (counted first; more than HEAVY_WORDS, from an idf fitted on other tracks, stay in the
    shuffle) and their cells don't move. Only the cells of the other words are shuffled, by a key of which
    none has more than ``share`` of the tracks.
    """
    often = idf.where(F.col("idf") <= 1.0 + math.log(1.0 / share))
    keep_rest = "inner" if unseen is None else "left"
    rest = lambda rows, table: rows.join(table, key, keep_rest).fillna(unseen or 0.0, ["idf"])
    if often.limit(HEAVY_WORDS + 1).count() > HEAVY_WORDS:
        return rest(cells, idf)
    often = F.broadcast(often)
    other = idf.where(F.col("idf") > 1.0 + math.log(1.0 / share))
    return cells.join(often, key).unionByName(rest(cells.join(often, key, "left_anti"), other))


def apply_tfidf(lyrics: DataFrame, idf: DataFrame, unseen: float | None = None, share: float = HEAVY_SHARE) -> DataFrame:
    """(track_id, word, tfidf): cnt * idf, L2-normalised per track.

    ``idf`` is by ``word``, or by ``word_id`` (an integer key in the shuffle). A word without an idf weighs
    ``unseen`` (ln(1+n) + 1 for a fit over n tracks); with None such words are left out. The norm is a window
    per track: one shuffle on track_id, each group bounded by the track's distinct words.
    """
    key = "word_id" if "word_id" in idf.columns else "word"
    cells = lyrics.where(F.col("cnt") > 0).select("track_id", *dict.fromkeys([key, "word"]), "cnt")
    j = with_idf(cells, idf, key, unseen, share)
    w = j.select("track_id", "word", (F.col("cnt") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("track_id")))
    return w.select("track_id", "word", (F.col("w") / norm).alias("tfidf"))


def tfidf(lyrics: DataFrame, words: DataFrame | None = None, word_filter=None) -> DataFrame:
    """TF-IDF fitted and applied on the same tracks; ``words`` (one ``word`` column) restricts the features
    first, e.g. to the filtered vocabulary, or ``word_filter``, a function of the rows that keeps some words'."""
    l = lyrics if word_filter is None else word_filter(lyrics)
    if words is not None:
        l = l.join(words.select("word").distinct(), "word", "left_semi")
    return apply_tfidf(l, idf_table(l, key="word_id" if "word_id" in l.columns else "word"))
