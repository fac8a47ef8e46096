"""Merged table, top tracks and fuzzy genre resolution."""

import pytest

from tunelake.operators import lyrics as ly
from tunelake.operators import merge as mg
from tunelake.operators import toptracks as tt

TRACKS = "track_id string, song_id string, artist_name string, title string"
TRIPLETS = "user_id string, song_id string, play_count bigint"
GENRES = "track_id string, majority_genre string, minority_genre string"


def frames(spark, tracks, triplets, genres):
    return (spark.createDataFrame(triplets, TRIPLETS), spark.createDataFrame(tracks, TRACKS),
            spark.createDataFrame(genres, GENRES))


def test_song_with_two_tracks_gets_full_total(spark):
    tri, trk, gen = frames(spark, [("T1", "S", "a", "x"), ("T2", "S", "a", "y")],
                           [("u1", "S", 5), ("u2", "S", 6)], [("T1", "Rock", "")])
    m = {r.track_id: r for r in mg.build_merged(tri, trk, gen).collect()}
    assert m["T1"].play_count == 11 and m["T2"].play_count == 11
    assert m["T2"].majority_genre == "" and m["T1"].majority_genre == "Rock"


def test_duplicate_genre_rows_fan_out_and_strict_lookup_raises(spark):
    tri, trk, gen = frames(spark, [("T1", "S", "a", "x")], [("u", "S", 1)],
                           [("T1", "Rock", ""), ("T1", "Pop", "")])
    merged = mg.build_merged(tri, trk, gen)
    assert merged.count() == 2
    ids = spark.createDataFrame([("T1",)], "track_id string")
    assert ly.lookup_tracks(merged, ids).count() == 2
    with pytest.raises(ValueError, match="found 2 rows for 1 ids"):
        ly.lookup_tracks(merged, ids, strict=True)


def test_unplayed_and_ungenred(spark):
    tri, trk, gen = frames(spark, [("T1", "S1", "a", "x")], [("u", "S2", 4)], [("T9", "Rock", "")])
    r = mg.build_merged(tri, trk, gen).collect()[0]
    assert (r.play_count, r.majority_genre, r.minority_genre) == (0, "", "")
    assert mg.unplayed_tracks(trk, mg.sum_play_counts(tri)).count() == 1
    assert mg.ungenred_tracks(trk, gen).count() == 1


def _merged(spark, genres):
    rows = [(f"T{i}", f"S{i}", "a", f"t{i}", g, "", i) for i, g in enumerate(genres)]
    return spark.createDataFrame(rows, "track_id string, song_id string, title string, artist_name string, "
                                       "majority_genre string, minority_genre string, play_count bigint")


def test_fuzzy_genre(spark):
    m = _merged(spark, ["ECONOMY", "LARGE", "PROMO", ""])
    assert tt.resolve_genre(m, "econmy") == "ECONOMY"
    assert tt.resolve_genre(m, "zzz") == ""
    with pytest.raises(ValueError, match="zzz"):
        tt.top_tracks_by_genre(m, 10, "zzz")
    got = tt.top_tracks_by_genre(m, 10, "Economy", drop_genre=False).collect()
    assert [r.track_id for r in got] == ["T0"] and got[0].index_number == 0


def test_fuzzy_tie_goes_to_larger_name(spark):
    m = _merged(spark, ["abcdx", "abcdy"])
    assert tt.resolve_genre(m, "abcde") == "abcdy"


def test_top_tracks_order_and_limit(spark):
    m = _merged(spark, ["g"] * 5)
    got = tt.top_tracks(m, 3, index=True).collect()
    assert [r.play_count for r in got] == [4, 3, 2] and [r.index_number for r in got] == [0, 1, 2]
    with pytest.raises(ValueError):
        tt.top_tracks(m, 0)


def test_top_per_genre(spark):
    m = _merged(spark, ["a", "a", "a", "b", ""])
    got = sorted((r.majority_genre, r.track_id, r.index_number) for r in tt.top_tracks_per_genre(m, 2).collect())
    assert got == [("a", "T1", 1), ("a", "T2", 0), ("b", "T3", 0)]


def test_theme_top_tracks_with_score(spark):
    from tunelake.operators import lyrics as ly

    m = _merged(spark, ["g"] * 4)
    scores = spark.createDataFrame([("love", "T1", 9), ("love", "T2", 1), ("love", "T3", 5), ("war", "T0", 7)],
                                   "theme string, track_id string, score bigint")
    got = ly.theme_top_tracks(scores, m, "love", 2, with_score=True).orderBy("index_number").collect()
    assert [(r.play_count, r.score, r.index_number) for r in got] == [(3, 5, 0), (1, 9, 1)]
    assert ly.theme_top_tracks(scores, m, "love", 2).columns == ["artist_name", "title", "play_count",
                                                                  "index_number"]
