"""Micro fixtures for the text sources (FIXTURES.md section 3)."""

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tunelake import schemas
from tunelake.sources import parquet, text


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_comment_ragged_extra(lines):
    df = text.parse_delimited(lines(b"# c\na\tb\na\tb\t3\tx\n"), schemas.TRIPLETS, "\t")
    assert sorted(rows(df)) == [("a", "b", 0), ("a", "b", 3)]


def test_blank_line_defaults_and_skip(lines):
    data = b"a\tb\t1\n\nc\td\t2\n"
    assert ("", "", 0) in rows(text.parse_delimited(lines(data), schemas.TRIPLETS, "\t"))
    assert ("", "", 0) not in rows(text.parse_delimited(lines(data), schemas.TRIPLETS, "\t", skip_blank=True))


def test_bad_int_fails(lines):
    with pytest.raises(Exception, match="invalid play_count"):
        text.parse_delimited(lines(b"a\tb\tx\n"), schemas.TRIPLETS, "\t").collect()


def test_python_int_grammar(lines):
    df = text.parse_delimited(lines(b"a\tb\t +5 \nc\td\t1_000\ne\tf\t-2\n"), schemas.TRIPLETS, "\t")
    assert sorted(r[2] for r in rows(df)) == [-2, 5, 1000]


def test_invalid_utf8_becomes_spaces(lines):
    df = text.parse_delimited(lines(b"x\xff\xfey\tq\n"), schemas.GENRES, "\t")
    assert rows(df) == [("x  y", "q", "")]


def test_crlf_line_end(lines):
    assert rows(text.parse_delimited(lines(b"a\tb\t3\r\n"), schemas.TRIPLETS, "\t")) == [("a", "b", 3)]


def test_literal_separator(lines):
    df = text.parse_delimited(lines(b"a<SEP>b<SEP><SEP>\n"), schemas.TRACKS, "<SEP>")
    assert rows(df) == [("a", "b", "", "")]


def test_whitespace_split(lines):
    schema = StructType([StructField("a", StringType()), StructField("b", LongType())])
    df = text.parse_delimited(lines(b"  x   7  \n\n"), schema, None)
    assert sorted(rows(df)) == [("", 0), ("x", 7)]


def test_vocabulary_and_lyrics(lines):
    raw = b"# comment\n%i,the,you\nT1,7,1:2,3:1\nT2,8,2:5\n"
    df = lines(raw)
    assert sorted(rows(text.parse_vocabulary(df))) == [(1, "i"), (2, "the"), (3, "you")]
    got = sorted(rows(text.parse_lyrics(df)))
    assert got == [("T1", 7, 1, "i", 2), ("T1", 7, 3, "you", 1), ("T2", 8, 2, "the", 5)]


def test_last_vocabulary_line_wins(lines):
    df = lines(b"%a,b\n%x,y,z\nT1,1,3:4\n")
    assert rows(text.parse_lyrics(df)) == [("T1", 1, 3, "z", 4)]


def test_repeated_word_id_last_wins(lines):
    df = lines(b"%i,the,you\nT1,7,1:2,1:4\n")
    assert rows(text.parse_lyrics(df)) == [("T1", 7, 1, "i", 4)]


def test_track_without_words(lines):
    df = lines(b"%i,the\nT1,7\nT2,8,2:1\n")
    assert rows(text.parse_lyrics(df)) == [("T2", 8, 2, "the", 1)]
    assert sorted(rows(text.parse_lyric_tracks(df))) == [("T1", 7), ("T2", 8)]


def test_word_id_out_of_range(lines):
    df = lines(b"%i,the\nT1,7,0:1,3:1,2:2\n")
    assert rows(text.parse_lyrics(df)) == [("T1", 7, 2, "the", 2)]
    with pytest.raises(Exception, match="outside the vocabulary"):
        text.parse_lyrics(df, strict=True).collect()


def test_render_parse_roundtrip(spark):
    vocab = spark.createDataFrame([(1, "a"), (2, "b")], "word_id bigint, word string")
    lyr = spark.createDataFrame([("T1", 1, 1, "a", 3), ("T1", 1, 2, "b", 1), ("T2", 2, 2, "b", 9)],
                                "track_id string, mxm_track_id bigint, word_id bigint, word string, cnt bigint")
    back = text.parse_lyrics(text.render_lyrics(lyr, vocab))
    assert sorted(rows(back)) == sorted(rows(lyr))


def test_one_row_written(spark, tmp_path, lines):
    df = text.parse_delimited(lines(b"a\tb\t1\n"), schemas.TRIPLETS, "\t")
    p = parquet.write(df, str(tmp_path / "one"))
    assert parquet.row_count(spark, p) == 1


def test_row_count_of_absent_and_broken_tables(spark, tmp_path):
    assert parquet.row_count(spark, str(tmp_path / "absent")) == 0
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"not a parquet file at all")
    assert parquet.row_count(spark, str(broken)) == 0
    with pytest.raises(Exception, match="(?i)scheme"):
        parquet.row_count(spark, "nosuchstore://x/y")


def test_materialise_skips_complete_table(spark, tmp_path):
    p = str(tmp_path / "m")
    built = []

    def build():
        built.append(1)
        return spark.range(5)

    parquet.materialise(spark, p, build, min_rows=5)
    parquet.materialise(spark, p, build, min_rows=5)
    assert len(built) == 1
    parquet.materialise(spark, p, build, min_rows=6)  # incomplete: rebuilt
    assert len(built) == 2


def test_require_tables(spark, tmp_path):
    (tmp_path / "a").mkdir()
    parquet.require_tables(spark, str(tmp_path), ["a"])
    with pytest.raises(ValueError, match="b"):
        parquet.require_tables(spark, str(tmp_path), ["a", "b"])


def test_pick_source():
    assert text.pick_source(["x/msd_a.cls", "y/train_triplets.txt", "z/msd_b.cls"], "msd") == "z/msd_b.cls"
    with pytest.raises(ValueError):
        text.pick_source(["a.txt"], "mxm")


def test_lyrics_pivot(spark):
    lyr = spark.createDataFrame([("T1", 1, 1, "a", 3), ("T2", 2, 2, "b", 9)],
                                "track_id string, mxm_track_id bigint, word_id bigint, word string, cnt bigint")
    assert sorted(rows(text.lyrics_pivot(lyr, ["a", "b"]))) == [("T1", 3, 0), ("T2", 0, 9)]


def test_build_sources_and_merged(spark, tmp_path):
    """The batch entry points on tiny raw files: parse four inputs, build the served table."""
    from tunelake.plans.build import build_merged, build_sources

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "msd_tagtraum_cd2.cls").write_bytes(b"# genres\nT1\tRock\tPop\nT3\tJazz\n")
    (raw / "train_triplets.txt").write_bytes(b"u1\tS1\t2\nu2\tS1\t3\nu1\tS2\t1\n")
    (raw / "unique_tracks.txt").write_bytes(b"T1<SEP>S1<SEP>Ann<SEP>One\nT2<SEP>S1<SEP>Ann<SEP>One b\n"
                                            b"T3<SEP>S3<SEP>Bob<SEP>Three\n")
    (raw / "mxm_dataset_train.txt").write_bytes(b"# lyrics\n%love,war\nT1,11,1:3\nT3,33,2:1,1:1\n")
    paths = build_sources(spark, [str(p) for p in sorted(raw.iterdir())], str(tmp_path / "tables"))
    assert spark.read.parquet(paths["lyrics"]).count() == 3
    assert spark.read.parquet(paths["vocabulary"]).count() == 2
    m = build_merged(spark, str(tmp_path / "tables"), out_path=str(tmp_path / "merged_sorted"))
    got = sorted((r.track_id, r.play_count, r.majority_genre, r.minority_genre) for r in m.collect())
    assert got == [("T1", 5, "Rock", "Pop"), ("T2", 5, "", ""), ("T3", 0, "Jazz", "")]


def test_library_facades(spark, tmp_path):
    """The user-level facades on tiny stored tables."""
    from tunelake.plans.build import build_sources
    from tunelake.plans.library import MusicLibrary, Recommender, ThemeCollections

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "msd_tagtraum_cd2.cls").write_bytes(b"T1\tRock\tPop\nT2\tRock\nT3\tJazz\n")
    plays = b"".join(f"u{u}\tS{s}\t{1 + (u + s) % 4}\n".encode() for u in range(8) for s in range(6) if (u + s) % 3)
    (raw / "train_triplets.txt").write_bytes(plays)
    (raw / "unique_tracks.txt").write_bytes(b"".join(f"T{s}<SEP>S{s}<SEP>A{s}<SEP>t{s}\n".encode()
                                                     for s in range(6)))
    (raw / "mxm_dataset_train.txt").write_bytes(b"%love,heart,war,gun\nT1,1,1:3,2:1\nT2,2,3:2\nT3,3,1:1,4:5\n")
    tables = str(tmp_path / "tables")
    build_sources(spark, [str(p) for p in sorted(raw.iterdir())], tables)
    spark.createDataFrame([("love", "love"), ("war", "war")], "theme string, term string") \
        .write.parquet(f"{tables}/lexicon")
    spark.createDataFrame([(1, "love"), (1, "heart"), (2, "war"), (2, "gun")], "synset_id bigint, lemma string") \
        .write.parquet(f"{tables}/synsets")
    lib = MusicLibrary(spark, tables)
    assert lib.top_tracks(3).count() == 3
    assert {r.title for r in lib.top_tracks_by_genre(10, "rok").collect()} <= {"t1", "t2"}
    col = ThemeCollections(spark, tables)
    assert {r.title for r in col.baseline("love", 5).collect()} == {"t1", "t3"}
    assert col.word2vec("love", 5).count() >= 1
    assert col.classification("war", 5, verbose=True).columns[-2:] == ["track_id", "index_number"]
    rec = Recommender(spark, tables, rank=2, max_iter=2)
    assert rec.get_similar_tracks("u0", 2).count() <= 2
    assert rec.get_common_listened_tracks("S1", 2).count() == 2
    assert rec.evaluate(2).count() == 1


def test_malformed_lyrics_item_fails(lines):
    with pytest.raises(Exception, match="malformed"):
        text.parse_lyrics(lines(b"%i,the\nT1,7,1:x\n")).collect()
    with pytest.raises(Exception, match="malformed"):
        text.parse_lyrics(lines(b"%i,the\nT1,7,1:2,\n")).collect()


@pytest.mark.parametrize("strict", [False, True])
def test_words_of_the_vocabulary_line_are_not_broadcast(lines, strict):
    """The planner takes the line's words for one row; all of them would go to the driver."""
    rows = lines(b"%a,b,c\nT1,1,1:2,3:4\nT2,2,2:1\n")
    got = text.parse_lyrics(rows, strict=strict)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.track_id, r.word, r.cnt) for r in got.collect()) == [("T1", "a", 2), ("T1", "c", 4), ("T2", "b", 1)]
