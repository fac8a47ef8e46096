"""Fixed table schemas of the music-listening data model.

Only two column types exist in persisted tables: string and bigint. The lyrics
table is kept long (one row per track and word) instead of one column per word.
"""

from pyspark.sql.types import LongType, StringType, StructField, StructType


def _schema(*cols: tuple[str, str]) -> StructType:
    kinds = {"s": StringType(), "l": LongType()}
    return StructType([StructField(name, kinds[k], False) for name, k in cols])


GENRES = _schema(("track_id", "s"), ("majority_genre", "s"), ("minority_genre", "s"))
TRIPLETS = _schema(("user_id", "s"), ("song_id", "s"), ("play_count", "l"))
TRACKS = _schema(("track_id", "s"), ("song_id", "s"), ("artist_name", "s"), ("title", "s"))
SONG_PLAYS = _schema(("song_id", "s"), ("play_count", "l"))
MERGED = _schema(
    ("track_id", "s"), ("song_id", "s"), ("title", "s"), ("artist_name", "s"),
    ("majority_genre", "s"), ("minority_genre", "s"), ("play_count", "l"),
)
VOCABULARY = _schema(("word_id", "l"), ("word", "s"))
LYRICS = _schema(("track_id", "s"), ("mxm_track_id", "l"), ("word_id", "l"), ("word", "s"), ("cnt", "l"))
LEXICON = _schema(("theme", "s"), ("term", "s"))
SYNSETS = _schema(("synset_id", "l"), ("lemma", "s"))

MERGED_COLUMNS = [f.name for f in MERGED.fields]
