"""User-level entry points over stored tables (the reference's three facades).

* ``MusicLibrary``: build the merged table, top tracks, top tracks by genre.
* ``ThemeCollections``: baseline / Word2Vec / classifier collections for a theme.
* ``Recommender``: ALS fitted lazily once; recommendations for a user, similar
  songs, and the held-out evaluation.

Tables are read from ``table_dir`` (``build_sources`` output plus ``lexicon``
and ``synsets``); every method returns a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.operators import keywords as kw
from tunelake.operators import lyrics as ly
from tunelake.operators import recommend as rc
from tunelake.plans import build, themed
from tunelake.plans.served import ServedTable
from tunelake.sources.store import table_path


class MusicLibrary:
    def __init__(self, spark: SparkSession, table_dir: str, merged_path: str | None = None):
        self.spark, self.dir = spark, table_dir.rstrip("/")
        self.merged_path = merged_path or f"{self.dir}/merged_sorted"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(table_path(self.spark, self.dir, name))

    def served(self) -> ServedTable:
        """The served table, built and stored sorted once (rebuilt if its file list is missing)."""
        from tunelake.sources.parquet import row_count

        if row_count(self.spark, f"{self.merged_path}_files") == 0:
            build.build_merged(self.spark, self.dir, out_path=self.merged_path)
        return ServedTable(self.spark, self.merged_path)

    def merged(self) -> DataFrame:
        return self.served().table()

    def top_tracks(self, n: int = 100) -> DataFrame:
        return self.served().top_tracks(n)

    def top_tracks_by_genre(self, n: int, genre: str, drop_genre: bool = True) -> DataFrame:
        return self.served().top_tracks_by_genre(n, genre, drop_genre)


class ThemeCollections(MusicLibrary):
    def __init__(self, spark: SparkSession, table_dir: str, labels: list[str] | None = None, **kw):
        super().__init__(spark, table_dir, **kw)
        self.labels = labels
        self._classifier = self._vectors = None

    def baseline(self, theme: str, n: int = 100) -> DataFrame:
        lexicon = kw.require_keywords(self.table("lexicon"), theme)
        out = themed.collection_baseline(self.table("lyrics"), self.table("vocabulary"), lexicon.where(F.col("theme") == theme),
                                         self.table("synsets"), self.merged(), n)
        return out.where(F.col("theme") == theme).drop("theme")

    def vectors(self) -> DataFrame:
        """Word vectors of the reference's input, the filtered vocabulary as one sentence; trained once."""
        if self._vectors is None:
            sentence = kw.vocabulary_sentence(ly.filter_vocabulary(self.table("vocabulary")))
            self._vectors = kw.word_vectors(kw.train_word2vec(sentence))
        return self._vectors

    def word2vec(self, theme: str, n: int = 100, vectors: DataFrame | None = None) -> DataFrame:
        vectors = self.vectors() if vectors is None else vectors
        vocab, synsets = self.table("vocabulary"), self.table("synsets")
        lexicon = self.table("lexicon").where(F.col("theme") == theme)
        # the reference's error: no expanded keyword is a word of the lyrics
        kw.require_keywords(themed.word2vec_words(vectors, vocab, lexicon, synsets), theme)
        out = themed.collection_word2vec(self.table("lyrics"), vectors, vocab, lexicon, synsets, self.merged(), n)
        return out.where(F.col("theme") == theme).drop("theme")

    def classification(self, theme: str, n: int = 100, verbose: bool = False, scorer=None, word_filter=None,
                       rank_by: str = "track_id") -> DataFrame:
        """Tracks predicted as ``theme``. The classifier is fitted once, on the 500 best tracks a label of
        ``scorer`` (default: the Word2Vec collection's scores) over the words that ``word_filter`` keeps."""
        from tunelake.operators.classify import ThemeClassifier

        lyr, vocab = self.table("lyrics"), self.table("vocabulary")
        if self._classifier is None:
            if scorer is None:
                scorer = themed.embedding_scorer(self.vectors(), vocab, self.table("lexicon"), self.table("synsets"))
            chosen = scorer if not self.labels else lambda rows: scorer(rows).where(F.col("theme").isin(self.labels))
            self._classifier, _ = ThemeClassifier.fit(lyr, scorer=chosen, merged=self.merged(), word_filter=word_filter)
        return themed.collection_classifier(lyr, None, vocab, self.merged(), theme, n, verbose, self._classifier,
                                            self.table("lyric_tracks").select("track_id"), rank_by)


class Recommender:
    def __init__(self, spark: SparkSession, table_dir: str, rank: int = rc.ALS_RANK,
                 max_iter: int = rc.ALS_MAX_ITER, reg: float = rc.ALS_REG, alpha: float = rc.ALS_ALPHA):
        self.spark, self.dir = spark, table_dir.rstrip("/")
        self.params = {"rank": rank, "max_iter": max_iter, "reg": reg, "alpha": alpha}
        self._state = None

    def fit(self):
        """Interactions -> id dictionaries -> 80/20 keyed split -> ALS (once)."""
        if self._state is None:
            inter = rc.hash_split(rc.interactions(self.spark.read.parquet(table_path(self.spark, self.dir, "triplets"))),
                                  ["user_id", "song_id"])
            users, songs = rc.dictionaries(inter)
            train = rc.encode(inter.where(F.col("is_test") == 0), users, songs).persist()
            self._state = (rc.fit_als(train, **self.params), users, songs, train, inter)
        return self._state

    def get_similar_tracks(self, user_id: str, num_of_tracks: int = 10) -> DataFrame:
        model, users, songs, train, _ = self.fit()
        return rc.recommend_user(model, users, songs, train, user_id, num_of_tracks)

    def get_common_listened_tracks(self, song_id: str, num_of_tracks: int = 10,
                                   include_self: bool = False) -> DataFrame:
        model, _, songs, _, _ = self.fit()
        return rc.similar_songs(model, songs, song_id, num_of_tracks, include_self)

    def evaluate(self, k: int = 10, sample: int = 10_000) -> DataFrame:
        """Hit rate on ``sample`` held-out rows (recall, precision, reference score)."""
        model, users, songs, train, inter = self.fit()
        test = rc.sample_n(inter.where(F.col("is_test") == 1), ["user_id", "song_id"], sample)
        test_users = test.select("user_id").distinct().join(users, "user_id")
        recs = rc.decode(rc.recommend_users(model, test_users.select("user_idx"), train, k), users, songs)
        return rc.ranking_metrics(recs.select("user_id", "song_id"), test,
                                  inter.where(F.col("is_test") == 0).select("user_id"), k)
