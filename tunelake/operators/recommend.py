"""Implicit-feedback recommendations: interactions, id dictionaries, splits,
ALS, per-user and per-song top-k, a popularity baseline and ranking metrics.

Scale notes:
* interactions are summed per (user, song) with a map-side partial aggregate;
* id dictionaries come from ``ids.dense_ids`` (no single-partition window);
* splits and samples are keyed hashes, stable under re-partitioning and retries;
* candidate generation per user is linear in that user's history
  (k + |seen| candidates), spread over tasks in chunks, so a user holding a
  third of all plays is split across many tasks; seen items are removed with
  an anti join before the per-user top-k (WindowGroupLimit).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.operators import als
from tunelake.operators.ids import dense_ids, sequential_index
from tunelake.operators.vectors import vector_topk

# The reference's model settings, seed and held-out share.
ALS_RANK, ALS_MAX_ITER, ALS_REG, ALS_ALPHA = 200, 20, 0.05, 50.0
BLOCK_ROWS = 150_000  # interactions of an ALS block: at most so many rows of the other side's factors, 120 MB
SEED = 42
TEST_FRACTION = 0.2
CANDIDATE_CHUNK = 4096


def played(triplets: DataFrame) -> DataFrame:
    """Listening records with a positive count."""
    return triplets.where(F.col("play_count") > 0)


def interactions(triplets: DataFrame) -> DataFrame:
    """(user_id, song_id, play_count): positive plays summed per pair."""
    return played(triplets).groupBy("user_id", "song_id").agg(
        F.sum("play_count").cast("bigint").alias("play_count"))


def distinct_counts(inter: DataFrame) -> DataFrame:
    """(n_users, n_songs) in one pass (two partial distinct aggregates)."""
    return inter.agg(F.countDistinct("user_id").cast("bigint").alias("n_users"),
                     F.countDistinct("song_id").cast("bigint").alias("n_songs"))


def split_hash(key_cols: list[str], seed: int = SEED):
    """First 8 hex digits of md5('seed:' + key): a stable pseudo-random value."""
    parts = [F.lit(f"{seed}:")]
    for i, c in enumerate(key_cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(F.col(c).cast("string"))
    return F.substring(F.md5(F.concat(*parts)), 1, 8)


def hash_split(df: DataFrame, key_cols: list[str], test_fraction: float = TEST_FRACTION,
               seed: int = SEED) -> DataFrame:
    """``df`` + ``is_test`` (1 for about ``test_fraction`` of keys), decided per key."""
    threshold = format(int(test_fraction * 16 ** 8 + 0.5), "08x")
    return df.withColumn("is_test", F.when(split_hash(key_cols, seed) < threshold, 1).otherwise(0))


def exact_split(keys: DataFrame, key: str, test_fraction: float = TEST_FRACTION, seed: int = SEED) -> DataFrame:
    """(key, part): exactly ceil(fraction * n) keys in 'test', chosen by hash order."""
    k = keys.select(key).distinct().withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
    ranked = sequential_index(k, [F.asc("_h"), F.asc(key)], "_r", start=1)
    n = ranked.count()
    cut = math.ceil(test_fraction * n)
    return ranked.select(key, F.when(F.col("_r") <= cut, "test").otherwise("train").alias("part"))


def sample_n(df: DataFrame, key_cols: list[str], n: int, seed: int = SEED) -> DataFrame:
    """``n`` rows (all when fewer) chosen by keyed hash: a top-n, no full sort."""
    return df.orderBy(split_hash(key_cols, seed), *key_cols).limit(n)


# ------------------------------------------------------------------ id dictionaries

def encode(inter: DataFrame, users: DataFrame, songs: DataFrame) -> DataFrame:
    """(user_idx, song_idx, play_count)."""
    return inter.join(users, "user_id").join(songs, "song_id").select("user_idx", "song_idx", "play_count")


def decode(coded: DataFrame, users: DataFrame, songs: DataFrame) -> DataFrame:
    return coded.join(users, "user_idx").join(songs, "song_idx").drop("user_idx", "song_idx")


def dictionaries(inter: DataFrame) -> tuple[DataFrame, DataFrame]:
    return dense_ids(inter, "user_id", "user_idx"), dense_ids(inter, "song_id", "song_idx")


# ------------------------------------------------------------------ ALS

def fit_als(coded: DataFrame, rank: int = ALS_RANK, max_iter: int = ALS_MAX_ITER, reg: float = ALS_REG,
            alpha: float = ALS_ALPHA, seed: int = SEED, num_blocks: int | None = None):
    """Implicit-feedback ALS on (user_idx, song_idx, play_count): ``als.fit``, solved by blocks.

    User and item factors live in blocks, and each half step shuffles only the
    factors the other side needs.
    """
    # blocks follow the data, not the cores: the same input gives the same factors on any cluster
    return als.fit(coded, rank, max_iter, reg, alpha, seed, num_blocks or max(10, -(-coded.count() // BLOCK_ROWS)))


def recommend_user(model, users: DataFrame, songs: DataFrame, coded_train: DataFrame, user_id: str,
                   n: int = 10) -> DataFrame:
    """(song_id, likelihood): top ``n`` songs by dot product, already played excluded."""
    u = users.where(F.col("user_id") == user_id).select("user_idx").first()
    if u is None:
        raise ValueError(f"User {user_id!r} not found in the data")
    uidx = u["user_idx"]
    q = model.userFactors.where(F.col("id") == uidx).select(F.col("id").alias("qid"), "features")
    seen = coded_train.where(F.col("user_idx") == uidx).select(F.col("song_idx").alias("id"))
    corpus = model.itemFactors.join(seen, "id", "left_anti")
    top = vector_topk(q, "qid", "features", corpus, "id", "features", n, "dot", exclude_self=False)
    return top.join(songs, top["id"] == songs["song_idx"]).select(
        "song_id", F.col("score").alias("likelihood"), "rank").orderBy("rank")


def similar_songs(model, songs: DataFrame, song_id: str, n: int = 10, include_self: bool = False) -> DataFrame:
    """(song_id, likelihood): the ``n`` songs with the most similar factors (cosine)."""
    s = songs.where(F.col("song_id") == song_id).select("song_idx").first()
    if s is None:
        raise ValueError(f"Song {song_id!r} not found in the data")
    q = model.itemFactors.where(F.col("id") == s["song_idx"]).select(F.col("id").alias("qid"), "features")
    top = vector_topk(q, "qid", "features", model.itemFactors, "id", "features", n, "cosine",
                      exclude_self=not include_self)
    return top.join(songs, top["id"] == songs["song_idx"]).select(
        "song_id", F.col("score").alias("likelihood"), "rank").orderBy("rank")


def recommend_users(model, user_idx: DataFrame, coded_train: DataFrame, k: int = 10) -> DataFrame:
    """(user_idx, song_idx, score, rank): top ``k`` unseen songs for many users, by dot product.

    Users and songs meet in blocks (``vector_topk``); a user's seen songs are masked
    before the partial top-k, whatever the length of the history. Users without
    factors get no rows.
    """
    users = user_idx.select("user_idx").distinct()
    q = model.userFactors.withColumnRenamed("id", "user_idx").join(users, "user_idx", "left_semi")
    seen = coded_train.select("user_idx", F.col("song_idx").alias("id"))
    top = vector_topk(q, "user_idx", "features", model.itemFactors, "id", "features", k, "dot",
                      exclude_self=False, exclude=seen)
    return top.withColumnRenamed("id", "song_idx")


# ------------------------------------------------------------------ popularity baseline

def popularity_recommend(train: DataFrame, k: int = 10, users: DataFrame | None = None) -> DataFrame:
    """(user_id, song_id, rn): each user's ``k`` most played songs (by total
    train plays, then song_id) that the user has not played in ``train``.

    Exact without pairing every user with every song: user u needs at most the
    first k + |seen_u| popularity ranks. Those ranks are generated in chunks of
    CANDIDATE_CHUNK (the chunks are re-partitioned so one heavy user's range is
    spread over many tasks), joined to songs by rank, and the seen ones removed.
    """
    pop = train.groupBy("song_id").agg(F.sum("play_count").alias("pop"))
    ranked = sequential_index(pop, [F.desc("pop"), F.asc("song_id")], "r", start=1)
    seen_n = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("_seen"))
    if users is not None:
        seen_n = users.select("user_id").distinct().join(seen_n, "user_id", "left").fillna(0, ["_seen"])
    # ranks past the catalogue simply find no song in the join below
    need = (F.col("_seen") + F.lit(k)).cast("bigint")
    chunks = seen_n.select("user_id", need.alias("_need")).where(F.col("_need") > 0).select(
        "user_id", "_need",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_need") - 1) / CANDIDATE_CHUNK)
                             .cast("bigint"))).alias("_chunk"))
    chunks = chunks.repartition("user_id", "_chunk")
    lo = F.col("_chunk") * CANDIDATE_CHUNK + 1
    hi = F.least((F.col("_chunk") + 1) * CANDIDATE_CHUNK, F.col("_need"))
    cand = chunks.select("user_id", F.explode(F.sequence(lo, hi)).alias("r"))
    cand = cand.join(ranked.select("r", "song_id"), "r")
    cand = cand.join(train.select("user_id", "song_id"), ["user_id", "song_id"], "left_anti")
    w = Window.partitionBy("user_id").orderBy(F.asc("r"))
    top = cand.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    return top.select("user_id", "song_id", F.col("rn").cast("bigint").alias("rn"))


# ------------------------------------------------------------------ metrics

def ranking_metrics(recs: DataFrame, test: DataFrame, train_users: DataFrame, k: int = 10) -> DataFrame:
    """hits, total, users, recall_at_k, precision_at_k, reference_score.

    Only test rows of users present in training are scored. ``reference_score``
    is the reference's printed number: hits * 3 / total * 100.
    """
    t = test.select("user_id", "song_id").join(train_users.select("user_id").distinct(), "user_id", "left_semi")
    r = recs.select("user_id", "song_id", F.lit(1).alias("_hit"))
    j = t.join(r, ["user_id", "song_id"], "left")
    agg = j.agg(F.count("_hit").cast("bigint").alias("hits"), F.count(F.lit(1)).cast("bigint").alias("total"),
                F.countDistinct("user_id").cast("bigint").alias("users"))
    return agg.select(
        "hits", "total", "users",
        F.round(F.col("hits") / F.col("total"), 6).alias("recall_at_k"),
        F.round(F.col("hits") / (F.col("users") * F.lit(k)), 6).alias("precision_at_k"),
        F.round(F.col("hits") * F.lit(3.0) / F.col("total") * F.lit(100.0), 6).alias("reference_score"))
