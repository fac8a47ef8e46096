"""Recommendations: ids, splits, popularity baseline, ALS properties."""

import pytest
from pyspark.sql import functions as F

from tunelake.operators import recommend as rc
from tunelake.operators.ids import dense_ids


def test_dense_ids_are_a_key_ordered_bijection(spark):
    df = spark.range(0, 500).select(F.format_string("k%04d", (F.col("id") * 7919) % 500).alias("k"))
    ids = dense_ids(df.repartition(7), "k", "i").collect()
    assert sorted(r.i for r in ids) == list(range(500))
    assert all(r.k == f"k{r.i:04d}" for r in ids)


def test_hash_split_stable_under_repartition(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("u"), F.lit("s").alias("s"))
    a = {(r.u, r.is_test) for r in rc.hash_split(df, ["u", "s"]).collect()}
    b = {(r.u, r.is_test) for r in rc.hash_split(df.repartition(13), ["u", "s"]).collect()}
    assert a == b
    share = sum(t for _, t in a) / len(a)
    assert 0.15 < share < 0.25


def test_exact_split_size(spark):
    df = spark.range(101).select(F.col("id").cast("string").alias("track_id"))
    parts = [r.part for r in rc.exact_split(df, "track_id").collect()]
    assert parts.count("test") == 21 and len(parts) == 101


def test_popularity_recommend_matches_brute_force(spark):
    import random

    rnd = random.Random(5)
    rows = {(f"u{rnd.randint(0, 30)}", f"s{rnd.randint(0, 60)}") for _ in range(600)}
    rows |= {("heavy", f"s{i}") for i in range(55)}  # one user has played almost everything
    data = [(u, s, rnd.randint(1, 9)) for u, s in sorted(rows)]
    train = spark.createDataFrame(data, "user_id string, song_id string, play_count bigint")
    got = {}
    for r in rc.popularity_recommend(train, 5).collect():
        got.setdefault(r.user_id, []).append((r.rn, r.song_id))
    pop = {}
    for _, s, c in data:
        pop[s] = pop.get(s, 0) + c
    order = sorted(pop, key=lambda s: (-pop[s], s))
    seen = {}
    for u, s, _ in data:
        seen.setdefault(u, set()).add(s)
    for u, ss in seen.items():
        want = [s for s in order if s not in ss][:5]
        assert [s for _, s in sorted(got.get(u, []))] == want


def test_two_communities(spark):
    """Users 1-5 play songs A*, users 6-10 songs B*; held-out own-side songs rank first."""
    rows = []
    for u in range(1, 11):
        side = "A" if u <= 5 else "B"
        for s in range(6):
            if s != u % 6:  # each user misses one song of their side
                rows.append((f"u{u}", f"{side}{s}", 5))
    inter = spark.createDataFrame(rows, "user_id string, song_id string, play_count bigint")
    users, songs = rc.dictionaries(inter)
    coded = rc.encode(inter, users, songs).cache()
    model = rc.fit_als(coded, rank=4, max_iter=10, reg=0.01, alpha=10.0)
    recs = rc.recommend_user(model, users, songs, coded, "u1", 3).collect()
    played = {s for u, s, _ in rows if u == "u1"}
    assert not ({r.song_id for r in recs} & played)
    assert recs[0].song_id == "A1"  # the one own-side song u1 has not played
    batch = rc.recommend_users(model, users.select("user_idx"), coded, 2)
    back = rc.decode(batch, users, songs).collect()
    seen = {(u, s) for u, s, _ in rows}
    assert back and not any((r.user_id, r.song_id) in seen for r in back)
    assert all((r.song_id[0] == "A") == (int(r.user_id[1:]) <= 5) for r in back if r.rank == 1)
    sim = rc.similar_songs(model, songs, "A1", 3).collect()
    assert "A1" not in {r.song_id for r in sim}
    with pytest.raises(ValueError):
        rc.recommend_user(model, users, songs, coded, "nobody", 3)
    with pytest.raises(ValueError):
        rc.similar_songs(model, songs, "nothing", 3)


def test_ranking_metrics(spark):
    recs = spark.createDataFrame([("u1", "a"), ("u1", "b"), ("u2", "c")], "user_id string, song_id string")
    test = spark.createDataFrame([("u1", "a"), ("u1", "z"), ("u2", "c"), ("u3", "c")],
                                 "user_id string, song_id string")
    train = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    r = rc.ranking_metrics(recs, test, train, k=2).first()
    assert (r.hits, r.total, r.users) == (2, 3, 2)
    assert r.recall_at_k == round(2 / 3, 6) and r.reference_score == 200.0


def test_sample_n(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"))
    a = [r.k for r in rc.sample_n(df, ["k"], 10).collect()]
    b = [r.k for r in rc.sample_n(df.repartition(5), ["k"], 10).collect()]
    assert a == b and len(a) == 10
    assert rc.sample_n(df, ["k"], 500).count() == 50


@pytest.mark.parametrize("blocks", [(500, 10_000), (7, 9)])
def test_recommend_users_matches_brute_force(spark, monkeypatch, blocks):
    """Light and heavy users equal brute force over the factors with seen songs
    removed, in one block pair and in many."""
    from tunelake.operators import vectors

    monkeypatch.setattr(vectors, "Q_BLOCK", blocks[0])
    monkeypatch.setattr(vectors, "C_BLOCK", blocks[1])
    import random

    import numpy as np

    rnd = random.Random(2)
    rows = set()
    for u in range(30):
        n = 2 if u % 3 else 15  # every third user is heavy for a 40-song catalogue
        for s in rnd.sample(range(40), n):
            rows.add((u, s))
    coded = spark.createDataFrame([(u, s, rnd.randint(1, 5)) for u, s in sorted(rows)],
                                  "user_idx int, song_idx int, play_count bigint").cache()
    model = rc.fit_als(coded, rank=3, max_iter=3, reg=0.1, alpha=5.0)
    got = {}
    for r in rc.recommend_users(model, coded.select("user_idx"), coded, 3).collect():
        got.setdefault(r.user_idx, set()).add(r.song_idx)
    uf = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    itf = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    for u in uf:
        seen = {s for uu, s in rows if uu == u}
        scores = sorted(((float(uf[u] @ itf[i]), i) for i in itf if i not in seen), key=lambda t: (-t[0], t[1]))
        assert got[u] == {i for _, i in scores[:3]}, u


def test_registered_als_queries_fit_the_reference_model(spark, monkeypatch):
    """Rank, iterations, regularisation and alpha are the operator's defaults."""
    from tunelake.plans import catalog

    seen = {}
    monkeypatch.setattr(catalog, "_tt", lambda s, d: s.createDataFrame(
        [("u", "s", 1, 0), ("v", "s", 2, 0)], "user_id string, song_id string, play_count long, is_test int"))
    monkeypatch.setattr(rc, "fit_als", lambda coded, *a, **k: seen.update(a=a, k=k))
    catalog._fit_als(spark, "unused")
    assert seen == {"a": (), "k": {}} and (rc.ALS_RANK, rc.ALS_MAX_ITER) == (200, 20)
