"""Hot keys: one user with a third of all plays, one song with a third of all
plays, one track with many genre rows. Joins are forced to sort-merge and AQE
skew splitting to trigger; results must equal brute force."""

import random
from collections import Counter, defaultdict

import pytest

from tunelake.operators import merge as mg
from tunelake.operators import recommend as rc
from tunelake.operators import toptracks as tt

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def data():
    rnd = random.Random(9)
    trip = [(f"u{rnd.randint(0, 200)}", f"S{rnd.randint(0, 300)}", rnd.randint(1, 5)) for _ in range(2000)]
    trip += [("hot_user", f"S{rnd.randint(0, 300)}", 1) for _ in range(700)]
    trip += [(f"u{rnd.randint(0, 200)}", "S0", 2) for _ in range(700)]
    tracks = [(f"T{s}", f"S{s}", f"a{s % 7}", f"t{s}") for s in range(0, 320, 2)]
    genres = [(f"T{s}", ["Rock", "Pop", "Jazz"][s % 3], "") for s in range(0, 320, 4)]
    genres += [("T0", f"G{i}", "x") for i in range(60)]  # one track, many genre rows
    return trip, tracks, genres


def test_merged_under_skew(skewed):
    trip, tracks, genres = data()
    t = skewed.createDataFrame(trip, "user_id string, song_id string, play_count bigint")
    k = skewed.createDataFrame(tracks, "track_id string, song_id string, artist_name string, title string")
    g = skewed.createDataFrame(genres, "track_id string, majority_genre string, minority_genre string")
    got = Counter((r.track_id, r.majority_genre, r.play_count) for r in mg.build_merged(t, k, g).collect())
    plays = defaultdict(int)
    for _, s, c in trip:
        plays[s] += c
    by_track = defaultdict(list)
    for tid, maj, _ in genres:
        by_track[tid].append(maj)
    want = Counter()
    for tid, sid, _, _ in tracks:
        for maj in by_track.get(tid, [""]):
            want[(tid, maj, plays.get(sid, 0))] += 1
    assert got == want
    top = tt.top_tracks_per_genre(mg.build_merged(t, k, g), 3).collect()
    assert sum(1 for r in top if r.majority_genre == "Rock") == 3


def test_popularity_and_ids_under_skew(skewed):
    trip, _, _ = data()
    inter = rc.interactions(skewed.createDataFrame(trip, "user_id string, song_id string, play_count bigint"))
    users, songs = rc.dictionaries(inter)
    assert sorted(r.user_idx for r in users.collect()) == list(range(users.count()))
    back = rc.decode(rc.encode(inter, users, songs), users, songs)
    assert back.count() == inter.count()
    recs = rc.popularity_recommend(inter, 5).collect()
    pop = defaultdict(int)
    seen = defaultdict(set)
    for u, s, c in trip:
        pop[s] += c
        seen[u].add(s)
    order = sorted(pop, key=lambda s: (-pop[s], s))
    got = defaultdict(list)
    for r in recs:
        got[r.user_id].append((r.rn, r.song_id))
    for u in seen:
        assert [s for _, s in sorted(got[u])] == [s for s in order if s not in seen[u]][:5]
