"""What the pipeline's stages exchange: pairs that sizes or a few bits rule out don't travel on, members of buckets go once, texts and ids stay."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.llm import mixing, packing
from tunelake.llm import ngram_join as nj


@pytest.fixture
def no_small_sides(spark):
    """The planner knows no size, as behind checkpoints."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_unlike_sizes_take_no_turn(spark, monkeypatch):
    texts = [" ".join(f"a{i}" for i in range(n)) for n in (60, 61, 200, 201)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    sets = docs.mapInPandas(nj._tokens(3), "node long, n int, bits binary, tokens binary").localCheckpoint()
    nodes = sets.select("node")
    pairs = nodes.select(F.col("node").alias("u")).crossJoin(nodes.select(F.col("node").alias("v"))).where("u < v")
    seen, turns = [], nj._turns
    monkeypatch.setattr(nj, "_turns", lambda some, load: (seen.append(some.count()), turns(some, load))[1])
    assert nj._verify(pairs, sets, 90).count() == 2 and seen[0] == 2


def test_a_few_bits_bound_what_is_shared():
    import pandas as pd

    rng = np.random.default_rng(3)
    for n in (1, 5, 63, 64, 400, 1500):
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        y = np.unique(np.r_[x[: n // 2], rng.integers(0, 1 << 63, n, dtype=np.uint64)])
        rows = pd.DataFrame({"node": [1, 2], "n": [len(x), len(y)], "bits": [nj._bits(x), nj._bits(y)]})
        (out,) = nj._briefly(iter([rows]))
        bx, by = out["bits"]
        assert len(bx) <= max(8, len(nj._bits(x)) // 8)
        assert len(np.intersect1d(x, y)) <= nj._most_shared(len(x), bx, len(y), by)
    far = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64)), np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    (out,) = nj._briefly(iter([pd.DataFrame({"node": [1, 2], "n": [400, 400], "bits": [nj._bits(t) for t in far]})]))
    assert nj._most_shared(400, out["bits"][0], 400, out["bits"][1]) < 320


def test_members_are_exchanged_once(spark, no_small_sides):
    rows = [(k, 10 * k + i, 10 * k + i // 2) for k in range(4) for i in range(4)] + [(9, 1, 1), (9, 2, 1)]
    b = spark.createDataFrame(rows, "key long, node long, label long")
    out = nj._mixed(b)
    assert {(r.key, r.node) for r in out.collect()} == {(k, 10 * k + i) for k in range(4) for i in range(4)}
    assert all(r.members == 4 and r.main == 10 * r.key + 1 for r in out.collect())
    assert plan(out).split("Initial Plan")[0].count("ENSURE_REQUIREMENTS") == 0


def test_sets_are_kept_once_a_node(spark, tmp_path):
    from tunelake.session import scratch_path

    at = scratch_path(spark, "sets")
    spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "node long, n int").write.parquet(at)
    sets, to = nj._once_each(spark.read.parquet(at), at)
    assert sorted(tuple(r) for r in sets.collect()) == [(1, 2), (3, 4)] and to != at
    assert nj._once_each(sets, to)[1] == to


def test_texts_and_ids_stay_where_they_are(spark, docs, no_small_sides):
    d = docs([(i, f"one two three {i}", f"s{i % 3}") for i in range(30)])
    assert "SortMergeJoin" not in plan(mixing.mix_documents(d))
    assert "SortMergeJoin" not in plan(packing.pack(d, keep_ids=True))
