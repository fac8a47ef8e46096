"""Signatures are exchanged by parts of their keys, and pairs' sets by parts of what the sets take, with the same links."""

from pyspark.sql import functions as F

from tunelake.llm import ngram_join as nj


def texts():
    groups = [" ".join(f"g{g}_{i}" for i in range(40)) for g in range(6)]
    return [(10 * g + k, f"{t} x{g}_{k}") for g, t in enumerate(groups) for k in range(5)] + [(100 + k, " ".join(f"y{k}_{i}" for i in range(40))) for k in range(6)]


def test_keys_take_turns_and_lose_no_link(spark, monkeypatch):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    calls, release = [], nj.release
    monkeypatch.setattr(nj, "TURN_KEYS", 20)
    monkeypatch.setattr(nj, "release", lambda s: (calls.append(1), release(s)))
    got = {(r.doc_id, r.component_id) for r in nj.ngram_components(docs, 3, 90).collect()}
    assert got == {(d, d // 10 * 10 if d < 100 else d) for d, _ in texts()}
    assert len(calls) > nj.KEY_TURNS


def test_a_turn_carries_a_part_of_the_sets(spark, monkeypatch):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    sets = docs.mapInPandas(nj._tokens(3), "node long, n int, bits binary, tokens binary").localCheckpoint()
    nodes = [r.node for r in sets.select("node").collect()]
    pairs = spark.createDataFrame([(u, v) for u in nodes for v in nodes if u < v], "u long, v long")
    loads, turns = [], nj._turns
    monkeypatch.setattr(nj, "TURN_BYTES", 1)
    monkeypatch.setattr(nj, "_turns", lambda some, load: (loads.append(load), turns(some, load))[1])
    assert nj._verify(pairs, sets, 90).count() == 6 * 10
    n, near = len(nodes), 6 * 10
    assert loads[0] >= nj.SET_SHARE * n * (n - 1) / 2 / n / 8 * 0.99 and loads[1] >= nj.SET_SHARE * near / n * 0.9
    side = nj._sets_of(sets.select("node", "tokens"), F.col("u"), pairs.where(F.col("u") == min(nodes)))
    assert [r.node for r in side.collect()] == [min(nodes)]
