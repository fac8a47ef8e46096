"""What candidate pairs carry is sent in turns bounded by the sets, with the same links."""

from pyspark.sql import functions as F

from tunelake.llm import ngram_join as nj


def test_many_pairs_take_turns_and_lose_no_link(spark, monkeypatch):
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join([*base[:-1], f"x{k}"]) for k in range(24)] + [" ".join(f"y{k}_{i}" for i in range(40)) for k in range(4)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    sets = docs.mapInPandas(nj._tokens(3), "node long, n int, bits binary, tokens binary").localCheckpoint()
    nodes = sets.select("node")
    pairs = nodes.select(F.col("node").alias("u")).crossJoin(nodes.select(F.col("node").alias("v"))).where("u < v")
    seen, turns = [], nj._turns

    def told(some, load):
        for now in turns(some, load):
            seen.append(now.count())
            yield now

    monkeypatch.setattr(nj, "_turns", told)
    got = {(r.u, r.v) for r in nj._verify(pairs, sets, 80).collect()}
    assert len(got) == 24 * 23 // 2 and len(seen) > 2 and max(seen) < pairs.count()
