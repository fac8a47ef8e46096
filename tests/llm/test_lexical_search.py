import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.llm import lexical_search as S

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def found(t):
    return re.findall(TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, k=20):
    bags = [(d, found(t)) for d, t in rows]
    n = sum(bool(b) for _, b in bags)
    length = sum(len(b) for _, b in bags)
    df = Counter(t for _, b in bags for t in set(b))
    out = []
    for item, text in set(items):
        scores = []
        for d, b in bags:
            tf, s = Counter(b), 0
            for t in found(text):
                if tf[t]:
                    m = 100 - 25 + (25 * len(b) * n) // length
                    s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def corpus(rng, n, words=400):
    pool = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rng.choices(pool, weights, k=rng.randrange(0, 80)))) for i in range(n)]


def got(spark, docs, rows, items, k=20):
    df = docs(rows).repartition(5).withColumn("n", F.lit("x")).withColumn("terms", F.lit(1))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(0))
    return sorted((tuple(r) for r in S.search(df, asked, k).collect()), key=repr)


@pytest.mark.parametrize("k", [1, 5, 20])
def test_matches_brute_force(spark, docs, monkeypatch, k):
    rng = random.Random(k)
    rows = corpus(rng, 400)
    items = [(i, t + " W1 w1 nowhere") for i, t in corpus(rng, 25)]
    monkeypatch.setattr(S, "SHARD_DOCS", 37)
    assert got(spark, docs, rows, items, k) == brute(rows, items, k)


def test_blocks_of_items_give_the_same(spark, docs, monkeypatch):
    rng = random.Random(2)
    rows, items = corpus(rng, 60), corpus(rng, 9)
    monkeypatch.setattr(S, "ITEM_BLOCK", 4)
    assert got(spark, docs, rows, items) == brute(rows, items)


def test_edge_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, " .,!"), (4, "Éa éA x-y_z 9"), (5, "éa"), (5, "éa"), (None, "x"), (6, "x"), (7, "x"), (8, "big " * 400_000 + "x"), (9, "q`{z}")]
    items = [(1, "X x z"), (1, "X x z"), (2, None), (3, "!?"), (4, "Éa éa éA z q 9 y"), (None, "x"), (5, "missing")]
    assert got(spark, docs, rows, items) == brute(rows, items)
    assert got(spark, docs, [], items) == []
    assert got(spark, docs, rows, []) == []
    with pytest.raises(ValueError):
        S.search(docs(rows), docs(rows), 0)


def test_ties_go_by_doc_id(spark, docs):
    rows = [(i, "same words here" if i % 3 else f"other {i}") for i in range(200)]
    assert got(spark, docs, rows, [(1, "same here")]) == brute(rows, [(1, "same here")])


def test_pair_bounds_skip_more_than_term_bounds():
    """The same answers with fewer postings than with every term a unit of its own, and than without bounds."""
    rng = random.Random(8)
    docs = [Counter(rng.choices(range(300), [1 / (i + 1) for i in range(300)], k=60)) for _ in range(3000)]
    n = np.array([sum(c.values()) for c in docs])
    pack = lambda x: np.fromiter(x, np.int32).tobytes()
    df = Counter(t for c in docs for t in c)
    weight = np.array([math.floor(1000 * math.log((2 * 3000 + 2) / (2 * df[t] + 1))) for t in range(300)], np.int64)
    shard = S.Shard(n, [pack(c) for c in docs], [pack(c.values()) for c in docs], weight, 3000, int(n.sum()))
    pairs = singles = every = 0
    for _ in range(30):
        counts = Counter(rng.choices(range(300), k=12))
        paired, alone = S.Query(counts, weight), S.Query(counts, weight)
        alone.pairs = []
        shard.prepare(set(paired.pairs))
        for pair in paired.pairs:
            sums = [sum(c * dict(zip(*map(list, shard.postings(t)))).get(d, 0) for t, c in pair) for d in range(0, 3000, 7)]
            assert shard.bounds[pair] >= max(sums)
        most = shard.rest(paired)
        for i in range(len(most)):
            sums = np.zeros(3000, np.int64)
            for t, c in paired.terms[i:]:
                at, impact = shard.postings(t)
                sums[at] += c * impact
            assert sums.max() <= most[i] <= shard.rest(alone)[i]
        a, b = shard.search(paired, 10, 1), shard.search(alone, 10, 1)
        top = lambda r: sorted(zip((-r[1]).tolist(), r[0].tolist()))[:10]
        assert top(a) == top(b)
        pairs, singles = pairs + a[2], singles + b[2]
        every += sum(len(shard.postings(t)[0]) for t in counts)
    assert pairs < singles < every
