import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.llm import line_dedup as D

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_docs=10, min_chars=1, keep_first=False):
    rows = [(d, t or "") for d, t in rows]
    seen = Counter(k for _, t in rows for k in {key(x) for x in t.split("\n")})
    out, told = [], {}
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        kept = []
        for x in t.split("\n"):
            k = key(x)
            if seen[k] < min_docs or not k or len(k) < min_chars:
                kept.append(x)
            elif keep_first and k not in told:
                told[k] = (d, t)
                kept.append(x)
        out.append((d, "\n".join(kept), t.count("\n") + 1, t.count("\n") + 1 - len(kept)))
    return sorted(out, key=repr)


def got(df, **kw):
    return sorted((tuple(r) for r in D.dedup_lines(df, **kw).collect()), key=repr)


def corpus(rng, n):
    pool = [f"Line {i} " + "x" * (i % 9) for i in range(60)]
    case = lambda x: rng.choice([x, x.upper(), f"\t {x}\r", x + " "])
    return [(i, "\n".join(case(rng.choice(pool[:rng.choice([3, 20, 60])])) if rng.random() < 0.7 else f"own {i} {rng.random()}"
                          for _ in range(rng.randrange(0, 12)))) for i in range(n)]


@pytest.mark.parametrize("kw", [{}, {"min_docs": 2}, {"min_docs": 3, "min_chars": 9}, {"min_docs": 4, "keep_first": True}])
def test_matches_brute_force(spark, docs, kw):
    rows = corpus(random.Random(len(kw)), 120)
    df = docs(rows).repartition(7).withColumn("mark", F.lit("x")).withColumn("k", F.lit(1))
    assert got(df, **kw) == brute(rows, **kw)


def test_edge_rows(spark, docs):
    rows = [(i, f"Head {i}\n  BOILER plate\n\n\x0bboiler PLATE\x0c\né") for i in range(9)]
    rows += [(None, "boiler plate\né"), (20, None), (21, ""), (22, "\n\n"), (22, "\n\n"), (23, "É\nİ"), (24, "y" * 2_000_000 + "\nboiler plate")]
    assert got(docs(rows)) == brute(rows)
    assert D.dedup_lines(docs([])).collect() == []
    same = [(1, "a b\nc")] * 10
    assert got(docs(same)) == brute(same) == [(1, "", 2, 2)] * 10  # every row is a document
    with pytest.raises(ValueError):
        D.dedup_lines(docs(rows), min_docs=1)


def test_more_rounds_give_the_same(spark, docs, monkeypatch):
    """One segment a round and small segments: several rounds, crowded filters, same lines."""
    rows = corpus(random.Random(9), 200)
    want = brute(rows, min_docs=3)
    seen = []
    whole = D.twice_seen
    monkeypatch.setattr(D, "ROUND_SEGMENTS", 2)
    monkeypatch.setattr(D, "KEY_BITS", 10_000)
    monkeypatch.setattr(D, "twice_seen", lambda *a: seen.append(a[2]) or whole(*a))
    assert got(docs(rows), min_docs=3) == want
    assert seen == list(range(len(seen))) and len(seen) > 2


def test_filters_never_miss_a_repeat():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 63, 60_000, dtype=np.uint64)
    f, batches = D.Filters(), [h[:30_000], h[30_000:], h[:500], rng.integers(0, 1 << 63, 40_000, dtype=np.uint64)]
    for b in batches:
        f.add(b, np.empty(0, np.uint64))
    passed = f.twice[D._probes(h)].all(axis=0)
    assert passed[:500].all() and passed[500:].mean() < 0.05
    g = D.Filters()
    g.add(np.concatenate([h[:10], h[:3]]), h[20:21])
    assert g.twice[D._probes(h[[0, 1, 2, 20]])].all() and not g.twice[D._probes(h[3:10])].all(axis=0).any()


def test_only_suspects_are_stored(spark, docs):
    rows = [(i, "\n".join(f"{i}-{j}" for j in range(50)) + "\nshared") for i in range(100)]
    table = docs(rows).select(F.col("doc_id").cast("string").alias("id"), F.lit(0).cast("long").alias("mark"), "text")
    n = D.suspects(spark, table, 1).count()
    assert 100 <= n < 200


def test_hot_line(spark, docs):
    rows = [(i, f"common\n{'z' * 40 if i % 3 else i}\n{i}") for i in range(3000)]
    assert got(docs(rows).repartition(8)) == brute(rows)
