import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.llm import periodic_runs as R


def brute_runs(w):
    """(start, length, period) of every maximal run, by trying every period."""
    found, known = [], {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if (a, i + q) in known:  # a multiple of a smaller period
                continue
            known[a, i + q] = q
            if i + q - a >= max(6, 4 * q):
                found.append((a, i + q - a, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept(w, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def digests(w):
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    told = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    one = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *one, sha(told), sha(kept(w, runs)))


def texts(rng):
    """Random words, words of few kinds, and periodic stretches with breaks in them."""
    out = []
    while len(out) < 60 + rng.randrange(200):
        kind = rng.random()
        if kind < 0.4:
            out += [rng.randrange(300) for _ in range(rng.randrange(40))]
        elif kind < 0.6:
            out += [rng.randrange(2) for _ in range(rng.randrange(40))]
        else:
            part = [rng.randrange(3 if kind < 0.8 else 100) for _ in range(rng.randrange(1, 12))]
            out += (part * rng.randrange(2, 12))[rng.randrange(len(part)):]
    return out


def test_runs_match_brute_force_over_batches():
    rng = random.Random(5)
    for _ in range(60):
        group = [texts(rng) for _ in range(rng.randrange(1, 8))]
        group += group[:2]  # copies share nonterminals
        starts = np.cumsum([0] + [len(t) for t in group[:-1]])
        got = R.runs_of(np.concatenate(group), starts).tolist()
        want = [[int(s) + a, q, int(s) + a + n] for s, t in zip(starts, group) for a, n, q in brute_runs(t)]
        assert got == sorted(want)


@pytest.mark.parametrize("w", [[0] * 6, [0] * 5, [0] * 1000, [0, 1] * 4, [0, 1] * 3, [0, 1, 2] * 500 + [0], [0, 1, 1] * 7 + [0, 1] * 9,
                               [0] * 7 + [1] * 6 + [0] * 8, list(range(50)) * 4, list(range(50)) * 3, [0, 0, 1] * 40 + [0, 0, 0, 1] * 40])
def test_shapes(w):
    got = R.runs_of(np.array(w), np.array([0])).tolist()
    assert got == [[a, q, a + n] for a, n, q in brute_runs(w)]


def test_no_run_crosses_a_text():
    assert R.runs_of(np.zeros(10, int), np.array([0, 5])).tolist() == []


def test_every_pair_is_used_up():
    """The rest of the grammar has no pair twice, and the rules spell the texts."""
    rng = random.Random(1)
    x = np.array([rng.randrange(9) for _ in range(4000)])
    g = R.Grammar(x, np.array([0, 1500]))
    pairs = [p for p, end in zip(zip(g.top.tolist(), g.top[1:].tolist()), g.top_last.tolist()) if not end]
    assert all(len(set(p)) == 1 for p in pairs if pairs.count(p) > 1)  # only overlapping itself

    def spell(s):
        return [s] if s < g.terminals else spell(g.left[s - g.terminals]) + spell(g.right[s - g.terminals])
    assert [t for s in g.top.tolist() for t in spell(s)] == x.tolist()


def test_edge_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 6), (4, "a " * 6), (None, "b c " * 8), (5, "A a " * 3), (6, "x " * 300000 + "y"),
            (7, " ".join(f"w{i % 7}" for i in range(40)))]
    df = docs(rows).withColumn("id", F.lit("x")).withColumn("runs", F.lit(1))
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in R.periodic_runs(df).collect()), key=repr)
    want = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = [(0, 300000, 1)] if d == 6 else brute_runs(w)
        want.append((d, len(w), runs, "x y" if d == 6 else kept(w, runs)))
    assert got == sorted(want, key=repr)
    assert R.periodic_runs(docs([])).collect() == []
    with pytest.raises(ValueError):
        R.periodic_runs(df, min_periods=3)


def planted_words(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in R.op13_periodic_runs(spark, sf).collect()}
    want = {d: digests(planted_words(d, re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t in docs.items()}
    assert got == want and sum(v[0] > 0 for v in want.values()) > 5


def test_every_planted_shape(spark, docs):
    rows = [(i, " ".join(f"t{j * i % 23}" for j in range(i % 97))) for i in range(400)]
    got = {r["doc_id"]: r["text"].split() for r in R.planted(docs(rows)).collect()}
    assert got == {d: planted_words(d, t.split()) for d, t in rows}
    assert R.planted(docs([(None, "a b"), (10, None)])).collect() == [(None, "a b"), (10, None)]
