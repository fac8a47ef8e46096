import random
import re

import pytest
from pyspark.sql import functions as F

from tunelake.llm import ngram_join as J


def shingles(text, n=3):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, percent=90):
    s = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(s[i]), str(least.get(find(i)))) for i, (d, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    out = []
    for _ in range(45):
        base = [word() for _ in range(rng.choice([1, 2, 3, 8, 9, 10, 12, 25, 40, 70, 150, 400]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                i = rng.randrange(len(w))
                rng.choice([lambda: w.__setitem__(i, word()), lambda: w.insert(i, word()), lambda: w.pop(i) if len(w) > 1 else 0,
                            lambda: w.append(word()), lambda: w.pop() if len(w) > 1 else 0])()
            out.append(" ".join(w))
    rng.shuffle(out)
    passage = " ".join(f"p{i}" for i in range(50))  # shared, not enough to link
    out += [passage + " " + " ".join(word() for _ in range(9)) for _ in range(25)]
    chain = [f"c{i}" for i in range(60)]  # each links to the next
    out += [" ".join(chain[:60 - 0] + [f"t{k}" for k in range(a)]) for a in range(0, 18, 2)]
    return out


def got(spark, docs, rows):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in J.ngram_components(docs(rows).repartition(4)).collect())


@pytest.mark.parametrize("percent", [50, 70, 80])
def test_other_thresholds_match_brute_force(spark, docs, percent):
    rows = list(enumerate(corpus(percent)))
    out = J.ngram_components(docs(rows), percent=percent)
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in out.collect()) == brute(rows, percent)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, docs, seed):
    rows = [(i * 7 + 1, t) for i, t in enumerate(corpus(seed))]
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "One TWO three é"), (5004, "one two  three é"), (5003, "One TWO three é"), (None, "one two three é")]
    assert got(spark, docs, rows) == brute(rows)


def similar_pair(rng, low, high, percent):
    """A set of the band and one of the same size or larger, as far from it as the threshold allows."""
    import numpy as np
    while True:
        x = np.unique(rng.integers(0, 2**63, rng.integers(low, high + 1), dtype=np.uint64))
        drop, add, more = 0, 0, rng.random()
        while True:
            d, a = (drop + 1, add) if rng.random() < more else (drop, add + 1)
            if 100 * (len(x) - d) < percent * (len(x) + a):
                break
            drop, add = d, a
        y = np.unique(np.concatenate([x[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)]))
        if len(y) >= len(x):
            return x, y
        if len(y) >= low:
            return y, x


@pytest.mark.parametrize("percent", [50, 70, 80, 90])
def test_every_allocation_finds_all_similar_pairs(percent):
    """Pigeonhole: similar sets share a key, whatever the weights and with any spare weight."""
    import numpy as np
    rng = np.random.default_rng(3)
    for low, high, h in J.bands(percent, 600):
        for spare in (0, 1, 3, 9):
            total = h + 1 + spare
            for two in {0, 1, total // 2}:
                if 2 * two > total:
                    continue
                for _ in range(6):
                    x, y = similar_pair(rng, low, high, percent)
                    a, b = (J.signatures(s, 5, total - 2 * two, two, spare) for s in (x, y))
                    assert len(np.intersect1d(a, b))


@pytest.mark.parametrize("percent", [50, 60, 70, 80, 90])
def test_pairs_at_the_threshold_meet_across_bands(percent):
    """The signing of whole texts: partners may lie several bands lower."""
    import pandas as pd
    rng = random.Random(percent)
    schemes = [(low, high, h, *J.allocate(low, high, h)) for low, high, h in J.bands(percent, J.LARGEST)]
    rows = []
    for i in range(150):
        n = rng.randrange(4, 300)
        x = [f"w{i}-{k}" for k in range(n + 2)]  # n 3-word shingles
        rows += [(i, x), (i, x + [f"a{k}" for k in range(n * (100 - percent) // percent)])]
    frame = pd.DataFrame([(str(i), " ".join(w), 0) for i, w in rows], columns=["id", "text", "tag"])
    out = pd.concat(J._sign(3, schemes, percent)(iter([frame])))
    for i in range(0, len(out), 2):
        a, b = out["keys"].iloc[i], out["keys"].iloc[i + 1]
        assert out["node"].iloc[i] == out["node"].iloc[i + 1] or set(a) & set(b), rows[i]


def test_allocation_follows_cost():
    """Small sets use one-deletion neighbourhoods, large ones subsets; about as many signatures as differences."""
    small, large = J.allocate(4, 5, 1), J.allocate(340, 470, 117)
    assert small[1] > 0 and large[1] == 0
    assert 118 < sum(large[:2]) < 150
    assert all(one + 2 * two == h + 1 + e for low, high, h in J.bands(80, 5000) for one, two, e in [J.allocate(low, high, h)])


def test_near_copy_group_and_one_of_each(spark, docs):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:i % 190] + [f"x{i}"] + base[i % 190 + 1:])) for i in range(400)] + [(900 + i, "equal text of a copy") for i in range(300)]
    rows += [(2000, "alone in here"), (2000, "alone in here"), (None, "no id")]
    d = docs(rows).withColumn("n", F.lit("clash")).withColumn("label", F.lit("clash"))
    out = J.one_of_each(d)
    assert out.columns == d.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["0", "2000", "900", "None"]


def test_one_of_each_decides_by_row(spark, docs):
    """Null ids are copies too, and a repeated id keeps only its row that is no copy."""
    base = [f"w{i}" for i in range(100)]
    near, other = " ".join(base[:-1] + ["x"]), " ".join(f"o{i}" for i in range(30))
    rows = [(1, " ".join(base)), (None, " ".join(base)), (None, near), (7, other), (7, near), (9, other)]
    rows += [(None, "twice without id"), (None, "Twice  without id"), (None, None), (None, ""), (3, "")]
    got = [(r["doc_id"], r["text"]) for r in J.one_of_each(docs(rows)).collect()]
    twice = [t for d, t in got if t and t.lower().startswith("twice")]
    assert len(twice) == 1
    rest = sorted(((d, t) for d, t in got if t not in twice), key=str)
    assert rest == sorted([(1, " ".join(base)), (7, other), (None, None), (None, ""), (3, "")], key=str)


def test_empty_table(spark, docs):
    assert J.ngram_components(docs([])).count() == 0
    assert J.one_of_each(docs([])).count() == 0


@pytest.mark.parametrize("crowd", [1, 4])
def test_crowded_buckets_lose_no_link(spark, docs, monkeypatch, crowd):
    monkeypatch.setattr(J, "CROWD", crowd)
    rng = random.Random(crowd)
    passage = [f"p{i}" for i in range(80)]
    texts = corpus(crowd + 10)
    for _ in range(40):  # most of the text is shared; some of them also have a near copy
        w = passage + [f"o{rng.randrange(10**6)}" for _ in range(rng.choice([8, 12, 20]))]
        texts += [" ".join(w)] + [" ".join(w[:-1])] * rng.choice([0, 1])
    rows = list(enumerate(texts))
    assert got(spark, docs, rows) == brute(rows)


def test_bits_bound_what_sets_share():
    import numpy as np
    rng = np.random.default_rng(6)
    draw = lambda n: np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    for _ in range(200):
        x = draw(rng.integers(1, 400))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < rng.random()], draw(rng.integers(0, 400)), x[:1]]))
        shared = len(np.intersect1d(x, y))
        bound = J._most_shared(len(x), J._bits(x), len(y), J._bits(y))
        assert shared <= bound <= min(len(x), len(y))
    x, y = draw(500), draw(500)
    assert J._most_shared(500, J._bits(x), 500, J._bits(y)) < 150
