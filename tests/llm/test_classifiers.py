import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.llm import labelled as L
from tunelake.llm import line_crf as C
from tunelake.llm import toxicity as X

LAB = "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.1"


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    length = np.array([1, 2, 4])
    nodes, edges = rng.normal(size=(3, 4, 2)), rng.normal(size=(2, 2))
    node, pair, log_z = C.marginals(nodes, edges, length)
    pairs = np.zeros((2, 2))
    for b, n in enumerate(length):
        paths = {p: sum(nodes[b, i, s] for i, s in enumerate(p)) + sum(edges[s, t] for s, t in zip(p, p[1:], strict=False))
                 for p in itertools.product((0, 1), repeat=int(n))}
        z = sum(map(np.exp, paths.values()))
        assert abs(np.log(z) - log_z[b]) < 1e-9
        for i in range(n):
            assert abs(sum(np.exp(v) for p, v in paths.items() if p[i]) / z - node[b, i, 1]) < 1e-9
        assert not node[b, n:].any()
        for p, v in paths.items():
            for s, t in zip(p, p[1:], strict=False):
                pairs[s, t] += np.exp(v) / z
    assert np.allclose(pairs, pair)


def planted(n=300):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abdegilnorst") for _ in range(rng.randrange(2, 9)))
    rows, labels = [], []
    for i in range(n):
        good, toxic = rng.random() < 0.6, rng.random() < 0.4
        lines = [[word() for _ in range(12)] for _ in range(rng.randrange(1, 8))]
        if toxic:
            lines[0][3] = rng.choice(["stupid", "idiot", "stupidd", "idiiot"])
        text = "\n".join(" ".join(x if good else [w.upper() + "!!" for w in x]) for x in lines)
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


def bucket(gram):
    """The hash of one n-gram, letter by letter."""
    mask, h = (1 << 64) - 1, 0
    for c in gram:
        h = (h * 0x100000001B3 + ord(c)) & mask
    h = ((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 + len(gram)) & mask
    return (h >> 40) % X.BUCKETS


@pytest.mark.parametrize("passage", [2, None])
def test_toxicity_scores_match_brute_force(passage):
    """Words as means of their n-grams, passages as means of words, the smooth maximum, the prior."""
    rng, r = np.random.default_rng(4), random.Random(4)
    m = {"table": rng.normal(size=X.BUCKETS).astype(np.float32), "bias": -0.7, "prior": 0.4, "share": 0.1, "passage": passage}
    texts = [" ".join("".join(r.choice("abÀß𝔸1-") for _ in range(r.randrange(1, 7))) for _ in range(r.randrange(12))) for _ in range(60)]
    texts += ["", " \n ", "a", "x " * 500]
    for text, got in zip(texts, X.Scorer(m)(texts), strict=True):
        means = []
        for w in text.lower().split():
            w = f"<{w}>"
            grams = [w[i:i + n] for n in X.GRAMS for i in range(len(w) - n + 1)]
            means.append(sum(float(m["table"][bucket(g)]) for g in grams) / len(grams))
        size = passage or max(len(means), 1)
        parts = [means[i:i + size] for i in range(0, len(means), size)]
        z = [sum(p) / len(p) * X.SCALE - 0.7 for p in parts] or [-0.7]
        doc = np.log(np.mean([np.exp(X.SHARP * v) for v in z])) / X.SHARP
        assert abs(got - 1 / (1 + np.exp(-(doc + 0.4)))) < 1e-5


def test_quality_scores_match_enumeration():
    """Length-weighted marginals of a document by the sum over all labelings of its lines."""
    rng = np.random.default_rng(2)
    m = {"w": rng.normal(size=3 * C.N_OWN + 1), "e": rng.normal(size=(2, 2))}
    for text in ("one line", "GOOD\nbad line here!\n\nx", "a\n" * 7, ""):
        lines = text.split("\n")
        s = C.line_features(lines) @ m["w"]
        weigh = {p: np.exp(sum(s[i] / 2 if y else -s[i] / 2 for i, y in enumerate(p)) + sum(m["e"][a, b] for a, b in zip(p, p[1:])))
                 for p in itertools.product((0, 1), repeat=len(lines))}
        size = np.array([max(len(x), 1) for x in lines])
        good = [sum(v for p, v in weigh.items() if p[i]) / sum(weigh.values()) for i in range(len(lines))]
        assert abs(C.score([text], m)[0] - size @ good / size.sum()) < 1e-9


def test_marginals_are_the_gradient_of_the_log_partition():
    """What training uses: node and edge marginals against finite differences."""
    rng = np.random.default_rng(5)
    length, nodes, edges = np.array([3, 1, 5]), rng.normal(size=(3, 5, 2)), rng.normal(size=(2, 2))
    node, pair, _ = C.marginals(nodes, edges, length)
    total = lambda: C.marginals(nodes, edges, length)[2].sum()
    for array, want in ((nodes, node), (edges, pair)):
        for at in np.ndindex(array.shape):
            kept, sides = array[at], []
            for step in (1e-5, -1e-5):
                array[at] = kept + step
                sides.append(total())
            array[at] = kept
            assert abs((sides[0] - sides[1]) / 2e-5 - want[at]) < 1e-6


def test_long_documents_of_one_class_are_trained_on():
    """Over 60,000 lines, the longer documents all of one class."""
    bad, good = "\n".join(["BUY NOW!!! $$$"] * 40), "\n".join(["a plain line of quiet words to read."] * 60)
    m = C.train([bad] * 1_500 + [good] * 60, [0] * 1_500 + [1] * 60, epochs=3)
    low, high = C.score([bad, good], m)
    assert low < 0.3 and high > 0.7


def test_planted_classes_edges_and_reruns(spark, docs):
    rows, labels = planted()
    extra = [(1000, ""), (1001, None), (1002, "\n" * 5000), (1003, "stupidity " * 30000), (1004, "an sturdy idiotic"), (None, "x"), (5, "again")]
    d = docs(rows + extra).withColumn("score", F.lit("clash")).withColumn("id", F.lit("clash"))
    lab = spark.createDataFrame(labels + [(2, None, None), (None, 1, 1), (9999, 1, 1)], LAB)
    train = L.fold(F.col("doc_id"), 5) != 0
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    for mod, col in ((C, 1), (X, 2)):
        m = mod.fit(d, lab, train)
        got = mod.score_documents(d, m).collect()
        assert len(got) == len(rows) + len(extra)
        assert all(0 <= r["score"] <= 1 for r in got)
        s = {r["doc_id"]: r["score"] for r in got}
        right = [(s[i] >= 0.3) == bool(y[col]) for i, *_ in rows for y in [labels[i]] if i in held and i != 5]
        assert np.mean(right) > 0.9, mod
        again = {r["doc_id"]: r["score"] for r in mod.score_documents(d.repartition(3), m).collect()}
        assert all(abs(again[k] - s[k]) < 1e-9 for k in s if k not in (5, None))
    assert s[1003] > 0.3  # one long text, misspelt word


@pytest.mark.parametrize("mod", [C, X])
def test_without_labels_or_rows(spark, docs, mod):
    none = spark.createDataFrame([], LAB)
    m = mod.fit(docs([(1, "a")]), none)
    assert [r["score"] for r in mod.score_documents(docs([(1, "a"), (2, None)]), m).collect()] == [0.5, 0.5]
    assert mod.score_documents(docs([]), m).count() == 0
    one = spark.createDataFrame([(1, 1, 1)], LAB)
    assert mod.score_documents(docs([(2, "b")]), mod.fit(docs([(1, "a")]), one)).first()["score"] == 1.0


@pytest.mark.parametrize("op,label", [(C.op6_quality, "quality"), (X.op7_toxicity, "toxic")])
def test_held_out_accuracy(spark, op, label):
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    held = op(spark, SF).where("held_out").join(lab, "doc_id")
    r = held.agg(F.count_if((F.col(label) == 1) & (F.col("predicted") == 1)).alias("tp"), F.count_if(F.col(label) == 1).alias("p"),
                 F.count_if((F.col(label) == 0) & (F.col("predicted") == 1)).alias("fp"), F.count_if(F.col(label) == 0).alias("n")).first()
    assert r["tp"] >= 0.8 * r["p"] and r["fp"] <= 0.05 * r["n"]
