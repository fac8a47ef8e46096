"""Fuzzy matching by rare letters, spelling by rests and pieces, exact vector search over inverted lists."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.functions import fuzzy as fz
from tunelake.operators import keywords as kw
from tunelake.operators import lyrics as ly
from tunelake.operators import vectors as vec


def words(rng, n, letters="abcdeéß", longest=9):
    return sorted({"".join(rng.choices(letters, k=rng.randrange(0, longest + 1))) for _ in range(n)})


def frame(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@pytest.mark.parametrize("cutoff", [0.5, 0.8, 1.0])
def test_fuzzy_pairs_match_brute_force(spark, cutoff):
    rng = random.Random(int(cutoff * 10))
    big = words(rng, 250) + ["".join(rng.choices("abcd", k=45)) for _ in range(4)]
    big += [big[-1][:40] + "xyzzy", "😀ab", None]
    small = words(rng, 40) + [big[-4], "ab😀", big[-3][3:], None]
    got = {(r.w, r.k) for r in fz.fuzzy_pairs(frame(spark, big, "w"), "w", frame(spark, small, "k"), "k", cutoff).collect()}
    want = {(w, k) for w in set(big) - {None} for k in set(small) - {None} if SequenceMatcher(None, k, w).ratio() >= cutoff}
    assert got == want and len(want) > 5


def test_few_pairs_reach_python_and_no_key_is_hot(spark):
    """Of words drawn like real ones: candidates against all pairs of fitting lengths, and the largest key."""
    rng = random.Random(1)
    part = ["an", "be", "con", "der", "est", "fi", "gra", "ho", "in", "ju", "ka", "lo", "men", "no", "or", "pre", "qu", "ra", "st", "ti", "un", "ve", "wy"]
    big = sorted({"".join(rng.choices(part, k=rng.randrange(2, 6))) for _ in range(4000)})
    small = rng.sample(big, 20)
    b, s = frame(spark, big, "_b"), frame(spark, small, "_s")
    lengths = sum(1 for w in big for k in small if abs(len(w) - len(k)) * 5 <= len(w) + len(k))
    n = fz.candidate_pairs(b, s, 0.8).count()
    assert n < lengths / 10
    rows = fz.lettered(b, "_b", fz.letter_frequencies(b, "_b")).withColumn("n", F.size("letters"))
    least = F.ceil(F.col("n") * F.lit(0.8 / 1.2))
    keys = rows.select("_b", "n", F.explode(fz._keys(F.col("letters"), (F.col("n") - least + 3).cast("int"), F.lit(3))).alias("key"))
    assert keys.groupBy("n", "key").count().agg(F.max("count")).first()[0] <= 0.01 * keys.count()


def test_fuzzy_plan_joins_on_letters(spark):
    p = fz.candidate_pairs(frame(spark, ["abc"], "_b"), frame(spark, ["abd"], "_s"), 0.8)._jdf.queryExecution().executedPlan().toString()
    assert "_key" in p and "NestedLoop" not in p and "Cartesian" not in p


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("k", [1, 2])
def test_spelling_matches_brute_force(spark, k):
    rng = random.Random(k)
    known = [w for w in words(rng, 150, "abcdé", 7)] + ["".join(rng.choices("abcdef", k=n)) for n in range(13, 40) for _ in range(2)]
    asked = words(rng, 40, "abcdé", 7)
    for w in known[-54:]:  # edits of long words, around the border between rests and pieces
        x = list(w)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(x))
            x[at:at + rng.randrange(2)] = rng.choice(["", "a", "z"])
        asked.append("".join(x))
    d = spark.createDataFrame([(w, i + 1) for i, w in enumerate(known)], "word string, word_id bigint")
    got = {r.word: r.correction for r in kw.spell_correct(frame(spark, [*asked, asked[0], None], "word"), d, k).collect()}
    want = {}
    for w in set(asked):
        near = sorted((distance(w, c), i, c) for i, c in enumerate(known) if distance(w, c) <= k)
        want[w] = near[0][2] if near else w
    assert got == want
    assert sum(w != c for w, c in want.items()) > 10


def test_spelling_plan_has_no_join_on_length(spark):
    d = spark.createDataFrame([("abc", 1)], "word string, word_id bigint")
    p = kw.spell_correct(frame(spark, ["abd"], "word"), d)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in p and "Cartesian" not in p and "_len" not in p


def test_terms_are_spelt_before_their_synonyms_are_looked_up(spark):
    lex = spark.createDataFrame([("love", "afection"), ("love", "heart"), ("war", "qqqqqqq"), ("war", "Battle")], "theme string, term string")
    vocab = spark.createDataFrame([("affection", 1), ("heart", 2), ("tenderness", 3)], "word string, word_id bigint")
    syn = spark.createDataFrame([(1, "affection"), (1, "tenderness"), (2, "heart"), (3, "Battle"), (3, "fight")], "synset_id bigint, lemma string")
    got = {tuple(r) for r in kw.theme_keywords(lex, vocab, syn).collect()}
    assert got == {("love", "affection"), ("love", "tenderness"), ("love", "heart"), ("war", "Battle"), ("war", "fight")}
    with pytest.raises(ValueError, match="no keywords"):
        kw.require_keywords(kw.theme_keywords(lex, vocab, syn), "peace")
    from tunelake.plans.themed import baseline_words
    assert ("love", "affection") in {tuple(r) for r in baseline_words(vocab, lex, syn).collect()}


def brute_topk(q, c, k, metric, self_too, masked=()):
    out = set()
    unit = lambda v: v / np.linalg.norm(v) if metric == "cosine" and np.linalg.norm(v) else v
    for i, x in q.items():
        s = sorted((-round(float(unit(x) @ unit(y)), 10), j) for j, y in c.items() if (self_too or i != j) and (i, j) not in masked)
        out |= {(i, j, r + 1) for r, (_, j) in enumerate(s[:k])}
    return out


@pytest.mark.parametrize("metric", ["cosine", "dot"])
@pytest.mark.parametrize("clustered", [True, False])
def test_lists_give_the_exact_top_k(spark, monkeypatch, metric, clustered):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(12, 6)) * 4
    c = {i: (base[i % 12] if clustered else 0) + rng.normal(size=6) * 0.4 for i in range(700)}
    c[700], c[701], c[702] = np.zeros(6), c[3].copy(), c[3].copy()
    q = {i: c[i] for i in range(0, 703, 20)} | {1000: np.zeros(6), 700: c[700], 701: c[701]}
    for name, value in (("LIST_ROWS", 40), ("PROBE_ROWS", 60), ("C_BLOCK", 30), ("Q_BLOCK", 7), ("SAMPLE_ROWS", 300)):
        monkeypatch.setattr(vec, name, value)
    masked = {(0, j) for j in range(0, 700, 2)} | {(20, int(j)) for j in range(690)}
    told = lambda d, name: spark.createDataFrame([(i, v.tolist()) for i, v in d.items()] + [(None, [1.0] * 6)], f"{name} long, v array<double>")
    index = vec.VectorIndex.fit(told(c, "id").repartition(5), "id", "v")
    assert int(index.stats["n"].sum()) == len(c) and len(index.stats["n"]) > 10
    hide = spark.createDataFrame([*masked, (5, None)], "qid long, cid long")
    got = {(r.qid, r.cid, r["rank"]) for r in index.topk(told(q, "q"), "q", "v", 9, metric, False, hide).collect()}
    assert got == brute_topk(q, c, 9, metric, True, masked)
    got = {(r.qid, r.cid, r["rank"]) for r in index.topk(told({40: q[40]}, "q"), "q", "v", 5, metric).collect()}
    assert got == brute_topk({40: q[40]}, c, 5, metric, False)
    met, of = map(sum, zip(*index.visited))
    if clustered:
        assert met < of / 2


def test_vector_search_edges(spark):
    e = spark.createDataFrame([], "id long, v array<double>")
    one = spark.createDataFrame([(1, [1.0, 0.0])], "id long, v array<double>")
    q = one.withColumnRenamed("id", "q")
    assert vec.vector_topk(q, "q", "v", e, "id", "v", 3).collect() == []
    assert vec.vector_topk(e.withColumnRenamed("id", "q"), "q", "v", one, "id", "v", 3).collect() == []
    assert vec.vector_topk(q, "q", "v", one, "id", "v", 3).collect() == []
    assert [tuple(r) for r in vec.vector_topk(q, "q", "v", one, "id", "v", 3, "dot", False).collect()] == [(1, 1, 1.0, 1)]
    with pytest.raises(ValueError):
        vec.vector_topk(q, "q", "v", one, "id", "v", 0)


def test_heavy_words_are_joined_by_broadcast(spark):
    """One word in every text, one in half: their cells are not in the shuffled join, weights are the same."""
    rows = [(f"T{i}", 1, "every", 2) for i in range(200)] + [(f"T{i}", 2, "half", 1) for i in range(0, 200, 2)]
    rows += [(f"T{i}", 10 + i, f"own{i}", 3) for i in range(200)]
    lyr = spark.createDataFrame(rows, "track_id string, word_id long, word string, cnt long")
    idf = ly.idf_table(lyr, key="word_id")
    parts = ly.with_idf(lyr, idf, "word_id", share=0.3)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "Python" not in plan
    assert parts.count() == len(rows)
    told = lambda share: sorted((r.track_id, r.word, round(r.tfidf, 12)) for r in ly.apply_tfidf(lyr, idf, share=share).collect())
    assert told(0.3) == told(0.001) == told(0.9)
    by_word = ly.idf_table(lyr.where("word <> 'half'"))
    got = {r.word: r.tfidf for r in ly.apply_tfidf(lyr.where("track_id = 'T0'"), by_word, unseen=4.0, share=0.3).collect()}
    idfs = {r.word: r.idf for r in by_word.collect()}
    w = {"every": 2 * idfs["every"], "own0": 3 * idfs["own0"], "half": 4.0}
    norm = sum(x * x for x in w.values()) ** 0.5
    assert {k: round(v, 12) for k, v in got.items()} == {k: round(v / norm, 12) for k, v in w.items()}
