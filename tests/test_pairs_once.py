"""Co-occurrences: pairs are counted and exchanged once, whatever words are known to be frequent."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tunelake.operators import embeddings as em
from tunelake.operators import keywords as kw
from tunelake.plans import catalog

SMALL = "/root/testdata/sf0.001"


def test_pairs_are_counted_once(spark):
    plan = catalog.QUERIES["word_cooccurrences"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


@pytest.mark.parametrize("often", [0, 3, 50])
def test_cooccurrences_with_frequent_words(spark, monkeypatch, often):
    monkeypatch.setattr(em, "OFTEN", often)
    monkeypatch.setattr(em, "TOKENS", 40)
    rnd = random.Random(often)
    texts = [[f"w{min(rnd.randrange(20), rnd.randrange(20))}" for _ in range(rnd.randrange(15))] for _ in range(40)]
    want = Counter()
    for t in texts:
        for i, x in enumerate(t):
            for y in t[i + 1:i + 6]:
                if x != y:
                    want[frozenset((x, y))] += 1
    count = Counter(w for t in texts for w in t).most_common()
    words = spark.createDataFrame([(w, i + 1) for i, (w, _) in enumerate(count)], "word string, word_id long")
    pairs = em.cooccurrences(spark.createDataFrame([(t,) for t in texts], "tokens array<string>"), vocabulary=words)
    assert pairs.where("a >= b").isEmpty()
    of = {r.h: r.word for r in words.select("word", F.xxhash64("word").alias("h")).collect()}
    got = pairs.collect()
    assert len(got) == len(want) and {frozenset((of[r.a], of[r.b])): r.n for r in got} == want


@pytest.mark.parametrize("most", [0, 20])
def test_sentences_hold_known_words_only(spark, monkeypatch, most):
    monkeypatch.setattr(kw, "SMALL_ROWS", most)
    rows = [(1, 0, "a"), (1, 1, "x"), (1, 2, "b"), (2, 0, None), (2, 1, "b"), (2, 12, "a"), (3, 0, "y")]
    tokens = spark.createDataFrame(rows, "doc_id long, pos int, w string")
    vocab = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "word string")
    got = {tuple(r.tokens) for r in kw.document_sentences(tokens, vocab, 10).collect()}
    assert got == {("a", "b"), ("b",), ("a",)}
