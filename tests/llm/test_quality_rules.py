import re
from collections import Counter

from pyspark.sql import functions as F

from tunelake.llm import quality_rules as Q

TEXTS = ["", None, "   \n\t ", "a b c d e", "one two three four five one two three four five six",
         "x\nx\n x\ny\n\n", "word " * 40, "é ü 𝔸𝔹 ok\x0bfine\x0cgood\rbad", "A# b$ %c &|<>",
         " ".join(str(i) for i in range(3000)), "long" * 50000, "SHOUT LOUD WORDS ARE ALL HERE NOW FOR YOU TO SEE",
         "a b c d e f a b c d e f a b c d e", " nbsp joins words  em"]


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    c = Counter(wins)
    cov = {i + j for i, x in enumerate(wins) if c[x] > 1 for j in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(cov))


def test_measures_match_brute_force(spark, docs):
    rows = Q.ledger(docs(list(enumerate(TEXTS)))).select("_row.doc_id", *Q.MEASURES[:5]).collect()
    got = {r[0]: tuple(r[1:]) for r in rows}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_policy_and_ablation_from_stored_bits(spark, docs):
    led = Q.ledger(docs(list(enumerate(TEXTS)) + [(3, "a b c d e"), (None, "a b")]))
    rows = Q.apply_policy(led, "base.v1").collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        n, rep = r["n_words"], r["n_repeat_words"]
        assert r["kept"] == (not (n < 10 or 100 * rep > 20 * n))
    masks = [r["fail_bits"] & Q.mask(Q.CURRENT) for r in rows]
    for r in Q.ablation(led).collect():
        bit = next(1 << x.bit for x in Q.RULES if x.name == r["rule"])
        assert r["failed"] == sum(bool(m & bit) for m in masks)
        assert r["only_this"] == sum(m == bit for m in masks)
        assert r["kept_without"] == sum(m & ~bit == 0 for m in masks)


def test_empty_table_and_clashing_columns(spark, docs):
    assert Q.ledger(docs([])).count() == 0
    d = docs([(1, "a b c")]).withColumn("n_words", F.lit("x")).withColumn("fail_bits", F.lit("y")).withColumn("_w", F.lit(1))
    r = Q.apply_policy(Q.ledger(d)).first()
    assert (r["n_words"], r["_row"]["n_words"], r["kept"]) == (3, "x", False)
