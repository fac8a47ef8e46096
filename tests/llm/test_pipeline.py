import itertools
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from tunelake.llm import packing, quality_rules
from tests_brute import brute_groups

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns
        seen[name] = (docs, out)
        docs = out
    d, q = seen["quality_rules"]
    assert 0 < q.count() < d.count()
    assert quality_rules.kept_rows(quality_rules.ledger(q)).count() == q.count()
    rows = [tuple(r) for r in q.select("doc_id", "text").collect()]
    _, one = seen["ngram_jaccard"]
    assert sorted(r["doc_id"] for r in one.select("doc_id").collect()) == sorted(set(brute_groups(rows, 80, 5).values()))
    d, p = seen["pii"]
    assert p.count() == d.count() and p.where(F.length("text") != F.col("n_chars")).count() == 0
    assert p.where(F.col("text").rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]")).count() == 0
    assert p.where(F.contains("text", F.lit("[EMAIL]"))).count() > 0
    d, m = seen["mixing"]
    assert m.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    assert m.join(d, d.columns, "left_anti").count() == 0
    d, s = seen["packing"]
    tok = packing.Encoder(packing.tokenizer_path())
    want = sum(len(tok(r["text"] or "")) // 4 + 1 for r in d.select("text").collect())
    assert s.agg(F.sum("length")).first()[0] == want


def test_near_copies_of_five_words_at_eight_tenths_go(spark):
    """Copies that 3-word shingles at 0.9 keep apart: scattered edits, words appended, and one just below 0.8."""
    w = [f"a{i}" for i in range(400)]
    edited = [f"e{i}" if i % 50 == 25 else x for i, x in enumerate(w)]
    far = [f"f{i}" if i % 40 == 20 else x for i, x in enumerate(w)]
    rows = [(1, w), (2, edited), (3, w + [f"n{i}" for i in range(60)]), (4, far), (5, far + ["x"]), (6, w[:4])]
    rows = [(i, " ".join(t), "en", "s", len(" ".join(t))) for i, t in rows]
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t, *_ in rows[:5]}
    near = lambda a, b: 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    assert near(1, 2) and near(1, 3) and near(4, 5) and not any(near(a, b) for a in (1, 2, 3) for b in (4, 5))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in P.near_duplicates(spark, docs, SF).collect()) == [1, 4, 6]


def test_near_duplicate_stage_matches_brute_force(spark):
    """The quality-filtered table at 5 words and 0.8, and the stages after it."""
    docs = P.quality(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).persist()
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    sets = {}
    for d, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    group = {d: d for d in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y) and group[a] != group[b]:
            lo, hi = sorted((group[a], group[b]))
            group = {d: lo if g == hi else g for d, g in group.items()}
    one = P.near_duplicates(spark, docs, SF).persist()
    assert one.columns == docs.columns
    assert sorted(r["doc_id"] for r in one.select("doc_id").collect()) == sorted(set(group.values()))
    p = P.personal_data(spark, one, SF).persist()
    assert p.count() == one.count() and p.where(F.col("text").rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]")).count() == 0
    m = P.mix(spark, p, SF).persist()
    assert m.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2 and m.join(p, p.columns, "left_anti").count() == 0
    tok = packing.Encoder(packing.tokenizer_path())
    want = sum(len(tok(r["text"] or "")) // 4 + 1 for r in m.select("text").collect())
    assert P.pack(spark, m, SF).agg(F.sum("length")).first()[0] == want


@pytest.fixture
def run(spark, tmp_path):
    """The whole pipeline on rows of documents, with columns that operators use inside."""
    def go(rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
        at = str(tmp_path / f"sf{len(rows)}")
        docs = spark.createDataFrame(rows, schema).withColumn("label", F.lit("x")).withColumn("keys", F.lit(1)).withColumn("_row", F.lit(2.5))
        docs.write.parquet(f"{at}/documents.parquet")
        return P.run(spark, at)
    return go


TEXT = " ".join(f"word{i}" for i in range(60)) + "."


def test_run_on_an_empty_table(run):
    out = run([])
    assert out.count() == 0 and {"doc_id", "start", "length"} <= set(out.columns)


def test_run_on_repeated_rows_null_ids_and_clashing_columns(run):
    rows = [(1, TEXT, "en", "a", 1), (1, TEXT, "en", "a", 1), (2, None, "en", None, 0), (3, "", "en", "a", 0), (None, TEXT, "en", "a", 1),
            (None, TEXT.upper() + " other", None, "b", 1)]
    rows += [(i, " ".join(f"t{i}-{k}" for k in range(40)) + f" me{i}@example.org", "en", "abc"[i % 3], 1) for i in range(10, 30)]
    rows += [(None, " ".join(f"null{k}" for k in range(50)), None, None, 1)]
    out = run(rows).collect()
    ids = {r["doc_id"] for r in out}
    assert ids <= {1, None, *range(10, 30)} and 1 in ids and len(ids & set(range(10, 30))) >= 15
    taken = {}
    for r in out:
        taken.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r["length"])
    assert all(sum(v) % k[1] == 0 for k, v in taken.items() if k[0] is not None)  # whole copies of one document
    assert sum(sum(v) // k[1] for k, v in taken.items() if k[0] == 1) <= 2  # one of the copies, twice at most


def test_registered():
    assert E.queries()["pipeline"] is P.run and len(P.STAGES) == 5 and P.ORACLE_SQL is None


def test_every_operator_is_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
