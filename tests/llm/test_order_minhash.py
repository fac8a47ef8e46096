import hashlib
import random

from pyspark.sql import functions as F

from tunelake.llm import order_minhash as O


def op10(spark, tmp_path, df):
    df.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    return O.op10_order_minhash(spark, str(tmp_path)).collect()


def texts(n=300):
    rng = random.Random(3)
    return [" ".join(rng.choice(["ab", "ça", "𝔸", "de", "fg", "zz"]) + str(rng.randrange(50))
                     for _ in range(rng.choice([0, 1, 2, 30, 200]))) for _ in range(n)]


def test_edited_text_is_the_next_documents_start(spark, docs, tmp_path):
    rows = [(i * 3, t) for i, t in enumerate(texts())] + [(5000, None), (5001, "x" * 100000)]
    got = {r["doc_id"]: r for r in op10(spark, tmp_path, docs(rows).repartition(7))}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        t, nxt = t or "", nxt or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and len(got[i]["fingerprint"]) == 4 * O.BINS


def one(spark, docs, *ts):
    return [r["fingerprint"] for r in O.fingerprints(docs(list(enumerate(ts)))).orderBy("doc_id").collect()]


def test_equal_texts_order_and_edits(spark, docs):
    rng = random.Random(1)
    w = [f"w{rng.randrange(80)}" for _ in range(400)]
    moved = w[200:] + w[:200]
    edit = w[:390] + ["new"] * 10
    other = [f"v{rng.randrange(80)}" for _ in range(400)]
    df = O.fingerprints(docs([(0, " ".join(w)), (1, " ".join(w)), (2, " ".join(moved)), (3, " ".join(edit)),
                              (4, " ".join(other)), (5, ""), (6, None), (7, "w"), (8, "  ")]))
    f = {r["doc_id"]: r["fingerprint"] for r in df.collect()}
    near = lambda a, b: spark.range(1).select(O.likeness(F.lit(f[a]), F.lit(f[b]))).first()[0]
    assert f[0] == f[1] and f[5] == f[6] == f[8] == O.EMPTY * O.BINS and f[7] != f[5]
    assert near(0, 1) == near(5, 6) == 1.0 and near(0, 5) == 0.0
    assert near(0, 3) > 0.8 > near(0, 2) > near(0, 4)


def brute_fingerprint(pairs):
    """Occurrence numbers, bins, minima and text order, from (packed, bin) hashes in Python."""
    out = {}
    for pos, h26, b in pairs:
        out.setdefault(b, []).append((h26, pos))
    return {b: [h for _, h in sorted((p, h) for h, p in sorted(v)[:O.PICK])] for b, v in out.items()}


def test_bins_keep_the_minimal_kmers_in_text_order(spark, docs):
    """Each filled bin equals the hash of its PICK least occurrence-numbered k-mers, recomputed relationally."""
    t = " ".join(texts(40)[i] for i in range(40))
    w = t.split()
    grams = spark.createDataFrame([(i, w[i], w[i + 1]) for i in range(len(w) - 1)], "i int, a string, b string")
    k = grams.select("i", F.shiftright(F.xxhash64("a", "b"), 31).alias("k")).collect()
    seen, rows = {}, []
    for r in sorted(k, key=lambda r: r["i"]):
        rows.append((r["i"], r["k"], seen.get(r["k"], 0)))
        seen[r["k"]] = seen.get(r["k"], 0) + 1
    g = spark.createDataFrame(rows, "i int, k long, o int").select("i", F.shiftrightunsigned(
        F.xxhash64("k", "o"), 32).alias("g")).collect()
    want = brute_fingerprint([(r["i"], r["g"], r["g"] >> 26) for r in g])
    hashed = spark.createDataFrame([(b, v) for b, v in want.items()], "b int, v array<long>").select(
        "b", F.substring(F.hex(F.xxhash64("v").bitwiseAND(0xFFFF).bitwiseOR(0x10000)), 2, 4).alias("h")).collect()
    h = {r["b"]: r["h"] for r in hashed}
    assert one(spark, docs, t)[0] == "".join(h.get(b, O.EMPTY) for b in range(O.BINS))


def test_empty_table_single_row_and_repeats(spark, docs, tmp_path):
    assert op10(spark, tmp_path, docs([])) == []
    r = op10(spark, tmp_path, docs([(1, "abcd")]))
    assert r[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and r[0]["near_next"] == 1.0
    assert len(op10(spark, tmp_path, docs([(1, "a b"), (1, "a b"), (None, "c"), (None, None)]))) == 4
