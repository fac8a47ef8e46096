import hashlib
import random
import re

from pyspark.sql import functions as F

from tunelake.llm import pii as P

RE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
      "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def brute(text):
    out = []
    for kind, p in RE.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((P.KINDS.index(kind), m.start(), m.end()))
    return out


def texts():
    rng = random.Random(6)
    bits = ["a@b.co", "x_y%z@q-r.s.t", "@", ".", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112",
            "378282246310005", "6011000990139424123", "+1 (319) 555-5132", "+49", "+1-2", " ", "\n", "é", "𝔸", "_", "-", "0", "00255.0.0.1", "ab"]
    out = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(600)]
    return out + ["", None, "x" * 4000, "a." * 2000 + "@", "7" * 4000, "4111111111111111 " * 300, "+" * 5000, "1 " * 2000, "4111111111111111; " * 900, "a@b.c_d@e.f"]


def test_base_spans_match_brute_force(spark, docs):
    ts = texts()
    rows = P.find_pii(docs(list(enumerate(ts))).repartition(6)).collect()
    assert len(rows) == len(ts)
    for r in rows:
        assert [tuple(s) for s in r["base"]] == brute(ts[r["doc_id"]]), ts[r["doc_id"]]
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}


def test_very_long_texts(spark, docs):
    ts = ["x" * 2_000_000, "a." * 500_000 + "@", "7" * 500_000, "1 " * 100_000, "4111111111111111; " * 20_000]
    got = {r["doc_id"]: len(r["base"]) for r in P.find_pii(docs(list(enumerate(ts)))).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 20_000}


def test_contexts_discover_unseen_identifiers(spark, docs):
    rows = [(i, f"alpha beta call me at +1 (319) 555-{1000 + i} thanks") for i in range(20)]
    rows += [(100, "please call me at 555-0199-22. bye"), (101, "version 2.0 of 12345678 things"), (102, "Call  me\nat 555-0199-22")]
    rows += [(200 + i, f"mail to user{i}@site{i}.org now") for i in range(10)] + [(300, "é mail to root@localhost, please")]
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in P.find_pii(docs(rows)).collect()}
    assert got[100] == [(3, 18, 29)] and got[101] == [] and got[300] == [(0, 10, 24)]
    assert [s[0] for s in got[102]] == [3]


def test_accepted_identifiers_are_spans_wherever_they_stand(spark, docs):
    """At the text's start, right after another slot and under a context that is no trusted pattern."""
    rows = [(i, f"alpha beta call me at +1 (319) 555-{1000 + i} thanks") for i in range(20)]
    rows += [(50 + i, f"gamma you dial +1 (319) 555-{2000 + i} then") for i in range(20)] + [(105, "so you dial 555-0199-22")]
    rows += [(100, "please call me at 555-0199-22. bye"), (101, "555-0199-22 stands first"), (102, "old 12345 555-0199-22"),
             (103, "please write 555-0199-22 down"), (104, "please call me at 555-0199-22")]
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in P.find_pii(docs(rows)).collect()}
    assert got[100] == [(3, 18, 29)] and got[101] == [(3, 0, 11)] and got[102] == [(3, 10, 21)] and got[103] == [(3, 13, 24)]
    assert "555-0199-22" not in " ".join(r["text"] for r in P.redact(docs(rows)).collect())


def test_secrets_are_seeded_by_names_and_found_elsewhere(spark, docs):
    key = lambda i: f"{i:02d}" + "ab12cd34ef" * 3
    rows = [(i, f'my token = "{key(i)}" for use') for i in range(12)] + [(20, f"api_key=\"{key(20)}\"; next")]
    rows += [(30, 'my token = "Short-1234-abcdef" here'), (31, f"seen {key(3)} again"), (32, f"plain {key(99)} unnamed")]
    rows += [(40, "path = images/photo-2020-holiday-large.png"), (41, "total = 12345678901234567890123"), (42, "name = Bartholomew-the-second-of-all")]
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in P.find_pii(docs(rows)).collect()}
    assert all(got[i] == [(4, 12, 44)] for i in range(12)) and got[20] == [(4, 9, 41)]
    assert got[30] == [(4, 12, 29)] and got[31] == [(4, 5, 37)]  # a trusted pattern's, and a seed under another context
    assert got[32] == got[40] == got[42] == [] and all(s[0] != 4 for s in got[41])
    assert {r["doc_id"]: r["text"] for r in P.redact(docs(rows)).collect()}[20] == 'api_key="[SECRET]"; next'


def test_redaction_of_a_very_long_text(spark, docs):
    text = "word " * 200_000 + "a@b.co " + "é" * 1_000_000 + " 1.2.3.4"
    (r,) = P.redact(docs([(1, text)])).collect()
    assert r["text"] == text.replace("a@b.co", "[EMAIL]").replace("1.2.3.4", "[IP]") and r["n_chars"] == len(r["text"])


def test_op_columns(spark, docs, tmp_path):
    ts = texts()[:40]
    docs(list(enumerate(ts))).write.parquet(str(tmp_path / "documents.parquet"))
    for r in P.op5_pii(spark, str(tmp_path)).collect():
        b = brute(ts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(x[0] == i for x in b) for i in range(4)]
        told = ",".join(f"{P.KINDS[k]}:{s}:{e}" for k, s, e in b)
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()


def test_redaction(spark, docs):
    d = docs([(1, "é a@b.co 1.2.3.4 end"), (2, None), (3, "none"), (3, "none"), (None, "+1 (319) 555-5132"), (4, "4111 1111 1111 1111.2.3.4 x")])
    d = d.withColumn("_text", F.lit("clash")).withColumn("spans", F.lit("clash"))
    out = P.redact(d)
    assert out.columns == d.columns
    got = sorted((r["doc_id"] or 0, r["text"], r["n_chars"]) for r in out.collect() if r["text"])
    assert got == [(0, "[PHONE]", 7), (1, "é [EMAIL] [IP] end", 18), (3, "none", 4), (3, "none", 4), (4, "[CARD].2.3.4 x", 14)]
    assert out.count() == 6
    assert P.redact(docs([])).count() == 0


def test_running_sums(spark):
    for n in (0, 1, 2, 5, 17, 100):
        v = list(range(1, n + 1))
        df = spark.createDataFrame([(v,)], "v array<long>")
        assert df.select(P.running(F.col("v"), F.lit(0).cast("long"))).first()[0] == [sum(v[:i]) for i in range(n)]
