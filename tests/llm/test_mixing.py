import random

from pyspark.sql import functions as F

from tunelake.llm import mixing as M


def water(sizes):
    """Shares by weight stopped at twice a source's size, the excess shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        t = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if t[s] > 2 * sizes[s]]
        if not over:
            return {**t, **{s: 2.0 * sizes[s] for s in full}}
        full |= set(over)


def fixture(n=3000):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        src = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", "d", "é", None])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 3, 10, 50, 400])), src))
    return rows + [(n, None, "a"), (n + 1, "x " * 9, "only"), (None, "y y", "a"), (7, rows[7][1], rows[7][2])]


def test_targets_and_words_taken(spark, docs):
    rows = fixture()
    d = docs(rows).repartition(5)
    s = M.sized(d)
    out = M.copies(s, M.mix_plan(s)).withColumn("taken", F.col("copies") * F.col("size")).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, t, src in rows:
        sizes[src] = sizes.get(src, 0) + len((t or "").split())
    want, taken = water(sizes), {}
    for r in out:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert 0 <= r["copies"] <= 2 and (r["size"] > 0 or r["copies"] == 0)
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for src, t in want.items():
        assert abs(taken[src] - t) <= max(400, 0.01 * t), src


def test_rates_meet_the_constraint_and_rise_or_fall_with_size(spark, docs):
    s = M.sized(docs(fixture()))
    out = M.copies(s, M.mix_plan(s)).where("size > 0").collect()
    by = {}
    for r in out:
        by.setdefault(r["source"], []).append(r)
    for rs in by.values():
        assert abs(sum(r["rate"] * r["size"] for r in rs) / rs[0]["target"] - 1) < 1e-5
        tilt = [x["rate"] for x in sorted(rs, key=lambda r: r["size"])]
        assert tilt in (sorted(tilt), sorted(tilt, reverse=True))


def test_reruns_agree_and_edges(spark, docs):
    d = docs(fixture(500))
    runs = []
    for n in (1, 6):
        s = M.sized(d.repartition(n))
        runs.append(sorted((str(r["doc_id"]), r["size"], r["copies"]) for r in M.copies(s, M.mix_plan(s)).collect()))
    assert runs[0] == runs[1]
    e = M.sized(docs([]))
    assert M.copies(e, M.mix_plan(e)).count() == 0
    z = M.sized(docs([(1, ""), (2, None)]))
    assert [r["copies"] for r in M.copies(z, M.mix_plan(z)).collect()] == [0, 0]
    mixed = M.mix_documents(d.withColumn("size", F.lit("clash")))
    assert mixed.columns == [*d.columns, "size"] and mixed.count() == sum(x[2] for x in runs[0])
