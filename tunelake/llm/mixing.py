"""Mixing sources to target token weights by entropy balancing.

Per source the document rates ``w`` minimise their relative entropy to 1 under
one token constraint, ``sum(size * w) = target``, and ``0 <= w <= CAP``. The
solution is an exponential tilt ``w = min(CAP, exp(lambda * x))`` of the
document size ``x = size / mean size``; ``lambda`` is the root of the convex
dual's gradient. Newton steps run for all sources at once as one aggregate over
a (source, size) histogram, kept inside a bracket. Rates become whole copies by
a threshold on a keyed hash, set per source so that the copied words meet the
target to within one histogram step.

Scale: texts are read once for the sizes; the histogram is pre-aggregated
map-side, so a source with a third of all rows costs its distinct sizes; the
plan per source is a few numbers and is never collected.

Defined cases: null text has size 0 and is never copied; null source is a
source of its own, last in order; a null doc_id is only part of the hash;
repeated rows get the same hash, hence the same copies; an empty table gives no
rows; a source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm import text as T
from tunelake.operators.ids import sequential_index
from tunelake.session import cut_lineage, if_small

CAP = 2.0            # most times a document is taken, and a target in source sizes
WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = 1.5          # of all words
STEPS = 1 << 15      # hash steps per unit rate, for rounding
MAX_NEWTON = 80
TOLERANCE = 1e-7     # of a source's target


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sized(docs: DataFrame, keep_row: bool = False) -> DataFrame:
    """doc_id, source, size and a keyed uniform ``u`` in [0, 1); ``_row`` on request."""
    df = T.as_row(docs)
    u = F.pmod(F.xxhash64(F.lit(17), "_row.doc_id", "_row.text"), F.lit(1 << 40)) / float(1 << 40)
    cols = [F.col("_row.doc_id").alias("doc_id"), F.col("_row.source").alias("source"),
            n_words(F.col("_row.text")).alias("size"), u.alias("u")]
    return df.select(*cols, *(["_row"] if keep_row else []))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, n_docs, target): shares by weight, stopped at ``cap`` sizes.

    ``sizes``: (source, size, n). The excess over the stops is shared again by
    weight among the open sources until none is above its stop.
    """
    src = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                      F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("n_docs"))
    src = sequential_index(src, [F.asc_nulls_last("source")], "_i")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("_i", F.lit(len(weights))).cast("int"))
    src = src.select("source", "source_size", "n_docs", weight.alias("_w"),
                     (F.lit(cap) * F.col("source_size")).alias("_stop"), F.lit(False).alias("_full"))
    src = cut_lineage(src)
    total = (src.agg(F.sum("source_size")).first()[0] or 0) * share
    while True:
        a = src.agg(F.sum(F.when(F.col("_full"), F.col("_stop")).otherwise(0.0)),
                    F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("_w")))).first()
        level = (total - (a[0] or 0.0)) / a[1] if a[1] else 0.0
        want = F.lit(level) * F.col("_w")
        above = ~F.col("_full") & (want > F.col("_stop"))
        if not src.where(above).limit(1).count():
            break
        src = cut_lineage(src.withColumn("_full", F.col("_full") | above))
    target = F.when(F.col("_full"), F.col("_stop")).otherwise(F.lit(level) * F.col("_w"))
    return src.select("source", "source_size", "n_docs", target.alias("target"))


def rate(size: Column, lam: Column, mean: Column, cap: float = CAP) -> Column:
    """min(cap, exp(lam * size / mean)); a null ``lam`` stands for no bound: the cap."""
    t = F.least(lam * size / mean, F.lit(50.0))
    return F.when(size <= 0, 0.0).otherwise(F.coalesce(F.least(F.exp(t), F.lit(cap)), F.lit(cap)))


def tilts(sizes: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """``goals`` plus ``mean`` and ``lam``, by safeguarded Newton steps on log(sum) - log(target)."""
    mean = F.col("source_size") / F.greatest(F.col("n_docs"), F.lit(1))
    full = F.col("target") >= F.lit(cap) * F.col("source_size") * (1 - 1e-12)
    state = goals.select("*", mean.alias("mean"), F.when(full, None).otherwise(F.lit(0.0)).alias("lam"),
                         F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    state = cut_lineage(state)
    keys = [c for c in state.columns if c not in ("lam", "lo", "hi")]
    for _ in range(MAX_NEWTON):
        open_ = state.where(F.col("lam").isNotNull())
        s = sizes.withColumnRenamed("source", "_s")
        x = F.col("size") / F.col("mean")
        w = rate(F.col("size"), F.col("lam"), F.col("mean"), cap)
        mass = F.col("size") * F.col("n")
        sums = (s.join(open_, F.col("_s").eqNullSafe(F.col("source")))
                .groupBy(F.col("_s").alias("_k")).agg(
                    F.sum(mass * w).alias("f"), F.sum(F.when(w < cap, mass * w * x).otherwise(0.0)).alias("g")))
        st = state.join(sums, F.col("source").eqNullSafe(F.col("_k")) & F.col("lam").isNotNull(), "left")
        off = F.log(F.col("f")) - F.log(F.col("target"))
        done = F.col("f").isNull() | (F.abs(off) < TOLERANCE)
        lo, hi = F.when(off < 0, F.col("lam")).otherwise(F.col("lo")), F.when(off > 0, F.col("lam")).otherwise(F.col("hi"))
        st = st.select(*keys, "lam", lo.alias("lo"), hi.alias("hi"), off.alias("off"), done.alias("done"),
                       (off * F.col("f") / F.greatest(F.col("g"), F.lit(1e-300))).alias("step"))
        reach = 4 + F.abs(F.col("lam"))  # a step is at most this long
        newton = F.col("lam") - F.greatest(F.least(F.col("step"), reach), -reach)
        inside = (F.col("lo").isNull() | (newton > F.col("lo"))) & (F.col("hi").isNull() | (newton < F.col("hi")))
        lam = F.when(F.col("done"), F.col("lam")).when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2)
        state = cut_lineage(st.select(*keys, lam.alias("lam"), "lo", "hi", "done"))
        if not state.where(~F.col("done")).limit(1).count():
            break
        state = state.drop("done")
    return state.drop("done", "lo", "hi")


def mix_plan(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Per source: target, tilt and rounding threshold, from ``sized`` rows."""
    hist = cut_lineage(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    plan = tilts(hist, targets(hist, weights, share, cap), cap)
    few = if_small(plan)
    d = rows.join(few, rows["source"].eqNullSafe(few["source"])).select(
        rows["source"], "size", "u", "lam", "mean", "target")
    d = d.withColumn("_rate", rate(F.col("size"), F.col("lam"), F.col("mean"), cap))
    # documents with a spare copy, by the rate at which the hash would still take it
    steps = d.groupBy("source", _step(F.col("u"), F.col("_rate"), cap).alias("_v")).agg(
        F.sum("size").alias("_words"), F.sum(F.floor("_rate") * F.col("size")).alias("_floor"),
        F.first("target").alias("target"))
    # at most 2 * STEPS + 2 rows a source
    run = Window.partitionBy("source").orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("source")
    steps = steps.withColumn("_need", F.col("target") - F.sum("_floor").over(whole)).withColumn(
        "_cum", F.sum(F.when(F.col("_v").isNull(), 0).otherwise(F.col("_words"))).over(run))
    off = F.abs(F.col("_cum") - F.col("_need"))
    best = steps.where(F.col("_v").isNotNull()).groupBy("source").agg(
        F.min(F.struct(off.alias("o"), F.col("_v").alias("v"))).alias("b"), F.first("_need").alias("_need"))
    cut = best.select(F.col("source").alias("_s"),
                      F.when(F.col("b.o") <= F.abs(F.col("_need")), F.col("b.v")).alias("cut"))
    plan = plan.join(cut, plan["source"].eqNullSafe(cut["_s"]), "left").drop("_s")
    return cut_lineage(plan)


def _step(u: Column, w: Column, cap: float) -> Column:
    """Hash step at which a document gets one copy more than floor(rate); null if it can't."""
    return F.when(F.floor(w) < int(cap), F.floor((u - (w - F.floor(w))) * STEPS).cast("int"))


def copies(rows: DataFrame, plan: DataFrame, cap: float = CAP) -> DataFrame:
    """``rows`` plus source_size, target, rate and whole ``copies`` of each document."""
    # a row a source: the rows with their texts stay where they are
    p = if_small(plan.select(F.col("source").alias("_s"), "source_size", "target", "mean", "lam", "cut"))
    w = rate(F.col("size"), F.col("lam"), F.col("mean"), cap)
    d = rows.join(p, F.col("source").eqNullSafe(F.col("_s"))).withColumn("rate", w)
    extra = F.coalesce(_step(F.col("u"), F.col("rate"), cap) <= F.col("cut"), F.lit(False))
    n = F.when(F.col("size") <= 0, 0).otherwise(F.floor("rate").cast("int") + extra.cast("int"))
    return d.withColumn("copies", n).drop("_s", "mean", "lam", "cut")


def mix_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The mixed corpus: each input row as often as it is taken."""
    plan = mix_plan(cut_lineage(sized(docs)), weights, share, cap)
    d = copies(sized(docs, keep_row=True), plan, cap).where(F.col("copies") > 0)
    return d.select(F.explode(F.array_repeat("_row", F.col("copies"))).alias("_row")).select("_row.*")


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    rows = cut_lineage(sized(T.table(spark, sf_dir, "documents")))
    out = copies(rows, mix_plan(rows))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                      "rate")
