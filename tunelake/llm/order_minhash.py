"""Order MinHash fingerprints, sensitive to edit distance.

A text's k-mers of words get occurrence numbers, so repeats stay apart. Each
numbered k-mer falls by its hash into one of BINS bins; a bin keeps its
``PICK`` minimal ones, puts them back into text order and hashes the tuple. A
fingerprint is the BINS tuple hashes as fixed-width hex, ``----`` for an empty
bin (one-permutation form: one pass and two sorts a text, n log n, instead of
BINS passes). Moved passages keep their k-mers but change the order inside
tuples, so likeness falls with edits and not only with vocabulary.

The fingerprint is per row, without shuffle. ``with_next`` takes whole rows once
by quantile ranges of doc_id (``dealt``); the row after a range's last is added
to it as a marked extra row, one a range.

Defined cases: null text is empty; empty and blank texts have the all-empty
fingerprint and are alike (1.0) only with each other; texts with fewer than K
words are one k-mer; rows with the same doc_id are ordered by text hash, a null
doc_id comes last; one row follows itself; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm import text as T

K = 2        # words in a k-mer
BINS = 64    # fixed by the six bits that choose a bin
PICK = 2     # k-mers in a tuple
EMPTY = "----"
POS = (1 << 31) - 1


def add_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` plus the fingerprint of column ``text``."""
    keep = df.columns
    long = lambda v: F.lit(v).cast("long")
    top = lambda x: F.shiftright(x, 31)
    df = df.withColumn("_w", T.words(F.col(text)))
    n = F.size("_w")
    gram = lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(K)])
    pack = lambda h, i: F.shiftleft(top(h), 31).bitwiseOR(i.cast("long"))
    df = df.withColumn("_a", F.when(n >= K, F.sort_array(F.transform(
        T.positions(n - (K - 1)), lambda i: pack(gram(i), i))))
        .when(n > 0, F.array(pack(F.xxhash64("_w"), F.lit(0)))).otherwise(F.array().cast("array<long>")))
    # equal k-mers are neighbours now, in text order: number them
    first = lambda a: F.filter(T.positions(F.size(a)), lambda i: (i == 0) | (
        top(F.get(a, i)) != top(F.get(a, i - 1))))
    df = df.select(*keep, "_a", first("_a").alias("_s"))

    def numbered(start: Column, j: Column) -> Column:
        stop = F.coalesce(F.get("_s", j + 1), F.size("_a")) - 1
        return F.transform(F.sequence(start, stop), lambda i: _binned(F.get("_a", i), i - start))

    def _binned(x: Column, occurrence: Column) -> Column:
        g = F.xxhash64(top(x), occurrence)
        return F.shiftleft(F.shiftrightunsigned(g, 32), 31).bitwiseOR(x.bitwiseAND(long(POS)))

    # 32 hash bits above 31 position bits: the six highest choose the bin
    df = df.select(*keep, F.sort_array(F.flatten(F.transform("_s", numbered))).alias("_b"))
    bin_ = lambda x: F.shiftright(x, 57)
    heads = F.filter(T.positions(F.size("_b")), lambda i: (i == 0) | (
        bin_(F.get("_b", i)) != bin_(F.get("_b", i - 1))))
    df = df.select(*keep, "_b", heads.alias("_h"))

    def tuple_hash(i: Column, j: Column) -> Column:
        own = bin_(F.get("_b", i))
        picked = [F.get("_b", i)] + [
            F.when(bin_(F.get("_b", i + p)) == own, F.get("_b", i + p)) for p in range(1, PICK)]
        in_order = F.sort_array(F.filter(F.array(*[
            F.struct(x.bitwiseAND(long(POS)).alias("p"), top(x).alias("k")) for x in picked]),
            lambda s: s["k"].isNotNull()))
        h = F.xxhash64(F.transform(in_order, lambda s: s["k"]))
        before = F.coalesce(bin_(F.get("_b", F.get("_h", j - 1))), long(-1))
        hex4 = F.substring(F.hex(h.bitwiseAND(long(0xFFFF)).bitwiseOR(long(0x10000))), 2, 4)
        return F.concat(F.repeat(F.lit(EMPTY), (own - before - 1).cast("int")), hex4)

    parts = F.array_join(F.transform("_h", tuple_hash), "")
    return df.select(*keep, F.rpad(parts, 4 * BINS, "-").alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples among the bins filled in either fingerprint; 1.0 for equal ones."""
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    at = lambda c, i: F.substring(c, i * 4 + 1, F.lit(4))
    same = F.size(F.filter(bins, lambda i: (at(a, i) == at(b, i)) & (at(a, i) != EMPTY)))
    filled = F.size(F.filter(bins, lambda i: (at(a, i) != EMPTY) | (at(b, i) != EMPTY)))
    return F.when(a == b, 1.0).otherwise(same / F.greatest(filled, F.lit(1)))


def dealt(df: DataFrame, key: str, tie: Column) -> DataFrame:
    """``df`` in ranges of descending ``key`` (``_part``), each with the row that follows it (``_extra`` = 1)."""
    n = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = [i / n for i in range(1, n)]
    bounds = sorted(set(df.agg(F.percentile_approx(key, at, 100 * n)).first()[0] or []))
    if bounds:  # two short searches instead of one long one
        step = max(1, math.isqrt(len(bounds)))
        coarse, fine = F.lit(bounds[::-1][::step]).cast("array<long>"), F.lit(bounds[::-1]).cast("array<long>")
        c = F.greatest(F.size(F.filter(coarse, lambda b: b > F.col(key))) - 1, F.lit(0)) * step
        where = c + F.size(F.filter(F.slice(fine, c + 1, step), lambda b: b > F.col(key)))
    else:
        where = F.lit(0)
    part = F.when(F.col(key).isNull(), len(bounds) + 1).otherwise(where).cast("int")
    df = df.withColumn("_part", part).withColumn("_extra", F.lit(0)).withColumn("_tie", tie)

    # the first row of every range, from the keys alone: n + 1 rows of numbers at most
    order = Window.orderBy("_part")
    ring = df.groupBy("_part").agg(F.max(key).alias("_key")).withColumn("_before", F.coalesce(
        F.lag("_part").over(order), F.max("_part").over(Window.partitionBy())))
    firsts = df.join(F.broadcast(ring.select(F.col("_part").alias("_p"), "_key", "_before")),
                     (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_key")))
    top = Window.partitionBy("_p").orderBy("_tie")
    firsts = firsts.withColumn("_n", F.row_number().over(top)).where(F.col("_n") == 1)
    marked = firsts.drop("_part", "_extra").withColumn("_extra", F.lit(1)).withColumnRenamed("_before", "_part")
    return df.unionByName(marked.select(*df.columns))


def with_next(ranges: DataFrame, key: str, carry: list[str]) -> DataFrame:
    """``dealt`` rows plus ``next_<c>`` for c in ``carry``: the row after it by descending ``key``,
    then tie, and the first row after the last. One shuffle."""
    w = Window.partitionBy("_part").orderBy("_extra", F.desc_nulls_last(key), "_tie")
    out = ranges.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carry])
    return out.where(F.col("_extra") == 0).drop("_part", "_extra", "_tie")


def bodies(docs: DataFrame) -> DataFrame:
    """doc_id and text, null as empty."""
    return T.as_row(docs).select(F.col("_row.doc_id").alias("doc_id"),
                                 F.coalesce("_row.text", F.lit("")).alias("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and ``fingerprint`` of every document."""
    return add_fingerprint(bodies(docs), "text", "fingerprint")


def op10_order_minhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    ranges = dealt(bodies(T.table(spark, sf_dir, "documents")), "doc_id", F.xxhash64("text"))
    df = with_next(add_fingerprint(ranges, "text", "fingerprint"), "doc_id", ["text", "fingerprint"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    df = df.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint",
                   edited.alias("_edited"))
    df = df.withColumn("edited_sha256", F.sha2(F.col("_edited"), 256))
    df = add_fingerprint(df, "_edited", "edited_fingerprint")
    return df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                     likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                     likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
