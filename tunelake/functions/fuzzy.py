"""Ratcliff/Obershelp similarity (``difflib.SequenceMatcher.ratio``).

The only per-row Python in the engine. It runs as an Arrow-batched pandas UDF
on *distinct* candidate pairs (genre names, vocabulary x keywords), never on a
fact table. Pairs that cannot reach the cutoff are not even formed: ratio = 2M / (la + lb),
and M is at most the number of letters that both have, repeats counted.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from tunelake.session import spread

LETTERS = 10_000  # numbered letters in the order of rarity, the most that are broadcast
TRIPLED = 16      # longest strings keyed by three letters
PAIRED = 32       # and by two


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(DoubleType())
def fuzzy_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """ratio(a, b); not symmetric: ``a`` is the candidate, ``b`` the query."""
    out = []
    matcher = SequenceMatcher(None)
    last_b = None
    for x, y in zip(a, b):
        if x is None or y is None:
            out.append(None)
            continue
        if y is not last_b:
            matcher.set_seq2(y)  # indexing b is the expensive half; reuse it
            last_b = y
        matcher.set_seq1(x)
        out.append(matcher.ratio())
    return pd.Series(out, dtype="float64")


@F.pandas_udf(StringType())
def py_lower(s: pd.Series) -> pd.Series:
    """Python ``str.lower`` (Java's lower-casing differs on a few code points)."""
    return s.str.lower()


def length_band(length: Column, cutoff: float) -> Column:
    """All partner lengths that can still reach ``cutoff``: an array of ints.

    2 min(la, lb) / (la + lb) >= c  <=>  la c/(2-c) <= lb <= la (2-c)/c.
    The band is widened by one on each side, so no pair that can match is lost.
    """
    if not 0.0 < cutoff <= 1.0:
        raise ValueError("cutoff must be in (0, 1]")
    lo = F.greatest(F.floor(length * F.lit(cutoff / (2.0 - cutoff))) - 1, F.lit(0))
    hi = F.ceil(length * F.lit((2.0 - cutoff) / cutoff)) + 1
    return F.sequence(lo.cast("int"), hi.cast("int"))


def overlap_needed(la: Column, lb: Column, cutoff: float) -> Column:
    """Letters that strings of these lengths must share, repeats counted, to reach ``cutoff``: c (la + lb) / 2,
    rounded up (a little less against rounding errors, so no pair is lost)."""
    return F.greatest(F.ceil((la + lb) * F.lit(cutoff / 2.0) - F.lit(1e-9)), F.lit(0)).cast("int")


def lettered(values: DataFrame, col: str, order: DataFrame | None = None) -> DataFrame:
    """(col, letters): the distinct strings' code points as a set, each numbered by its occurrence
    (``l1``, ``l2`` for a second l), by ``order`` (letter, freq), rarest first, or by letter."""
    one = values.select(F.col(col)).where(F.col(col).isNotNull()).distinct()
    each = one.select(col, F.explode_outer(F.regexp_extract_all(F.col(col), F.lit("(?s)."), F.lit(0))).alias("c"))
    counted = each.groupBy(col, "c").agg(F.count(F.lit(1)).cast("int").alias("k"))
    many = F.when(F.col("c").isNotNull(), F.transform(F.sequence(F.lit(1), F.col("k")), lambda i: F.concat(F.col("c"), i.cast("string"))))
    letters = counted.select(col, F.explode_outer(many).alias("letter"))
    if order is not None:
        letters = letters.join(F.broadcast(order), "letter", "left")
    rank = F.struct(F.coalesce(F.col("freq"), F.lit(0)).alias("freq"), "letter") if order is not None else F.struct("letter")
    listed = F.array_sort(F.collect_list(F.when(F.col("letter").isNotNull(), rank)))
    return letters.groupBy(col).agg(F.transform(listed, lambda x: x["letter"]).alias("letters"))


def letter_frequencies(values: DataFrame, col: str) -> DataFrame:
    """(letter, freq): strings that have each numbered letter; letters beyond LETTERS, the rarest, count as 0."""
    counts = lettered(values, col).select(F.explode("letters").alias("letter")).groupBy("letter").agg(F.count(F.lit(1)).alias("freq"))
    return counts.orderBy(F.desc("freq"), "letter").limit(LETTERS)


def _keys(letters: Column, first: Column, together: Column) -> Column:
    """Join keys from the ``first`` letters: every choice of ``together`` (1, 2 or 3) of them, in their order."""
    head = F.slice(letters, F.lit(1), F.greatest(first, F.lit(0)))
    rest = lambda x, i: F.slice(x, i + 2, F.greatest(F.size(x) - i - 1, F.lit(0)))
    pairs = lambda x: F.flatten(F.transform(x, lambda a, i: F.transform(rest(x, i), lambda b: F.concat(a, F.lit(" "), b))))
    threes = F.flatten(F.transform(head, lambda a, i: F.transform(pairs(rest(head, i)), lambda bc: F.concat(a, F.lit(" "), bc))))
    return F.when(together == 3, threes).when(together == 2, pairs(head)).otherwise(head)


def candidate_pairs(big: DataFrame, small: DataFrame, cutoff: float) -> DataFrame:
    """(_b, _s): pairs of distinct strings whose lengths and letters can still reach ``cutoff``.

    Pairs that reach it share n letters (``overlap_needed``), so of the first l - n + k of either, in one fixed
    order, they share k. Rare letters come first. The key of the equi-join is the length of the big side's
    string with such a choice of k = 3 letters, or as many as must be shared if that is less; strings longer than
    TRIPLED and PAIRED letters, few of a length, choose 2 and 1. What meets is then held to the bound
    on all letters, still in the JVM. Empty strings pair with empty ones only.
    """
    if not 0.0 < cutoff <= 1.0:
        raise ValueError("cutoff must be in (0, 1]")
    order = letter_frequencies(big, "_b").persist()
    b = spread(lettered(big, "_b", order), "_b").withColumn("_len", F.size("letters"))
    s = lettered(small, "_s", order).withColumn("_ls", F.size("letters"))
    least = F.ceil(F.col("_len") * F.lit(cutoff / (2.0 - cutoff)) - F.lit(1e-9))  # of the letters a partner needs
    together = F.when((F.col("_len") <= TRIPLED) & (least >= 3), 3).when((F.col("_len") <= PAIRED) & (least >= 2), 2).otherwise(1)
    head = lambda l, n: l - n + together
    bk = b.where("_len > 0").select("_b", F.col("letters").alias("_bl"), "_len", F.explode(
        _keys(F.col("letters"), head(F.col("_len"), least).cast("int"), together)).alias("_key"))
    sk = s.where("_ls > 0").select("_s", F.col("letters").alias("_sl"), "_ls", F.explode(length_band(F.col("_ls"), cutoff)).alias("_len"))
    need = overlap_needed(F.col("_ls"), F.col("_len"), cutoff)
    sk = sk.where("_len > 0").select("_s", "_sl", "_ls", "_len", F.explode(
        _keys(F.col("_sl"), head(F.col("_ls"), need).cast("int"), together)).alias("_key"))
    met = bk.join(sk, ["_len", "_key"]).where(F.size(F.array_intersect("_bl", "_sl")) >= need).select("_b", "_s").distinct()
    return met.union(b.where("_len = 0").select("_b").join(s.where("_ls = 0").select("_s"), F.col("_b") == F.col("_s")))


def fuzzy_pairs(big: DataFrame, big_col: str, small: DataFrame, small_col: str,
                cutoff: float = 0.8, small_is_a: bool = True) -> DataFrame:
    """Every distinct (big value, small value) pair whose ratio reaches ``cutoff``.

    ``small_is_a`` says which side is ``a`` (the candidate) in ratio(a, b). Only pairs whose
    letters allow it (``candidate_pairs``) reach the Python UDF.
    """
    pairs = candidate_pairs(big.select(F.col(big_col).alias("_b")), small.select(F.col(small_col).alias("_s")), cutoff)
    a, bb = ("_s", "_b") if small_is_a else ("_b", "_s")
    scored = pairs.withColumn("ratio", fuzzy_ratio(F.col(a), F.col(bb)))
    return scored.where(F.col("ratio") >= F.lit(cutoff)).select(
        F.col("_b").alias(big_col), F.col("_s").alias(small_col), "ratio")
