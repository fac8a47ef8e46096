"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements
and one bit per failed rule; a policy is a named, versioned set of rules, and a
verdict, a rule's own effect or the effect of leaving a rule out are bitwise
operations on stored ledgers, without going back to the texts.

All work is per row (no shuffle) except ``ablation``, which is one partial
aggregate. Long texts: repeats are found by sorting window hashes, n log n.

Defined cases: a null or blank text has no words and fails ``few_words``; a null
``doc_id`` and repeated rows give one ledger row each; an empty table gives an
empty ledger; extra input columns are ignored and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.llm import text as T

WINDOW = 5
SYMBOLS = "#*$%&|<>"  # fixed value


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    fails: Callable[[], Column]


def _c(name: str) -> Column:
    return F.col(name)


RULES = [
    Rule("few_words", 0, lambda: _c("n_words") < 10),
    Rule("repeated_windows", 1, lambda: 100 * _c("n_repeat_words") > 20 * _c("n_words")),
    Rule("symbols", 2, lambda: 2 * _c("n_symbols") > _c("n_words")),
    Rule("repeated_lines", 3, lambda: 2 * _c("n_dup_lines") > _c("n_lines")),
    Rule("word_length", 4, lambda: (_c("word_chars") > 20 * _c("n_words")) | (_c("word_chars") < 2 * _c("n_words"))),
    Rule("capitals", 5, lambda: 2 * _c("n_capitals") > _c("word_chars")),
]
POLICIES: dict[str, tuple[str, ...]] = {
    "base.v1": ("few_words", "repeated_windows"),
    "corpus.v1": ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length", "capitals"),
}
BASE, CURRENT = "base.v1", "corpus.v1"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def mask(policy: str | tuple[str, ...], rules: list[Rule] = RULES) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[n] for n in names)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_row`` (the input row) and MEASURES of the whole text."""
    df = T.as_row(docs)
    body = F.coalesce(F.col(f"_row.{text}"), F.lit(""))
    df = df.select("_row", body.alias("_text"), T.words(F.col(f"_row.{text}")).alias("_w"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(T.SPACES)) != "")
    n = F.size("_w")
    window = lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(WINDOW)])
    df = df.select(
        "_row", n.cast("long").alias("n_words"),
        F.length(F.translate("_text", T.SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        lines.alias("_lines"),
        F.transform(T.positions(n - (WINDOW - 1)), window).alias("_h"))
    df = df.select(
        "_row", "n_words", "word_chars", "n_symbols", "n_capitals", "_h",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        (F.size(F.array_distinct("_h")) < F.size("_h")).alias("_some"))
    # only texts with a repeated window sort theirs; neighbours of equal hash are repeats
    df = df.withColumn("_sorted", F.when(F.col("_some"), F.sort_array(
        F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    hit = F.filter("_sorted", lambda x, i: same(x, F.get("_sorted", i - 1)) | same(x, F.get("_sorted", i + 1)))
    df = df.withColumn("_at", F.sort_array(F.transform(hit, lambda x: x["i"])))
    covered = F.transform("_at", lambda p, j: F.coalesce(
        F.least(F.lit(WINDOW), F.get("_at", j + 1) - p), F.lit(WINDOW)).cast("long"))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return df.select("_row", *[F.coalesce(total, F.lit(0).cast("long")).alias(m) if m == "n_repeat_words" else m
                               for m in MEASURES])


def ledger(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``_row``, MEASURES and ``fail_bits``: bit b is set if the rule with bit b fails."""
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(r.fails(), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, text).withColumn("fail_bits", bits)


def passes(policy: str | tuple[str, ...], rules: list[Rule] = RULES) -> Column:
    """Verdict of a policy on a ledger row."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def apply_policy(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Ledger rows plus ``kept`` and the ``policy`` that decided it."""
    return ledger_rows.withColumn("kept", passes(policy)).withColumn("policy", F.lit(policy))


def kept_rows(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Input rows that a policy keeps.

    The row number is a barrier: without it the optimizer would push the filter below the
    measuring steps and compute them anew inside each other.
    """
    rows = apply_policy(ledger_rows, policy).withColumn("_at", F.monotonically_increasing_id())
    return rows.where(F.col("kept") & (F.col("_at") >= 0)).select("_row.*")


def ablation(ledger_rows: DataFrame, policy: str = CURRENT, rules: list[Rule] = RULES) -> DataFrame:
    """Per rule of the policy: documents that fail it, that only it rejects, and
    that would be kept without it. One row per rule, from one aggregate."""
    chosen = [r for r in rules if (mask(policy, rules) >> r.bit) & 1]
    failed = F.col("fail_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long"))
    bit = lambda r: F.lit(1 << r.bit).cast("long")
    sums = ledger_rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(failed == 0).alias("kept"),
        *[F.count_if(failed.bitwiseAND(bit(r)) != 0).alias(f"f_{r.name}") for r in chosen],
        *[F.count_if(failed == bit(r)).alias(f"o_{r.name}") for r in chosen])
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"f_{r.name}").alias("failed"),
                              F.col(f"o_{r.name}").alias("only_this"),
                              (F.col("kept") + F.col(f"o_{r.name}")).alias("kept_without")) for r in chosen])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Ledger of all documents with the base verdict and the current policy's."""
    rows = apply_policy(ledger(T.table(spark, sf_dir, "documents")))
    return rows.select("_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~passes(BASE)).alias("base_failed"), "kept", "fail_bits", "n_lines", "n_capitals")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS win
         FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
dup AS (SELECT r, i FROM wins QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
rep AS (SELECT r, count(DISTINCT i + j) AS n FROM dup, (SELECT unnest([0, 1, 2, 3, 4]) AS j) GROUP BY r),
ln AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
       FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             coalesce(n_lines, 0)::BIGINT AS n_lines,
             length(regexp_replace(text, '[^\p{Lu}]+', '', 'g'))::BIGINT AS n_capitals
      FROM d LEFT JOIN rep USING (r) LEFT JOIN ln USING (r)),
b AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
  + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
  + CASE WHEN 2 * n_symbols > n_words THEN 4 ELSE 0 END
  + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
  + CASE WHEN word_chars > 20 * n_words OR word_chars < 2 * n_words THEN 16 ELSE 0 END
  + CASE WHEN 2 * n_capitals > word_chars THEN 32 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits, n_lines, n_capitals FROM b
"""
