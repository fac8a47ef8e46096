"""Personal data by bootstrapped contextual extraction.

Base entities (email, ip, card, phone) are found by their formats. They are the
seeds: the words before a seed are a lexical pattern, and patterns and the
identifiers in their slots form a bipartite graph. Rounds of two joins score it:
a pattern by the share of known instances among all it extracts, an instance by
the mean score of its patterns. A fifth kind, secrets, has no format of its own: its seeds are long
tokens of letters and digits to which a name is given (``name = "..."``), and its patterns and
instances are scored like the others. Patterns above MIN_PRECISION with MIN_SUPPORT
known instances are trusted; instances they score at MIN_SCORE or more join the
known ones of the next round, and in the end are spans of their kind wherever they
stand, next to the base spans, which always stay.

Everything is DataFrame expressions. Positions are code points: ``split`` by the
same pattern gives the gaps between matches, and a two-level running sum the
offsets, so long texts with many matches stay near linear. Patterns are possessive
or anchored, so no run of characters is read twice. Texts are read once; a table
of spans and slots, without texts, goes to the shared scratch folder. Edges are
pre-aggregated to distinct (pattern, instance) pairs before they are joined, so a
context with a third of all slots costs its distinct instances; joins by key are
left to the planner, which splits skewed keys.

Defined cases: null text is empty and has no spans; repeated rows and null
doc_ids are rows like others; equal starts of different kinds all stay; an empty
table gives no rows; extra columns are ignored and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm import text as T
from tunelake.session import cut_lineage, scratch_path

KINDS = ["email", "ip", "card", "phone"]
SECRET = len(KINDS)  # the kind of secrets, which have seeds but no base entities
NAMES = [*KINDS, "secret"]
# The formats. Possessive or anchored where that finds the same matches in one pass.
FORMATS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a card has 16 digits at least: shorter runs are never matches, so they needn't be listed
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
SLOT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
CONTEXT = 80        # characters before a slot in which its context words are looked for
CONTEXT_WORDS = 2
ROUNDS = 3
MIN_SUPPORT = 2
MIN_PRECISION = 0.5
MIN_SCORE = 0.5
MIN_LENGTH, MIN_DIGITS = 6, 4  # of a discovered identifier
# A seed of a secret: a token of 20 characters or more, letters and digits, that a name is given to.
SECRET_SEED = r"^(?=.*[a-z])(?=(?:[^0-9]*[0-9]){4})[0-9a-z_+-]{20,}$"
GIVEN = r"[=:]\|$|\|.*[=:]$"
SECRET_LENGTH = 16   # of a discovered one, with a letter


def running(values: Column, zero: Column) -> Column:
    """Sums of the values before each position, in blocks of about the root of the length."""
    n = F.size(values)
    step = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
    blocks = F.transform(T.positions(F.ceil(n / step).cast("int")), lambda b: F.slice(values, b * step + 1, step))
    grow = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
    inner = F.transform(blocks, lambda b: F.aggregate(b, F.array(zero), grow))
    start = F.aggregate(F.transform(inner, lambda b: F.element_at(b, -1)), F.array(zero), grow)
    start = F.slice(start, 1, F.size(inner))
    # both arrays are arguments, not inside a lambda: each is computed once a row
    return F.flatten(F.zip_with(inner, start, lambda b, s: F.transform(F.slice(b, 1, F.size(b) - 1), lambda x: x + s)))


def _luhn(match: Column) -> Column:
    digits = F.reverse(F.regexp_replace(match, "[^0-9]", ""))
    at = lambda i: F.substring(digits, i + 1, F.lit(1)).cast("int")
    twice = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    total = F.aggregate(T.positions(F.length(digits)), F.lit(0),
                        lambda s, i: s + F.when(i % 2 == 1, twice(at(i))).otherwise(at(i)))
    n = F.length(digits)
    return F.when((n >= 16) & (n <= 19), total % 10 == 0).otherwise(False)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$")
    if kind == "card":
        return _luhn(match)
    if kind == "phone":
        n = F.length(F.regexp_replace(match, "[^0-9]", ""))
        return (n >= 8) & (n <= 15)
    return F.lit(True)


def _located(df: DataFrame, pattern: str, hint: str, out: str) -> DataFrame:
    """``out``: array of (start, end, match, gap before it) of ``pattern`` in ``_text``."""
    keep = df.columns
    none = F.array().cast("array<string>")
    found = F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
    df = df.withColumn("_m", F.when(F.contains("_text", F.lit(hint)), found).otherwise(none) if hint else found)
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split("_text", pattern, -1)).otherwise(none))
    each = F.transform("_m", lambda m, i: (F.length(m) + F.length(F.get("_g", i))).cast("long"))
    df = df.withColumn("_c", each).withColumn("_s", running(F.col("_c"), F.lit(0).cast("long")))
    spans = F.transform("_m", lambda m, i: F.struct(
        (F.get("_s", i) + F.length(F.get("_g", i))).alias("start"), (F.get("_s", i) + F.get("_c", i)).alias("end"),
        m.alias("match"), F.get("_g", i).alias("gap")))
    return df.select(*keep, spans.alias(out))


def _of_kind(found: Column, k: int, kind: str) -> Column:
    good = F.filter(found, lambda s: _valid(kind, s["match"]))
    return F.transform(good, lambda s: F.struct(F.lit(k).alias("k"), s["start"].alias("start"), s["end"].alias("end"),
                                              F.xxhash64(s["match"]).alias("h")))


def base_spans(df: DataFrame) -> DataFrame:
    """``df`` (with ``_text``) plus ``_base``: (k, start, end, hash) of all base entities in order of kind and start."""
    names = []
    keep = df.columns
    for k, kind in enumerate(KINDS):
        hint = {"email": "@", "phone": "+", "ip": "."}.get(kind, "")
        df = _located(df, FORMATS[kind], hint, f"_{kind}")
        names.append(_of_kind(F.col(f"_{kind}"), k, kind))
    return df.select(*keep, F.concat(*names).alias("_base"))


def _slots(df: DataFrame) -> DataFrame:
    """``df`` plus ``_slots``: tokens with a digit or an at sign, and the words before them ("|" without any)."""
    keep = df.columns
    df = _located(df, SLOT, "", "_tokens")

    def slot(t: Column) -> Column:
        lead = F.regexp_extract(t["match"], r"^(?:[^0-9@]*[=:])?[^\p{L}\p{N}]*", 0)
        core = F.regexp_replace(F.substring(t["match"], F.length(lead) + 1, F.length(t["match"])), r"[^\p{L}\p{N}]+$", "")
        near = F.split(F.btrim(F.lower(F.right(t["gap"], F.lit(CONTEXT))), F.lit(T.SPACES)), T.GAP)
        near = F.slice(near, F.greatest(F.size(near) - CONTEXT_WORDS + 1, F.lit(1)), CONTEXT_WORDS)
        name = F.regexp_extract(t["match"], "^[^0-9@]*[=:]", 0)
        context = F.translate(F.concat(F.array_join(near, " "), F.lit("|"), F.lower(name)), "012345678", "999999999")
        a = t["start"] + F.length(lead)
        return F.struct(t["start"].alias("at"), a.alias("start"), (a + F.length(core)).alias("end"),
                        F.lower(core).alias("inst"), context.alias("ctx"))
    slots = F.filter(F.transform("_tokens", slot), lambda s: s["end"] > s["start"])
    return df.select(*keep, slots.alias("_slots"))


def _fits(kind: Column, inst: Column) -> Column:
    digits = F.length(inst) - F.length(F.translate(inst, "0123456789", ""))
    numbered = (digits >= MIN_DIGITS) & ~F.contains(inst, F.lit("@"))
    mixed = numbered & (F.length(inst) >= SECRET_LENGTH) & inst.rlike(r"^[0-9a-z_+-]*[a-z][0-9a-z_+-]*$")
    return (F.length(inst) >= MIN_LENGTH) & F.when(kind == 0, F.contains(inst, F.lit("@"))).when(kind == SECRET, mixed).otherwise(numbered)


def _free_slots(found: DataFrame) -> DataFrame:
    """Slots as rows: rid, start, end, inst, ctx and ``kind``, the kind of a base entity that begins in
    the slot and then is its instance, or that of a secret's seed; slots inside an earlier entity are left out."""
    cols = "rid long, pos long, kind int, upto long, h long, start long, end long, inst string, ctx string"
    names = [c.split()[0] for c in cols.split(", ")]
    null = lambda t: F.lit(None).cast(t)
    with_slots = found.where(F.size("_slots") > 0)
    a = with_slots.select("rid", F.explode("_slots").alias("s")).select(
        "rid", F.col("s.at").alias("pos"), null("int").alias("kind"), null("long").alias("upto"), null("long").alias("h"),
        *[F.col(f"s.{c}") for c in ("start", "end", "inst", "ctx")])
    b = with_slots.select("rid", F.explode("_base").alias("s")).select(
        "rid", F.col("s.start").alias("pos"), F.col("s.k").alias("kind"), F.col("s.end").alias("upto"), F.col("s.h").alias("h"),
        *[null(t).alias(c) for c, t in (("start", "long"), ("end", "long"), ("inst", "string"), ("ctx", "string"))])
    rows = a.select(*names).union(b.select(*names))
    # one document's slots and entities in text order, a slot before an entity at the same place
    w = Window.partitionBy("rid")
    before = w.orderBy("pos", F.col("kind").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    after = w.orderBy(F.desc("pos"), F.col("kind").isNull(), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    entity = F.when(F.col("kind").isNotNull(), F.struct("pos", "kind", "h"))
    rows = rows.withColumn("_cover", F.max("upto").over(before)).withColumn("_next", F.last(entity, ignorenulls=True).over(after))
    slots = rows.where(F.col("inst").isNotNull() & (F.coalesce("_cover", F.lit(-1)) <= F.col("pos")))
    seed = F.col("_next.pos") < F.col("end")
    inst = F.when(seed, F.concat(F.lit("seed "), F.col("_next.h").cast("string"))).otherwise(F.col("inst"))
    secret = F.col("inst").rlike(SECRET_SEED) & F.col("ctx").rlike(GIVEN)
    kind = F.when(seed, F.col("_next.kind")).when(secret, SECRET)
    return slots.select("rid", "start", "end", inst.alias("inst"), "ctx", kind.alias("kind"))


def score_graph(slots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trusted patterns (ctx, kind, conf) and discovered instances (inst, kind, score) after ROUNDS."""
    # a slot without words before it says nothing about its instance, but may hold an accepted one
    edges = cut_lineage(slots.where(F.col("ctx") != "|").groupBy("ctx", "inst").agg(F.max("kind").alias("seed")))
    size = edges.groupBy("ctx").agg(F.count(F.lit(1)).alias("n"))
    links = edges.groupBy("inst").agg(F.count(F.lit(1)).alias("n_ctx"))
    seeds = edges.where(F.col("seed").isNotNull()).groupBy("inst").agg(F.max("seed").alias("kind")).withColumn("score", F.lit(1.0))
    known, patterns = seeds, None
    for _ in range(ROUNDS):
        pos = edges.join(known, "inst").groupBy("ctx", "kind").agg(F.sum("score").alias("pos"))
        conf = F.col("pos") / F.col("n") * (F.col("pos") / (F.col("pos") + 1))
        patterns = cut_lineage(pos.join(size, "ctx").withColumn("conf", conf).where(
            (F.col("pos") >= MIN_SUPPORT) & (F.col("pos") >= MIN_PRECISION * F.col("n"))).select("ctx", "kind", "conf"))
        new = edges.where(F.col("seed").isNull()).join(patterns, "ctx").where(_fits(F.col("kind"), F.col("inst")))
        new = new.groupBy("inst", "kind").agg(F.sum("conf").alias("sum")).join(links, "inst")
        new = new.select("inst", F.struct((F.col("sum") / F.col("n_ctx")).alias("score"), (-F.col("kind")).alias("k")).alias("b"))
        new = new.groupBy("inst").agg(F.max("b").alias("b")).where(F.col("b.score") >= MIN_SCORE)
        new = cut_lineage(new.select("inst", (-F.col("b.k")).cast("int").alias("kind"), F.col("b.score").alias("score")))
        known = seeds.unionByName(new.join(seeds, "inst", "left_anti"))
    return patterns, new


def find_pii(docs: DataFrame, keep_row: bool = False) -> DataFrame:
    """rid, doc_id, ``base`` and ``spans`` (arrays of (k, start, end) by kind and start, secrets among
    the spans) of every row; ``_row`` on request."""
    spark = docs.sparkSession
    df = T.as_row(docs).select("_row", F.coalesce("_row.text", F.lit("")).alias("_text"))
    df = _slots(base_spans(df)).select(
        F.monotonically_increasing_id().alias("rid"), F.col("_row.doc_id").alias("doc_id"),
        F.sort_array("_base").alias("_base"), "_slots", *(["_row"] if keep_row else []))
    at = scratch_path(spark, "spans")
    df.write.parquet(at)  # fixes rid
    found = spark.read.parquet(at)
    slots = cut_lineage(_free_slots(found))
    _, new = score_graph(slots)
    # every free slot of an accepted instance or a secret's seed, whatever its context
    seeds = slots.where(F.col("kind") == SECRET).select("inst", "kind").distinct()
    accepted = seeds.unionByName(new.drop("score").join(seeds, "inst", "left_anti"))
    hits = slots.where(F.col("kind").isNull() | (F.col("kind") == SECRET)).drop("kind").join(accepted, "inst")
    mine = hits.groupBy("rid").agg(F.collect_set(F.struct(F.col("kind").alias("k"), "start", "end")).alias("_new"))
    bare = F.transform("_base", lambda s: F.struct(s["k"].alias("k"), s["start"].alias("start"), s["end"].alias("end")))
    spans = F.sort_array(F.concat(bare, F.coalesce("_new", F.array().cast("array<struct<k:int,start:bigint,end:bigint>>"))))
    out = found.drop("_slots").join(mine, "rid", "left")
    return out.select("rid", "doc_id", bare.alias("base"), spans.alias("spans"), *(["_row"] if keep_row else []))


def told(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in NAMES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, n_chars: str = "n_chars") -> DataFrame:
    """Input rows with every span replaced by its kind in brackets; ``n_chars`` follows the text."""
    found = find_pii(docs, keep_row=True)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in NAMES])
    by_place = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["k"])))
    # overlapping spans become one, named after the first
    merged = F.aggregate(by_place, F.filter(by_place, lambda s: F.lit(False)), lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] < F.element_at(acc, -1)["end"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"), F.greatest(s["end"], F.element_at(acc, -1)["end"]).alias("end"),
            F.element_at(acc, -1)["k"].alias("k"))))).otherwise(F.concat(acc, F.array(s))))
    df = found.select("_row", merged.alias("_m"), F.when(F.size("spans") > 0, F.split("_row.text", "")).alias("_chars"))
    piece = lambda a, b: F.array_join(F.slice("_chars", (a + 1).cast("int"), (b - a).cast("int")), "")
    prev = lambda i: F.coalesce(F.get("_m", i - 1)["end"], F.lit(0).cast("long"))
    parts = F.transform("_m", lambda s, i: F.concat(piece(prev(i), s["start"]), F.get(names, s["k"])))
    tail = piece(prev(F.size("_m")), F.size("_chars").cast("long"))
    text = F.when(F.size("_m") > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(F.col("_row.text"))
    new = F.col("_row").withField("text", text)
    if n_chars in docs.columns:
        length = F.when(F.size("_m") > 0, F.length(text).cast(docs.schema[n_chars].dataType)).otherwise(F.col(f"_row.{n_chars}"))
        new = new.withField(n_chars, length)
    return df.select(new.alias("_row")).select("_row.*")


def op5_pii(spark, sf_dir: str) -> DataFrame:
    """Spans of personal data in all documents; secrets in columns of their own."""
    found = find_pii(T.table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["k"] == k)).cast("long")
    n = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    personal = F.filter("spans", lambda s: s["k"] != SECRET)
    secrets = F.filter("spans", lambda s: s["k"] == SECRET)
    return found.select("doc_id", *n, F.sha2(told(F.col("base")), 256).alias("base_sha256"), told(personal).alias("spans"),
                        F.size(secrets).cast("long").alias("n_secret"), told(secrets).alias("secret_spans"),
                        F.size("spans").cast("long").alias("n_found"))
