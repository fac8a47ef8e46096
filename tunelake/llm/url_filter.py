"""URL lists as cascades of Bloom filters, exact over the corpus's own keys.

A listed key is a host and a path start, ``example.net/en/``; it fits its host
and all subdomains where the url's path starts with the key's path. A url's
candidate keys are its host suffixes and path starts in the shapes (labels,
path length) that the lists have. Level 1 of a cascade encodes the listed keys;
level 2 the candidate keys of the whole corpus that pass level 1 unlisted;
level 3 the listed keys that pass level 2, and so on until nobody passes
wrongly. The level where a key first misses tells whether it is listed, for
every key of the corpus, so a scan decides all urls with bit tests and no join.

Building: a key is tested against level 1 before it is shuffled, so the distinct
step moves only the candidates that pass (listed ones and about one in a
hundred others), pre-aggregated map-side: a hot host costs one row a task.
Filters travel as one constant array a level, checked against MAX_BITS. Beyond
it (a list or false positives of millions) distinct urls are joined with the list.

Defined cases: a url that is null or has no ``://`` has empty host and path and
fits nothing; repeated rows are judged each; of fitting keys the longest wins
(then the longer host, then the key's order); a key listed both ways is allowed;
empty lists allow everything; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.llm import text as T
from tunelake.session import cut_lineage

BITS_PER_KEY = 10
HASHES = 7
MIN_BITS = 1024
MAX_BITS = 1 << 24      # 2 MB a level
MAX_SHAPES = 10_000     # distinct (labels, path length) pairs of the lists
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The lists of the registered query.
BLOCK = ["net/", "example.com/de/"]
ALLOW = ["example.net/en/", "org/fr/"]


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(h: Column) -> Column:
    return F.when(h == "", 0).otherwise(F.length(h) - F.length(F.replace(h, F.lit("."), F.lit(""))) + 1)


def shapes(listed: DataFrame) -> list[tuple[int, int]]:
    """Distinct (labels, path length) of listed keys."""
    h = F.regexp_extract("key", "^([^/]*)", 1)
    rows = listed.select(_labels(h).alias("a"), (F.length("key") - F.length(h)).alias("b")).distinct() \
        .orderBy("a", "b").limit(MAX_SHAPES + 1).collect()
    if len(rows) > MAX_SHAPES:
        raise ValueError(f"more than {MAX_SHAPES} shapes of listed keys")
    return [(r["a"], r["b"]) for r in rows]


def candidates(h: Column, p: Column, forms: list[tuple[int, int]]) -> Column:
    """Keys that could fit, longest first."""
    if not forms:
        return F.array().cast("array<string>")
    all_ = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in forms])
    fits = F.filter(all_, lambda s: (s["a"] <= _labels(h)) & (s["b"] <= F.length(p)))
    made = F.transform(fits, lambda s: _key(h, p, s["a"], s["b"]))
    return F.transform(F.sort_array(made), lambda s: s["key"])


def _key(h: Column, p: Column, labels: Column, length: Column) -> Column:
    parts = F.split(h, r"\.")
    suffix = F.array_join(F.slice(parts, F.size(parts) - labels + 1, labels), ".")
    k = F.concat(suffix, F.substring(p, F.lit(1), length))
    return F.struct((-F.length(k)).alias("n"), (-F.length(suffix)).alias("h"), k.alias("key"))


class TooLong(Exception):
    """A level would pass the size that a scan may carry."""


class Level:
    """One Bloom filter: its words, at most MAX_BITS / 64, as a constant array."""

    def __init__(self, keys: DataFrame, n: int, level: int, max_bits: int):
        self.level, self.bits = level, max(MIN_BITS, 64 * -(-n * BITS_PER_KEY // 64))
        if self.bits > max_bits:
            raise TooLong
        at = F.explode(F.array(*[self._at(F.col("key"), j) for j in range(HASHES)]))
        set_bits = keys.select(at.alias("at")).select(
            F.floor(F.col("at") / 64).cast("int").alias("w"), (F.col("at") % 64).cast("int").alias("b"))
        found = dict(set_bits.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)"))).collect())
        told = ",".join(str(found.get(i, 0)) for i in range(self.bits // 64))
        self.array = F.split(F.lit(told), ",").cast("array<bigint>")  # folded to one literal

    def _at(self, key: Column, j: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.level), F.lit(j)), F.lit(self.bits).cast("long"))

    def passes(self, key: Column) -> Column:
        hit = F.lit(True)
        for j in range(HASHES):
            at = self._at(key, j)
            word = F.get(self.array, F.floor(at / 64).cast("int"))
            hit = hit & (F.getbit(word, (at % 64).cast("int")) == 1)
        return hit


class Cascade:
    """Exact membership of ``listed`` (column key) for every key of ``universe``."""

    def __init__(self, listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS):
        listed = cut_lineage(listed.select("key").where(F.col("key").isNotNull()).distinct())
        n = listed.count()
        self.levels: list[Level] = []
        if not n:
            return
        self.levels.append(Level(listed, n, 1, max_bits))
        passing = universe.where(self.levels[0].passes(F.col("key"))).distinct()
        mine, other = listed, cut_lineage(passing.join(listed, "key", "left_anti"))
        while (n := other.count()):
            level = Level(other, n, len(self.levels) + 1, max_bits)
            self.levels.append(level)
            mine, other = other, cut_lineage(mine.where(level.passes(F.col("key"))))

    def has(self, key: Column) -> Column:
        """True if ``key`` is listed: it first misses an even level, or passes an odd number of levels in all."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[i].passes(key), out).otherwise(F.lit(i % 2 == 1))
        return out


def judge(pages: DataFrame, block: DataFrame, allow: DataFrame, default: str = "allow",
          max_bits: int = MAX_BITS) -> DataFrame:
    """``_row``, host, path, ``rule`` (the key that decides, or null) and ``verdict`` of every url."""
    both = block.select("key").union(allow.select("key"))
    forms = shapes(both)
    df = T.as_row(pages)
    url = F.col("_row.url")
    df = df.select("_row", host(url).alias("host"), path(url).alias("path"))
    df = df.withColumn("_keys", candidates(F.col("host"), F.col("path"), forms))
    universe = df.select(F.explode("_keys").alias("key"))
    try:
        blocked, allowed = Cascade(block, universe, max_bits), Cascade(allow, universe, max_bits)
    except TooLong:
        return _judge_by_join(df, block, allow, default)
    df = df.withColumn("rule", F.get(F.filter("_keys", lambda k: blocked.has(k) | allowed.has(k)), 0))
    verdict = F.when(F.col("rule").isNull(), default).when(allowed.has(F.col("rule")), "allow").otherwise("block")
    return df.select("_row", "host", "path", "rule", verdict.alias("verdict"))


def _judge_by_join(df: DataFrame, block: DataFrame, allow: DataFrame, default: str) -> DataFrame:
    listed = block.select("key", F.lit(1).alias("_b")).union(allow.select("key", F.lit(0).alias("_b")))
    listed = listed.groupBy("key").agg(F.min("_b").alias("_b"))
    each = df.select("host", "path", "_keys").distinct().select("host", "path", F.posexplode("_keys").alias("_n", "key"))
    best = each.join(listed, "key").groupBy("host", "path").agg(F.min(F.struct("_n", "key", "_b")).alias("_r"))
    out = df.join(best, ["host", "path"], "left")
    verdict = F.when(F.col("_r").isNull(), default).when(F.col("_r._b") == 0, "allow").otherwise("block")
    return out.select("_row", "host", "path", F.col("_r.key").alias("rule"), verdict.alias("verdict"))


def keys(spark, items: list[str]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in items], "key string")


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    out = judge(T.table(spark, sf_dir, "pages"), keys(spark, BLOCK), keys(spark, ALLOW))
    return out.select("_row.page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1) AS h0,
                  regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
h AS (SELECT page_id, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
r AS (SELECT *, CASE
  WHEN '.' || host LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN '.' || host LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN '.' || host LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN '.' || host LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
