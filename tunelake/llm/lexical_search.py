"""Ranked lexical search: MaxScore whose bounds are those of pairs of terms.

One scan counts, in every whole text, its terms and the terms the queries ask for, and stores
them as a forward index (a row a document); document frequencies, the number of documents and
their length follow from it. Weights fix every impact (what one occurrence count of a term adds
to a score), in 64-bit integers.

The index is searched in shards of SHARD_DOCS documents: a task turns a shard into postings by
term. A query's distinct terms are put in the order of falling weight, and each makes a pair with the
next. For each pair the shard's intersection list is made before any query runs, and its joint maximum
kept: the most that a document with both terms gets. A pair adds at most the greatest of that and the
terms' own maxima, less than their sum where the terms rarely meet. For what terms i and later can add,
a query combines pair bounds and single maxima to the least sum. While that could lift an unseen document to the
k-th best score, postings are added up; from there on only documents already seen whose score
plus the rest of the bounds reaches it are looked up in what is left. The k-th best score of a
query holds on from shard to shard of a task. Documents on a par with it stay, so nothing is lost.

Scale: shards are dealt by documents, not by terms, so a common term has no task of its own;
a task returns k rows a query at most, and a window with a group limit joins them. Queries go in
blocks of ITEM_BLOCK rows and about ITEM_CHARS characters, bounds of what tasks receive.

Defined cases: a null or blank text has no term (no such document is found or counted; such an item
has no rows); a term repeated in an item counts as often; documents of equal score by ascending
doc_id, null last; every row is a document of its own; equal rows of items are answered once; an
empty table gives no rows; extra columns are ignored; doc_id is an integer.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm import text as T
from tunelake.session import scratch_path

K = 20
SHARD_DOCS = 20_000
ITEM_BLOCK = 2_000
ITEM_CHARS = 2_000_000

# Terms are runs of ASCII letters, digits and whatever isn't ASCII; all other bytes end them.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def _count(known: dict[bytes, int]):
    """(doc, none, n, terms, tfs): a text's number of terms, and those of ``known`` with their counts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = terms(text)
                c = Counter(map(known.get, found))
                c.pop(None, None)
                rows.append((len(found), np.fromiter(c, np.int32, len(c)).tobytes(), np.fromiter(c.values(), np.int32, len(c)).tobytes()))
            yield pd.DataFrame(rows, columns=["n", "terms", "tfs"]).assign(doc=batch["doc"].to_numpy(), none=batch["none"].to_numpy())
    return run


def _frequencies(size: int):
    """Documents by term; term -1: documents with a term, and all their terms as ``length``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            df = np.bincount(np.frombuffer(b"".join(batch["terms"]), np.int32), minlength=size)
            at = np.flatnonzero(df)
            yield pd.DataFrame({"term": np.r_[-1, at], "df": np.r_[(batch["n"] > 0).sum(), df[at]],
                                "length": np.r_[batch["n"].sum(), np.zeros(len(at), np.int64)].astype(np.int64)})
    return run


class Query:
    """An item's distinct terms (term, count) by falling weight, and its pairs: each term with the next."""

    def __init__(self, counts: Counter, weight: np.ndarray):
        order = sorted((t for t in counts if weight[t] > 0), key=lambda t: (-weight[t] * counts[t], t))
        self.terms = [(t, counts[t]) for t in order]
        self.pairs = list(zip(self.terms, self.terms[1:]))


class Shard:
    """Postings of some documents: for each term ascending documents and their impacts."""

    def __init__(self, n: np.ndarray, term_lists: list[bytes], tf_lists: list[bytes], weight: np.ndarray, total: int, length: int):
        t = np.frombuffer(b"".join(term_lists), np.int32)
        tf = np.frombuffer(b"".join(tf_lists), np.int32).astype(np.int64)
        doc = np.repeat(np.arange(len(n)), [len(x) // 4 for x in term_lists])
        m = 100 - 25 + (25 * n.astype(np.int64) * total) // max(length, 1)
        impact = weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        some = impact > 0
        t, doc, impact = t[some], doc[some], impact[some]
        order = np.argsort(t, kind="stable")
        t, self.doc, self.impact = t[order], doc[order], impact[order]
        self.at = np.searchsorted(t, np.arange(len(weight) + 1))
        self.size = len(n)
        self.most = np.zeros(len(weight), np.int64)
        np.maximum.at(self.most, t, self.impact)
        self.bounds = {}

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.at[term], self.at[term + 1])
        return self.doc[part], self.impact[part]

    def prepare(self, pairs: set[tuple]) -> None:
        """Intersection lists of the pairs, and from their joint maxima the most that a document gets of each."""
        for pair in pairs:
            own = [c * int(self.most[t]) for t, c in pair]
            joint = int(self.intersection(pair)[1].max(initial=0)) if min(own) else 0
            self.bounds[pair] = max(joint, *own)

    def intersection(self, pair: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Documents with both terms, and what both add to their scores."""
        (a, ca), (b, cb) = pair
        if self.at[a + 1] - self.at[a] > self.at[b + 1] - self.at[b]:
            (a, ca), (b, cb) = (b, cb), (a, ca)
        (da, ia), (db, ib) = self.postings(a), self.postings(b)
        at = np.minimum(np.searchsorted(db, da), len(db) - 1)
        both = db[at] == da
        return da[both], ca * ia[both] + cb * ib[at[both]]

    def rest(self, query: Query) -> list[int]:
        """The most that a document can get from the i-th and all later terms, for every i: a term adds its own
        maximum or, with the next one, the pair's bound; the least sum of all such divisions."""
        out = [0] * (len(query.terms) + 1)
        for i in range(len(query.terms) - 1, -1, -1):
            t, c = query.terms[i]
            out[i] = c * int(self.most[t]) + out[i + 1]
            if i < len(query.pairs):
                out[i] = min(out[i], self.bounds[query.pairs[i]] + out[i + 2])
        return out

    def search(self, query: Query, k: int, reached: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores that may be among the ``k`` best, given that k others have ``reached``
        or more; and the number of scores looked up or added."""
        rest = self.rest(query)
        score, work, i = np.zeros(self.size, np.int64), 0, 0
        while rest[i] and rest[i] >= reached:
            t, c = query.terms[i]
            doc, impact = self.postings(t)
            score[doc] += c * impact
            work += len(doc)
            i += 1
            if self.size >= k:
                reached = max(reached, int(np.partition(score, self.size - k)[self.size - k]))
        doc = np.flatnonzero((score > 0) & (score + rest[i] >= reached))
        for j in range(i, len(query.terms)):
            t, c = query.terms[j]
            own, impact = self.postings(t)
            work += min(len(own), len(doc))
            if len(own) <= len(doc):
                score[own] += c * impact
            else:
                at = np.minimum(np.searchsorted(own, doc), len(own) - 1)
                score[doc] += np.where(own[at] == doc, c * impact[at], 0)
            if len(doc) > k:
                reached = max(reached, int(np.partition(score[doc], len(doc) - k)[len(doc) - k]))
            doc = doc[score[doc] + rest[j + 1] >= reached]
        return doc, score[doc], work


def _best(score: np.ndarray, none: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((doc, none, -score))[:k]


def _searched(queries: list[Query], weight: np.ndarray, total: int, length: int, k: int):
    """The ``k`` best documents of each query among a task's."""
    pairs = {p for q in queries for p in q.pairs}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        empty = np.empty(0, np.int64)
        best = [(empty, empty, empty)] * len(queries)
        for batch in batches:
            for a in range(0, len(batch), SHARD_DOCS):
                part = batch.iloc[a:a + SHARD_DOCS]
                shard = Shard(part["n"].to_numpy(), part["terms"].tolist(), part["tfs"].tolist(), weight, total, length)
                shard.prepare(pairs)
                ids, nones = part["doc"].to_numpy(), part["none"].to_numpy().astype(np.int64)
                for i, query in enumerate(queries):
                    s, none, doc = best[i]
                    at, score, _ = shard.search(query, k, int(s[k - 1]) if len(s) == k else 1)
                    if len(at):
                        s, none, doc = np.r_[s, score], np.r_[none, nones[at]], np.r_[doc, ids[at]]
                        top = _best(s, none, doc, k)
                        best[i] = s[top], none[top], doc[top]
        for i, (s, none, doc) in enumerate(best):
            if len(s):
                yield pd.DataFrame({"item": i, "doc": doc, "none": none.astype(bool), "score": s})
    return run


def _blocks(items: DataFrame) -> list[DataFrame]:
    """Distinct items (item_id, text) in blocks of bounded size, by hash."""
    rows = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    n, chars = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = max(-(-n // ITEM_BLOCK), -(-chars // ITEM_CHARS), 1)
    if parts == 1:
        return [rows]
    return [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p) for p in range(parts)]


def _answer(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The answers of one block of items."""
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    asked = items.collect()  # a block's bound
    found = [Counter(terms(r["text"])) for r in asked]
    known = {t: i for i, t in enumerate(sorted(set().union(*found)))}
    at = scratch_path(spark, "forward-index")
    doc = F.col("doc_id").cast("long")
    told = docs.select(F.coalesce(doc, F.lit(0)).alias("doc"), doc.isNull().alias("none"), F.col("text").cast("string").alias("text"))
    told.mapInPandas(_count(known), "doc long, none boolean, n long, terms binary, tfs binary").write.parquet(at)
    index = spark.read.parquet(at)
    df, total, length = np.zeros(len(known), np.int64), 0, 0
    for r in index.select("n", "terms").mapInPandas(_frequencies(len(known)), "term int, df long, length long").groupBy("term").agg(
            F.sum("df").alias("df"), F.sum("length").alias("length")).collect():  # a row a known term
        if r["term"] < 0:
            total, length = r["df"], r["length"]
        else:
            df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    queries = [Query(Counter({known[t]: c for t, c in f.items()}), weight) for f in found]
    best = index.mapInPandas(_searched(queries, weight, total, length, k), "item int, doc long, none boolean, score long")
    best = best.select("item", F.when(~F.col("none"), F.col("doc")).alias("doc_id"), "score")
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(asked)], f"item int, item_id {kind}")
    return best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 of every item."""
    if k <= 0:
        raise ValueError("k must be positive")
    out = None
    for block in _blocks(items):
        found = _answer(docs, block, k)
        out = found if out is None else out.unionByName(found)
    return out


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return search(T.table(spark, sf_dir, "documents"), T.table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark),
q AS (SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM b),
qt AS (SELECT item_id, text, t, count(*) AS c FROM q GROUP BY ALL),
s AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) x WHERE t IN (SELECT t FROM qt) GROUP BY r, t),
f AS (SELECT t, floor(1000 * ln((2 * any_value(s.n) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM p, s GROUP BY t),
m AS (SELECT r, doc_id, 100 - 25 + (25 * len(w)::BIGINT * s.n) // s.l AS m FROM d, s WHERE len(w) > 0),
z AS (SELECT qt.item_id, qt.text, r, doc_id, sum(qt.c * f.weight * ((1000000000 * tf::BIGINT) // (1000 * tf::BIGINT + 12 * m.m)))::BIGINT AS score
      FROM p JOIN f USING (t) JOIN m USING (r) JOIN qt USING (t) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM z WHERE score > 0 QUALIFY rank <= 20
"""
