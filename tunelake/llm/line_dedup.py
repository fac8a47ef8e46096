"""Lines that recur across documents, suspected by two Bloom filters and confirmed exactly.

A line's key is the line stripped of white space with A-Z lower-cased. One scan writes the
digests of each document's distinct keys (16 bytes a key). A filter has segments of
SEGMENT_BITS bits, KEY_BITS bits a key; a key's hash names its segment. Each segment meets
the hashes of its keys batch by batch, those of a batch counted once: what the filter of
once-seen hashes knows already, or a batch has twice, goes to the filter of twice-seen ones.
No key of two documents is missing there; a key of one document is there by chance only.

Only the filter of twice-seen hashes travels: ROUND_SEGMENTS segments (32 MB) at most, the
bound of the driver's copy and of the broadcast. More segments take more rounds, each over
its own slice of the keys (the table of digests is stored by round), so the work stays linear.
Keys that pass are the suspects. They alone are shuffled: counted by their whole digest, with
map-side combine, and those of ``min_docs`` documents or more are joined back to their
documents; there the lines go, or with ``keep_first`` all but the first occurrence
(in the document with the smallest doc_id, its first line).

Keys are told apart by 128-bit digests. Tables between passes go to the shared scratch folder.

Defined cases: a null or empty text is one empty line; keys shorter than ``min_chars`` code points
(empty ones always) never go; every row is a document of its own, so a repeated row counts again, and
rows equal in doc_id and text get equal results (with ``keep_first`` they keep the same lines); a null
doc_id comes after all others; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.llm import text as T
from tunelake.session import scratch_path

MIN_DOCS = 10
MIN_CHARS = 1
KEY_BITS = 10
SEGMENT_BITS = 1 << 20
ROUND_SEGMENTS = 256        # of 128 KB: bounds the driver's copy and the broadcast
BLOCK = 1 << 15             # hashes that enter the filters at once
BROADCAST_KEYS = 500_000    # of 16 bytes


def line_key(line: bytes) -> bytes:
    """The stripped line, A-Z lower-cased (white space and case of bytes are ASCII's)."""
    return line.strip().lower()


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def _digest(key: bytes, min_chars: int) -> bytes | None:
    import xxhash

    if not key or (min_chars > 1 and len(key.decode("utf-8", "surrogatepass")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _digests(min_chars: int, segments: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 1000):
                part, rows = batch.iloc[a:a + 1000], []
                for doc, mark, text in zip(part["id"], part["mark"], part["text"], strict=True):
                    found = {_digest(k, min_chars) for k in set(map(line_key, _lines(text)))} - {None}
                    if not found:
                        continue
                    keys = np.frombuffer(b"".join(found), np.uint64).reshape(-1, 2)
                    of = _segment(keys[:, 0], segments) // ROUND_SEGMENTS
                    rows += [(doc, mark, int(r), keys[of == r].tobytes()) for r in np.unique(of)]
                yield pd.DataFrame(rows, columns=["id", "mark", "round", "keys"])
    return run


def _segment(hashes: np.ndarray, segments: int) -> np.ndarray:
    return (hashes % np.uint64(segments)).astype(np.int64)


def _probes(hashes: np.ndarray) -> np.ndarray:
    """Three bits of each hash within its segment."""
    h = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    mask = np.uint64(SEGMENT_BITS - 1)
    return np.stack([h & mask, (h >> np.uint64(20)) & mask, (h >> np.uint64(40)) & mask]).astype(np.int64)


def _by_segment(segments: int):
    """Per batch and segment: hashes of one document, and of two or more, of the batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes, count = np.unique(np.frombuffer(b"".join(batch["keys"]), np.uint64)[::2], return_counts=True)
            of = _segment(hashes, segments)
            order = np.argsort(of, kind="stable")
            hashes, count, of = hashes[order], count[order], of[order]
            at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
            rows = [(int(of[a]), hashes[a:z][count[a:z] == 1].tobytes(), hashes[a:z][count[a:z] > 1].tobytes())
                    for a, z in zip(at, np.r_[at[1:], len(of)], strict=True)]
            yield pd.DataFrame(rows, columns=["segment", "one", "many"])
    return run


class Filters:
    """The filters of once-seen and of twice-seen hashes of one segment."""

    def __init__(self):
        self.once, self.twice = np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)

    def add(self, one: np.ndarray, many: np.ndarray) -> None:
        """Hashes, repeats allowed, of which ``many`` were seen twice already."""
        one, count = np.unique(one, return_counts=True)
        many = np.concatenate([many, one[count > 1]])
        p = _probes(one)
        again = self.once[p].all(axis=0)
        self.once[p] = True
        self.twice[p[:, again]] = True
        p = _probes(many)
        self.once[p] = True
        self.twice[p] = True


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    f, one, many, waiting = Filters(), [], [], 0
    for a, b in zip(rows["one"], rows["many"], strict=True):
        one.append(np.frombuffer(a, np.uint64))
        many.append(np.frombuffer(b, np.uint64))
        waiting += len(one[-1]) + len(many[-1])
        if waiting >= BLOCK:
            f.add(np.concatenate(one), np.concatenate(many))
            one, many, waiting = [], [], 0
    if waiting:
        f.add(np.concatenate(one), np.concatenate(many))
    return pd.DataFrame({"segment": rows["segment"].iloc[:1].to_numpy(), "bits": [np.packbits(f.twice, bitorder="little").tobytes()]})


def twice_seen(keys: DataFrame, segments: int, part: int) -> np.ndarray:
    """The filter of twice-seen hashes of one round's segments, a row each (ROUND_SEGMENTS at most)."""
    sent = keys.mapInPandas(_by_segment(segments), "segment int, one binary, many binary")
    filled = sent.groupBy("segment").applyInPandas(_fill, "segment int, bits binary")
    out = np.zeros((min(ROUND_SEGMENTS, segments - part * ROUND_SEGMENTS), SEGMENT_BITS // 8), np.uint8)
    for r in filled.collect():  # ROUND_SEGMENTS rows at most
        out[r["segment"] - part * ROUND_SEGMENTS] = np.frombuffer(r["bits"], np.uint8)
    return out


def _suspected(filter_, segments: int, part: int):
    """Keys (two longs) of each document that the broadcast filter knows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.frombuffer(filter_.value, np.uint8)
        for batch in batches:
            keys = np.frombuffer(b"".join(batch["keys"]), np.uint64).reshape(-1, 2)
            base = (_segment(keys[:, 0], segments) - part * ROUND_SEGMENTS) * (SEGMENT_BITS // 8)
            p = _probes(keys[:, 0])
            known = ((bits[base + (p >> 3)] >> (p & 7).astype(np.uint8)) & 1).all(axis=0)
            row = np.repeat(np.arange(len(batch)), batch["keys"].str.len().to_numpy() // 16)[known]
            keys = keys[known].view(np.int64)
            yield pd.DataFrame({"id": batch["id"].to_numpy()[row], "mark": batch["mark"].to_numpy()[row], "k": keys[:, 0], "k2": keys[:, 1]})
    return run


def suspects(spark: SparkSession, rows: DataFrame, min_chars: int) -> DataFrame:
    """(id, mark, k, k2): keys of documents that two documents seem to have; stored."""
    lines = rows.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    segments = int(lines) * KEY_BITS // SEGMENT_BITS + 1
    hashed, found = scratch_path(spark, "line-keys"), scratch_path(spark, "line-suspects")
    rows.mapInPandas(_digests(min_chars, segments), "id string, mark long, round int, keys binary").write.partitionBy("round").parquet(hashed)
    table = spark.read.schema("id string, mark long, keys binary, round int").parquet(hashed)
    for part in range(-(-segments // ROUND_SEGMENTS)):
        own = table.where(F.col("round") == part).select("id", "mark", "keys")
        bits = spark.sparkContext.broadcast(twice_seen(own.select("keys"), segments, part).tobytes())
        own.mapInPandas(_suspected(bits, segments, part), "id string, mark long, k long, k2 long").write.mode("append").parquet(found)
        bits.unpersist()
    return spark.read.schema("id string, mark long, k long, k2 long").parquet(found)


def _strip(min_chars: int):
    """Texts without the lines of their dropped keys; of a key marked ``first`` the first line stays."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, keys in zip(batch["id"], batch["text"], batch["keys"], strict=True):
                lines = _lines(text)
                kept = lines
                if keys is not None and len(keys):
                    gone = {np.array([k["k"], k["k2"]], np.int64).tobytes(): k["first"] for k in keys}
                    kept = []
                    for line in lines:
                        d = _digest(line_key(line), min_chars)
                        if d not in gone:
                            kept.append(line)
                        elif gone[d]:
                            gone[d] = False
                            kept.append(line)
                out.append((doc, b"\n".join(kept).decode("utf-8", "surrogatepass"), len(lines), len(lines) - len(kept)))
            yield pd.DataFrame(out, columns=["id", "text", "n_lines", "n_dropped"])
    return run


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row: its text without the lines whose key
    ``min_docs`` documents or more have; ``keep_first`` keeps the first of them all."""
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more")
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType
    # ids travel as text: pandas would make floats of a nullable column
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    found = suspects(spark, rows, min_chars)
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").cast(kind).alias("doc"), "mark")
    often = found.groupBy("k", "k2").agg(F.count(F.lit(1)).alias("c"), F.min(order).alias("at")).where(F.col("c") >= min_docs)
    at = scratch_path(spark, "line-frequent")
    often.select("k", "k2", F.col("at.doc").cast("string").alias("_id"), F.col("at.mark").alias("_mark")).write.parquet(at)
    often = spark.read.parquet(at)
    if often.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        often = F.broadcast(often)
    first = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")) & F.lit(keep_first)
    gone = found.join(often, ["k", "k2"]).groupBy(F.col("id").alias("_i"), F.col("mark").alias("_m")).agg(
        F.collect_set(F.struct("k", "k2", first.alias("first"))).alias("keys"))
    told = rows.join(gone, F.col("id").eqNullSafe(F.col("_i")) & (F.col("mark") == F.col("_m")), "left").select("id", "text", "keys")
    out = told.mapInPandas(_strip(min_chars), "id string, text string, n_lines long, n_dropped long")
    return out.select(F.col("id").cast(kind).alias("doc_id"), "text", "n_lines", "n_dropped")


def op12_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten documents share, as digests."""
    out = dedup_lines(T.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT r, unnest(l) AS line, unnest(generate_series(1, len(l))) AS i FROM d),
k AS (SELECT r, i, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
j AS (SELECT r, i, line, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT any_value(d.doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j JOIN d USING (r) GROUP BY r
"""
