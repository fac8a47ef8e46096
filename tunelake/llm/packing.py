"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces of binary length: as many of MAX_LEN
as fit, then the powers of two that make up the rest, long ones first. Each
piece is a sequence; sequences are numbered within buckets of equal length, so
batches draw from one bucket, nothing is padded and no sequence crosses
documents.

Tokens come from a public tokenizer inside Arrow batches, with a bounded cache of
the ids of words or word parts in each worker. Pieces are
written once to the shared scratch folder with their place in (task, length);
the numbers follow from one small count table, without a sort or a global
window.

Defined cases: a null or empty text is the single id EOS; repeated rows and null
doc_ids are packed each; very long texts only add pieces; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm import text as T
from tunelake.session import if_small, scratch_path

MAX_LEN = 4096
EOS = 2
MOST_TASKS = 200_000   # rows of three numbers, one a task and length, that are broadcast
CACHE_PARTS = 200_000  # parts, and words, whose ids a worker remembers


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_lengths(n: int, longest: int = MAX_LEN) -> list[int]:
    """Binary lengths that add up to ``n``, longest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1]


# Normalizer and pre-tokenizer of the file whose cuts are known here.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}

# Texts of these characters only (Latin letters, common signs, ASCII white space) are cut
# here as the tokenizer cuts them: case folds letter by letter and nothing composes.
PLAIN = re.compile(r"[\t-\r\x20-\x7e\xa1-\xff]*")
LETTER, NUMBER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
PART = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTER}]+|[{NUMBER}]|[^\s{LETTER}{NUMBER}]+")
WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")


class Encoder:
    """Ids (as little-endian bytes) of whole texts by one tokenizer file, parts cached.

    With the KNOWN cuts, plain texts are cut into the tokenizer's own parts, others into words between
    ASCII white space, which its parts never span; either way the tokenizer gives the ids. Any other
    file encodes each text as a whole.
    """

    def __init__(self, path: str, most: int = CACHE_PARTS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok, self.most = Tokenizer.from_file(path), most
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        told = json.loads(self.tok.to_str())
        self.known = all(told.get(k) == v for k, v in KNOWN.items())
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        text = part if part.isascii() else self.byte_level.pre_tokenize_str(part)[0][0]
        return np.array([t.id for t in self.tok.model.tokenize(text)], dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        return np.array(self.tok.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not self.known:
            return self._word(text)
        if PLAIN.fullmatch(text) and "<|" not in text:
            found, known, make = PART.findall(text.lower()), self.parts, self._part
        else:
            found, known, make = WORD.findall(text), self.words, self._word
        try:
            return b"".join(map(known.__getitem__, found))
        except KeyError:
            for x in set(found).difference(known):
                known[x] = make(x)
            ids = b"".join(map(known.__getitem__, found))
            if len(known) > self.most:
                known.clear()
            return ids


_encoders: dict[str, Encoder] = {}  # one a worker process and file


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _pieces(path: str, longest: int, keep_ids: bool, eos: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encode, count, task = encoder(path), {}, TaskContext.get().partitionId()
        end = np.array([eos], dtype="<u4").tobytes()
        for batch in batches:
            texts, docs = batch["text"].fillna(""), batch["id"]
            for a in range(0, len(batch), 256):
                rows = []
                for doc, text in zip(docs.iloc[a:a + 256], texts.iloc[a:a + 256], strict=True):
                    raw, start = memoryview(encode(text) + end), 0
                    total = len(raw) // 4
                    for n in piece_lengths(total, longest):
                        ids, k = raw[4 * start:4 * (start + n)], count.get(n, 0)
                        rows.append((doc, start, n, zlib.crc32(ids), total, task, k, bytes(ids) if keep_ids else None))
                        count[n], start = k + 1, start + n
                out = pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "_p", "_k", "ids"])
                yield out if keep_ids else out.drop(columns="ids")
    return run


def pack(docs: DataFrame, path: str | None = None, longest: int = MAX_LEN, keep_ids: bool = True, eos: int = EOS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, if asked for, ``ids`` (little-endian unsigned 32-bit). ``path`` is a tokenizer file, ``eos`` the id
    that ends a document."""
    spark = docs.sparkSession
    schema = "id string, start long, length long, ids_crc32 long, doc_tokens long, _p int, _k long"
    # ids travel as text: pandas would make floats of a nullable column
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
    made = rows.mapInPandas(_pieces(path or tokenizer_path(), longest, keep_ids, eos), schema + (", ids binary" if keep_ids else ""))
    at = scratch_path(spark, "pieces")
    made.write.parquet(at)
    made = spark.read.parquet(at)
    # one row a (length, task): each bucket's layout, and one a length: the order of the buckets
    n = made.groupBy("length", "_p").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("length").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    within = n.select("length", "_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_first"))
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    begin = n.groupBy("length").agg(F.sum("_c").alias("_c")).select(
        "length", F.coalesce(F.sum("_c").over(longer), F.lit(0)).alias("_begin"))  # a row a binary length
    # numbers of tasks and lengths, not of pieces: the pieces with their ids stay where they are
    out = made.join(if_small(within, MOST_TASKS), ["length", "_p"]).join(F.broadcast(begin), "length")
    cols = [F.col("id").cast("long").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", (F.col("_begin") + F.col("_first") + F.col("_k")).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset")]
    return out.select(*cols, *(["ids"] if keep_ids else []))


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """Pieces of all documents."""
    return pack(T.table(spark, sf_dir, "documents"), keep_ids=False)
