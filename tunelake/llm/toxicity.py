"""Toxicity from subword-bag embeddings under a linear softmax.

A word is the bag of its character n-grams (with its ends marked), each n-gram a
row of a hashed embedding table; bags are averaged to word and then to passage
vectors, PASSAGE words each, and a linear softmax scores passages. A document's
logit is a smooth maximum over its passages, so a few words count in a long text.
Embeddings and softmax are trained jointly in numpy on a bounded sample (at most
TRAIN_ROWS documents a class); misspelt words share most n-grams and so their
vectors. The smooth maximum starts as a mean and sharpens during training.

Scale: the model is one table of BUCKETS numbers once the softmax is multiplied
in (averages are linear), sent to the tasks; scoring is one pass over all whole
texts without shuffle, with a bounded cache of word scores.

Defined cases: null, empty and blank texts have one passage without words and get
the bias's score; repeated rows and null doc_ids are scored each; without labels
of both classes every score is the share of toxic labels (0.5 without any); an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm import labelled
from tunelake.llm import text as T

TRAIN_ROWS = 1_200   # documents a class
BUCKETS = 1 << 17
DIM = 8
GRAMS = (3, 4, 5)
PASSAGE = 2
SCALE = 2.0       # of averages in a logit
SHARP = 6.0
EPOCHS = 60
MIN_DOCS = 4      # training documents that an n-gram must be in
DECAY = 1e-5     # weight decay of vectors
THRESHOLD = 0.3
CACHE_WORDS = 300_000


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every word (words one after another) and n-grams per word (1 at least)."""
    joined = "".join(f"<{w}>" for w in words)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words])
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(start + size, size) - np.arange(len(code))  # characters to the word's end
    buckets, of = [], []
    for n in GRAMS:
        h = np.zeros(len(code), np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + np.concatenate([code[j:], np.zeros(j, np.uint64)])
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)
        fits = left >= n
        buckets.append(((h >> np.uint64(40)) % np.uint64(BUCKETS))[fits].astype(np.int64))
        of.append(owner[fits])
    buckets, of = np.concatenate(buckets), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return buckets[order], np.bincount(of, minlength=len(words))


def _tokens(text: str) -> list[str]:
    return text.lower().split()


def train(texts: list[str], labels: list[int], share: float, epochs: int = EPOCHS, passage: int | None = PASSAGE) -> dict:
    """Scores of n-gram buckets (embedding times softmax difference) and the bias; ``passage`` None averages whole documents."""
    vocab: dict[str, int] = {}
    docs = [np.array([vocab.setdefault(w, len(vocab)) for w in _tokens(t)], np.int64) for t in texts]
    grams, per = subwords(list(vocab)) if vocab else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    word_at = np.concatenate([[0], np.cumsum(per)[:-1]]).astype(np.int64) if vocab else np.zeros(0, np.int64)
    # passages: tokens one after another, cut every PASSAGE words of a document
    doc_of, starts, at = [], [], 0
    for i, d in enumerate(docs):
        for k in range(0, len(d), passage or max(len(d), 1)):
            doc_of.append(i)
            starts.append(at + k)
        at += len(d)
    if not doc_of:
        return {"share": share}
    token, doc_of, starts = np.concatenate(docs), np.array(doc_of), np.array(starts)
    count = np.diff(np.concatenate([starts, [len(token)]]))
    first = np.flatnonzero(np.concatenate([[True], doc_of[1:] != doc_of[:-1]]))
    n_pass = np.diff(np.concatenate([first, [len(doc_of)]]))
    seen = doc_of[first]
    y = np.array(labels, float)[seen]
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    rng = np.random.default_rng(7)
    emb, soft, bias = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32), rng.normal(0, 0.5, DIM).astype(np.float32), 0.0
    # an n-gram of few documents could only be learned by heart: it has no vector
    pairs = np.unique(np.repeat(np.arange(len(docs)), [len(d) for d in docs]) * len(vocab) + token)
    in_docs = np.zeros(BUCKETS, np.int64)
    for w, n in zip(*np.unique(pairs % len(vocab), return_counts=True), strict=True):
        in_docs[grams[word_at[w]:word_at[w] + per[w]]] += n
    common = in_docs[grams] >= MIN_DOCS
    used = np.unique(grams[common])
    if not len(used):
        return {"share": share}
    emb_m, emb_v = np.zeros((len(used), DIM), np.float32), np.zeros((len(used), DIM), np.float32)
    place = np.where(common, np.searchsorted(used, grams), len(used))  # one place more, of value 0
    state = np.zeros((2, DIM + 1))
    owner = np.repeat(np.arange(len(vocab)), per)
    for epoch in range(epochs):
        sharp = SHARP * min(1.0, (epoch + 1) / (epochs * 0.4))
        value = np.append(emb[used] @ soft, np.float32(0))
        word = np.add.reduceat(value[place], word_at) / per
        z = np.add.reduceat(word[token], starts) / count * SCALE + bias
        top = np.maximum.reduceat(z, first)
        part = np.exp(sharp * (z - np.repeat(top, n_pass)))
        total = np.add.reduceat(part, first)
        doc = top + np.log(total / n_pass) / sharp
        p = 1 / (1 + np.exp(-np.clip(doc, -30, 30)))
        g_doc = weight * (p - y) / len(y)
        g_z = np.repeat(g_doc / total, n_pass) * part
        g_token = np.repeat(g_z / count * SCALE, count)
        g_word = np.bincount(token, g_token, len(vocab)) / per
        g_value = np.bincount(place, g_word[owner], len(used) + 1)[:-1].astype(np.float32)
        g_soft = np.concatenate([g_value @ emb[used], [g_z.sum()]])
        g_emb = g_value[:, None] * soft + DECAY * emb[used]
        t, rate = epoch + 1, 0.15 * (1 - epoch / epochs) + 0.005
        emb_m += 0.1 * (g_emb - emb_m)
        emb_v += 0.01 * (g_emb * g_emb - emb_v)
        emb[used] -= rate * (emb_m / (1 - 0.9 ** t)) / (np.sqrt(emb_v / (1 - 0.99 ** t)) + 1e-6)
        state[0] += 0.1 * (g_soft - state[0])
        state[1] += 0.01 * (g_soft ** 2 - state[1])
        move = rate * (state[0] / (1 - 0.9 ** t)) / (np.sqrt(state[1] / (1 - 0.99 ** t)) + 1e-8)
        soft, bias = (soft - move[:-1]).astype(np.float32), bias - move[-1]
    table = np.zeros(BUCKETS, np.float32)
    table[used] = emb[used] @ soft  # n-grams never seen have no say
    # classes had equal weight: back to the share of all labels
    prior = float(np.log(share / (1 - share))) if 0 < share < 1 else 0.0
    return {"table": table, "bias": float(bias), "prior": prior, "share": share, "passage": passage}


class Scorer:
    """Document scores from bucket scores, word scores cached."""

    def __init__(self, model: dict):
        self.model, self.known = model, {}

    def __call__(self, texts: list[str]) -> list[float]:
        m = self.model
        if "table" not in m:
            return [m["share"]] * len(texts)
        split = [_tokens(t) for t in texts]
        new = list({w for ws in split for w in ws}.difference(self.known))
        if new:
            grams, per = subwords(new)
            at = np.concatenate([[0], np.cumsum(per)[:-1]]).astype(np.int64)
            self.known.update(zip(new, (np.add.reduceat(m["table"][grams], at) / per).tolist(), strict=True))
        get, out = self.known.__getitem__, []
        for ws in split:
            z = np.array([m["bias"]])
            if ws:
                s = np.fromiter(map(get, ws), float, len(ws))
                cut = np.arange(0, len(s), m["passage"] or len(s))
                z = np.add.reduceat(s, cut) / np.diff(np.append(cut, len(s))) * SCALE + m["bias"]
            top = z.max()
            doc = top + np.log(np.exp(SHARP * (z - top)).mean()) / SHARP
            out.append(float(1 / (1 + np.exp(-np.clip(doc + m["prior"], -30, 30)))))
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        return out


def _scorer(model: dict):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = Scorer(model)
        for batch in batches:
            for a in range(0, len(batch), 200):
                part = batch.iloc[a:a + 200]
                yield pd.DataFrame({"id": part["id"], "score": score(part["text"].tolist())})
    return run


def fit(docs: DataFrame, labels: DataFrame, train_rows=None, most: int = TRAIN_ROWS, passage: int | None = PASSAGE) -> dict:
    """The model from labelled rows where ``train_rows`` (a condition on doc_id) holds."""
    rows = labelled.sample(docs, labels, "toxic", F.lit(True) if train_rows is None else train_rows, most)
    if rows["y"].nunique() < 2:
        return {"share": rows.attrs["share"]}
    return train(rows["text"].tolist(), rows["y"].tolist(), rows.attrs["share"], passage=passage)


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score of every row."""
    told = docs.select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    out = told.mapInPandas(_scorer(model), "id string, score double")
    return out.select(F.col("id").cast("long").alias("doc_id"), "score")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents, learned outside the held-out fold."""
    docs = T.table(spark, sf_dir, "documents")
    model = fit(docs, T.table(spark, sf_dir, "labels"), labelled.fold(F.col("doc_id"), 4) != 2)
    out = score_documents(docs, model)
    return out.select("doc_id", (labelled.fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
