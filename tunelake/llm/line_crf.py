"""Document quality from a linear-chain conditional random field over lines.

Every line has two states, bad and good. Node scores are linear in features of
the line and of its neighbours, edge scores a 2 x 2 table. Lines of a training
document carry its label; the field is fitted by gradient steps on the
conditional likelihood, gradients from forward-backward, in numpy, on a bounded
sample (at most TRAIN_ROWS documents a class, each whole, however long). Scoring runs forward-backward on
all lines of all documents in Arrow batches; a document's score is the mean of
its lines' marginal of "good", weighted by line length.

Scale: the model is a few hundred numbers; scoring is one pass without shuffle.
Only the bounded sample reaches the driver, where its lines take 128 bytes each
besides the text.

Defined cases: null and empty texts are one empty line and get a score; repeated
rows and null doc_ids are scored each; texts of any length are scored whole;
without labels of both classes every score is the share of good labels (0.5
without any); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm import labelled
from tunelake.llm import text as T

TRAIN_ROWS = 1_500   # documents a class
EPOCHS = 60
THRESHOLD = 0.3
UPPER = bytes(range(65, 91))
DIGIT = bytes(range(48, 58))
SYMBOL = b"#*$%&|<>=_{}[]\\^~"
SHOUT = b"!?"
LETTER = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
N_OWN = 16


def own_features(lines: list[str]) -> np.ndarray:
    """(lines, N_OWN): features of each line by itself and of its repeats."""
    own = np.zeros((len(lines), N_OWN))
    seen: set[str] = set()
    for i, line in enumerate(lines):
        raw = line.encode("utf-8", "surrogatepass")
        words = raw.split()
        n, w = len(raw), len(words)
        if not w:
            own[i, 0] = 1.0
            continue
        count = lambda chars: n - len(raw.translate(None, chars))
        letters, kinds = count(LETTER), len(set(words))
        own[i] = (0.0, np.log1p(w) / 5, min(n / w, 30) / 10, count(UPPER) / max(letters, 1), count(DIGIT) / n,
                  4 * count(SYMBOL) / n, 4 * count(SHOUT) / n, letters / n, 1 - kinds / w if w > 3 else 0.0,
                  float(sum(map(bytes.__eq__, words, words[1:])) / w), float(line in seen), min(w, 4) / 4,
                  float(raw.rstrip()[-1:] in b".!?\"')"), min(1.0, 3 * raw.count(b"@") / w + raw.count(b"://") / w),
                  min(1.0, count(b",;:") / w), min(1.0, raw.count(b"|") / w))
        seen.add(line)
    return own


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """(lines, 3 * N_OWN + 1): a line's own features, those of the line before and after, and a bias."""
    pad = np.zeros((1, N_OWN))
    return np.hstack([own, np.vstack([pad, own[:-1]]), np.vstack([own[1:], pad]), np.ones((len(own), 1))])


def line_features(lines: list[str]) -> np.ndarray:
    return with_neighbours(own_features(lines))


def marginals(nodes: np.ndarray, edges: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over padded chains. nodes (batch, T, 2), edges (2, 2), length (batch,):
    node marginals (batch, T, 2), summed edge marginals (2, 2) and log partition (batch,)."""
    b, t, _ = nodes.shape
    fwd, bwd = np.zeros_like(nodes), np.zeros_like(nodes)
    fwd[:, 0] = nodes[:, 0]
    for i in range(1, t):
        step = fwd[:, i - 1, :, None] + edges
        fwd[:, i] = np.logaddexp(step[:, 0], step[:, 1]) + nodes[:, i]
    for i in range(t - 2, -1, -1):
        step = edges[None] + (nodes[:, i + 1] + bwd[:, i + 1])[:, None, :]
        step = np.logaddexp(step[:, :, 0], step[:, :, 1])
        bwd[:, i] = np.where((i + 1 < length)[:, None], step, 0.0)
    last = fwd[np.arange(b), length - 1]
    log_z = np.logaddexp(last[:, 0], last[:, 1])
    inside = np.arange(t)[None, :] < length[:, None]
    node = np.where(inside[..., None], np.exp(np.minimum(fwd + bwd - log_z[:, None, None], 0.0)), 0.0)
    pair = np.zeros((2, 2))
    if t > 1:
        p = fwd[:, :-1, :, None] + edges + (nodes[:, 1:] + bwd[:, 1:])[:, :, None, :] - log_z[:, None, None, None]
        pair = np.where(inside[:, 1:, None, None], np.exp(np.minimum(p, 0.0)), 0.0).sum((0, 1))
    return node, pair, log_z


def _padded(feats: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(f) for f in feats])
    x = np.zeros((len(feats), length.max(), feats[0].shape[1]))
    for i, f in enumerate(feats):
        x[i, :len(f)] = f
    return x, length


def _groups(lengths: list[int], cells: int = 20_000, most: int = 256) -> Iterator[list[int]]:
    """Chains of like length together, a bounded number of lines each (a longer chain is alone)."""
    part: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: lengths[i]):
        if part and (lengths[i] * (len(part) + 1) > cells or len(part) == most):
            yield part
            part = []
        part.append(i)
    if part:
        yield part


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS) -> dict:
    """Node weights (features,) for good against bad and edge scores (2, 2), from every document."""
    own = [own_features(t.split("\n")) for t in texts]  # 128 bytes a line; neighbours are added a batch at a time
    y = np.array(labels)
    weight = np.where(y == 1, 0.5 / max((y == 1).mean(), 1e-9), 0.5 / max((y == 0).mean(), 1e-9))
    w, e = np.zeros(3 * N_OWN + 1), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(e), np.zeros_like(e)]
    batches = list(_groups([len(f) for f in own], 4_000, 64))
    rng, step = np.random.default_rng(11), 0
    for epoch in range(epochs):
        for k in rng.permutation(len(batches)):
            g = batches[k]
            x, length = _padded([with_neighbours(own[i]) for i in g])
            s = x @ w
            node, pair, _ = marginals(np.stack([-s / 2, s / 2], -1), e, length)
            inside = np.arange(x.shape[1])[None] < length[:, None]
            # a document counts alike, however many lines it has
            c = weight[g] / length
            miss = (y[g][:, None] - node[..., 1]) * inside
            gw = np.einsum("b,bt,btf->f", c, miss, x) / len(g) - 1e-4 * w
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[g], y[g]), np.maximum(length - 1, 0))
            ge = (seen - pair) / max(length.sum(), 1) - 1e-3 * e
            step += 1
            for p, grad, m, v in ((w, gw, moments[0], moments[1]), (e, ge, moments[2], moments[3])):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                p += 0.05 * (1 - epoch / epochs) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return {"w": w, "e": e}


def score(texts: list[str], model: dict) -> list[float]:
    split = [(t or "").split("\n") for t in texts]
    feats, out = [line_features(x) for x in split], [0.0] * len(split)
    for g in _groups([len(x) for x in split]):
        x, length = _padded([feats[i] for i in g])
        s = x @ model["w"]
        node, _, _ = marginals(np.stack([-s / 2, s / 2], -1), model["e"], length)
        for r, i in enumerate(g):
            size = np.array([max(len(line), 1) for line in split[i]], float)
            out[i] = float(np.clip(size @ node[r, :len(size), 1] / size.sum(), 0.0, 1.0))
    return out


def _scorer(model: dict):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 400):
                part = batch.iloc[a:a + 400]
                s = score(part["text"].tolist(), model) if "w" in model else [model["share"]] * len(part)
                yield pd.DataFrame({"id": part["id"], "score": s})
    return run


def fit(docs: DataFrame, labels: DataFrame, train_rows=None, most: int = TRAIN_ROWS) -> dict:
    """The model from labelled rows where ``train_rows`` (a condition on doc_id) holds."""
    rows = labelled.sample(docs, labels, "quality", F.lit(True) if train_rows is None else train_rows, most)
    if rows["y"].nunique() < 2:
        return {"share": rows.attrs["share"]}
    return train(rows["text"].tolist(), rows["y"].tolist())


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score of every row."""
    told = docs.select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    out = told.mapInPandas(_scorer(model), "id string, score double")
    return out.select(F.col("id").cast("long").alias("doc_id"), "score")


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Quality score of all documents, learned outside the held-out fold."""
    docs = T.table(spark, sf_dir, "documents")
    model = fit(docs, T.table(spark, sf_dir, "labels"), labelled.fold(F.col("doc_id"), 5) != 0)
    out = score_documents(docs, model)
    return out.select("doc_id", (labelled.fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
