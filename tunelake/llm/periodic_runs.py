"""Runs of a repeated period of words, found on a grammar of the words instead of the words.

Re-Pair replaces pairs of symbols that recur by a nonterminal. Here it works in rounds:
a round counts all pairs of a batch of texts and replaces every pair that is more frequent
than the pairs it overlaps (of a pair overlapping itself, every second place), until no pair
recurs. No pair crosses a text, but texts share nonterminals, so what copies hold is looked
at once. What is left of a text is halved into a balanced tree, whose nodes are
nonterminals that occur once.

A run that lies in the expansion of a nonterminal and not in that of one child crosses the
boundary of the children. It has 2 q words or more (q: its period; a run has 4 q at least) on
one side of the boundary, so a square of period q ends or begins there: for the places where
the word beside the boundary occurs again, the square is tested, least periods first, and
extended within the expansion. A longer period's square inside a run already found there is
a multiple of its period and is skipped. Each nonterminal is searched once, at the first place
where it occurs.

The runs found are then translated to all places of the derivation. Where a text goes on with
the period beyond the nonterminal, the part is dropped: a nonterminal above holds the whole
run across its own boundary. What stays is maximal; the same run found twice is one.

Texts are independent, so nothing is shuffled. A task holds texts of about BATCH_WORDS words
(at least one text) at a time, and the grammar is linear in them.

Defined cases: null, empty and blank texts have no word and no run; words differ by their exact
bytes; repeated rows give repeated results; a null doc_id stays null; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm import text as T

BATCH_WORDS = 150_000
MIN_WORDS = 6
MIN_PERIODS = 4

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Grammar:
    """Rules of nonterminals over ``x``, word ids of texts that begin at ``starts``."""

    def __init__(self, x: np.ndarray, starts: np.ndarray):
        n = len(x)
        self.terminals = int(x.max()) + 1 if n else 0
        self.left, self.right, self.first = [], [], []
        size = np.ones(self.terminals + n, np.int64)
        sym, pos = x.astype(np.int64), np.arange(n)
        last = np.zeros(n, bool)
        last[starts[1:] - 1] = True
        last[n - 1:] = True
        # pairs that may recur: one that doesn't can't later, unless a symbol of it is new
        open_ = ~last
        total = self.terminals
        while True:
            at = np.flatnonzero(open_)
            names, which, count = np.unique(sym[at] * total + sym[np.minimum(at + 1, len(sym) - 1)], return_inverse=True, return_counts=True)
            many = count > 1
            if not many.any():
                break
            # rank of a pair: its count, then an arbitrary fixed order
            order = np.lexsort(((names.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32), count))
            rank = np.empty(len(names), np.int64)
            rank[order] = np.arange(1, len(names) + 1)
            open_[at[~many[which]]] = False
            at, rank = at[many[which]], rank[which[many[which]]]
            # blocks of equal neighbours (a pair overlapping itself) are taken or left as one
            near = np.r_[False, at[1:] == at[:-1] + 1]
            begins = np.flatnonzero(~near | np.r_[True, rank[1:] != rank[:-1]])
            block, joined = rank[begins], near[begins]
            peak = ~(joined & (np.r_[0, block[:-1]] > block)) & ~(np.r_[joined[1:], False] & (np.r_[block[1:], 0] > block))
            take = (np.diff(np.r_[begins, len(at)])[peak] + 1) // 2
            within = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
            at = np.repeat(at[begins[peak]], take) + 2 * within
            made, seen, new = np.unique(sym[at] * total + sym[at + 1], return_index=True, return_inverse=True)
            left, right = made // total, made % total
            self.left.append(left)
            self.right.append(right)
            size[total:total + len(made)] = size[left] + size[right]
            self.first.append(pos[at[seen]])
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            sym[at] = total + new
            last[at] = last[at + 1]
            open_[at] = True
            open_[np.maximum(at - 1, 0)] = True
            sym, pos, last, open_ = sym[stay], pos[stay], last[stay], open_[stay]
            open_ &= ~last
            total += len(made)
        self.size = size[:total]
        cat = lambda a: np.concatenate(a) if a else np.empty(0, np.int64)
        self.left, self.right, self.first = cat(self.left), cat(self.right), cat(self.first)
        self.top, self.top_at, self.top_last = sym, pos, last

    def nodes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, boundary, end) at their first place of the nonterminals, then of the trees above them."""
        s = self.first
        found = [(s, s + self.size[self.left], s + self.size[self.terminals:])]
        ends = np.flatnonzero(self.top_last) + 1
        lo, hi = np.r_[0, ends[:-1]] if len(ends) else ends, ends
        bounds = np.r_[self.top_at, self.top_at[-1:] + self.size[self.top[-1:]]]
        while True:
            many = hi - lo > 1
            lo, hi = lo[many], hi[many]
            if not len(lo):
                break
            mid = (lo + hi) // 2
            found.append((bounds[lo], bounds[mid], bounds[hi]))
            lo, hi = np.r_[lo, mid], np.r_[mid, hi]
        return tuple(np.concatenate(a) for a in zip(*found, strict=True))

    def places(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nonterminal, start) of every place in the derivation of the ``wanted`` ones (a mask)."""
        need = np.r_[np.zeros(self.terminals, bool), wanted]
        for _ in range(len(wanted)):  # as often as the grammar is deep
            up = need[self.left] | need[self.right]
            if not (up & ~need[self.terminals:]).any():
                break
            need[self.terminals:] |= up
        sym, at, out = self.top[need[self.top]], self.top_at[need[self.top]], []
        while len(sym):
            rule = sym - self.terminals
            out.append((rule[wanted[rule]], at[wanted[rule]]))
            left, right = self.left[rule], self.right[rule]
            sym, at = np.r_[left, right], np.r_[at, at + self.size[left]]
            sym, at = sym[need[sym]], at[need[sym]]
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(a) for a in zip(*out, strict=True))


def _neighbours(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The previous and the next place of each word; -1 and len(x) if there is none."""
    n = len(x)
    order = np.argsort(x, kind="stable")
    same = x[order[1:]] == x[order[:-1]]
    before, after = np.full(n, -1), np.full(n, n)
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    return before, after


def _squares(x: np.ndarray, s: np.ndarray, b: np.ndarray, e: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """(node, q, begin): likely squares of period q that end or begin at the boundary, 4 q fitting in."""
    before, after = _neighbours(x)
    found = []
    for left in (True, False):
        node = np.flatnonzero(e - s >= min_words)
        c = before[b[node] - 1] if left else after[b[node]]
        while len(node):
            q = b[node] - 1 - c if left else c - b[node]
            begin = b[node] - 2 * q if left else b[node]
            fits = (c >= 0) & (c < len(x)) & (begin >= s[node]) & (begin + 2 * q <= e[node]) & (MIN_PERIODS * q <= e[node] - s[node])
            node, c, q, begin = node[fits], c[fits], q[fits], begin[fits]
            good = (x[begin] == x[begin + q]) & (x[begin + q - 1] == x[begin + 2 * q - 1]) & (x[begin + q // 2] == x[begin + q + q // 2])
            found.append((node[good], q[good], begin[good]))
            c = before[c] if left else after[c]
    node, q, begin = (np.concatenate(a) for a in zip(*found, strict=True)) if found else (np.empty(0, int),) * 3
    order = np.lexsort((q, node))
    return list(zip(node[order].tolist(), q[order].tolist(), begin[order].tolist(), strict=True))


def _reach(x: np.ndarray, i: int, q: int, stop: int, step: int) -> int:
    """The first place from ``i`` on, before ``stop``, where x[place] differs from x[place - q]; step -1: x[place + q]."""
    width = 16
    while i != stop:
        k = min(width, abs(stop - i))
        a = x[i:i + k] if step > 0 else x[i - k + 1:i + 1][::-1]
        c = x[i - q:i - q + k] if step > 0 else x[i - k + 1 + q:i + 1 + q][::-1]
        differ = a != c
        if differ.any():
            return i + step * int(differ.argmax())
        i, width = i + step * k, width * 4
    return stop


def crossing(x: np.ndarray, s: np.ndarray, b: np.ndarray, e: np.ndarray, min_words: int, min_periods: int) -> np.ndarray:
    """Rows (node, start, end, period): runs within [s, e) of each node that reach its boundary."""
    out, now, covered = [], -1, []
    for node, q, begin in _squares(x, s, b, e, min_words):
        if node != now:
            now, covered = node, []
        if any(a <= begin and begin + 2 * q <= z for a, z in covered) or not np.array_equal(x[begin:begin + q], x[begin + q:begin + 2 * q]):
            continue
        a = _reach(x, begin - 1, q, int(s[node]) - 1, -1) + 1
        z = _reach(x, begin + 2 * q, q, int(e[node]), 1)
        covered.append((a, z))
        if z - a >= max(min_words, min_periods * q):
            out.append((node, a, z, q))
    return np.array(out, np.int64).reshape(-1, 4)


def runs_of(x: np.ndarray, starts: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """Sorted rows (start, period, end) of the maximal runs of texts that begin at ``starts`` in ``x``; none is empty."""
    if not len(x):
        return np.empty((0, 3), np.int64)
    g = Grammar(x, starts)
    s, b, e = g.nodes()
    r = crossing(x, s, b, e, min_words, min_periods)
    rules = len(g.first)
    single, shared = r[r[:, 0] >= rules], r[r[:, 0] < rules]
    wanted = np.zeros(rules, bool)
    wanted[shared[:, 0]] = True
    rule, at = g.places(wanted)
    # every place of a nonterminal with each of its runs; shared is sorted by nonterminal
    lo, hi = np.searchsorted(shared[:, 0], rule), np.searchsorted(shared[:, 0], rule, side="right")
    place = np.repeat(np.arange(len(rule)), hi - lo)
    pick = shared[np.arange(len(place)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)]
    shift = (at - g.first[rule])[place]
    start = np.r_[single[:, 1], pick[:, 1] + shift]
    end = np.r_[single[:, 2], pick[:, 2] + shift]
    q = np.r_[single[:, 3], pick[:, 3]]
    doc = np.searchsorted(starts, start, side="right") - 1
    low, high = starts[doc], np.r_[starts[1:], len(x)][doc]
    longer = (start > low) & (x[start - 1] == x[start - 1 + q])
    longer |= (end < high) & (x[np.minimum(end, len(x) - 1)] == x[end - q])
    return np.unique(np.stack([start, q, end], 1)[~longer], axis=0)


def _split(texts: list[str | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first text, words of each) for groups of texts of about BATCH_WORDS words."""
    group, first, words = [], 0, 0
    for i, t in enumerate(texts):
        group.append((t or "").encode("utf-8", "surrogatepass").split())  # ASCII white space only
        words += len(group[-1])
        if words >= BATCH_WORDS:
            yield first, group
            group, first, words = [], i + 1, 0
    if group:
        yield first, group


def _find(min_words: int, min_periods: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["id"].tolist()
            for first, group in _split(batch["text"].tolist()):
                sizes = np.array([len(w) for w in group])
                full = np.flatnonzero(sizes)
                x = pd.factorize(np.array([w for g in group for w in g] + [b""], object))[0][:-1].astype(np.int64)
                starts = (np.cumsum(sizes) - sizes)[full]
                r = runs_of(x, starts, min_words, min_periods)
                doc = full[np.searchsorted(starts, r[:, 0], side="right") - 1] if len(r) else np.empty(0, int)
                origin = np.cumsum(sizes) - sizes
                found = [[] for _ in group]
                for d, (a, q, z) in zip(doc.tolist(), r.tolist(), strict=True):
                    found[d].append({"start": a - int(origin[d]), "length": z - a, "period": q})
                kept = []
                for words, f in zip(group, found, strict=True):
                    if f:
                        stay = np.ones(len(words), bool)
                        for run in f:
                            stay[run["start"] + run["period"]:run["start"] + run["length"]] = False
                        words = [w for w, k in zip(words, stay.tolist(), strict=True) if k]
                    kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                yield pd.DataFrame({"id": ids[first:first + len(group)], "n_words": sizes, "runs": found, "collapsed": kept})
    return run


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its maximal runs of ``min_periods`` periods and
    ``min_words`` words or more, by start, then period, and the text with one period left of each.

    ``min_periods`` must be 4 or more: shorter runs need not hold a square beside a boundary."""
    if min_periods < MIN_PERIODS:
        raise ValueError("min_periods must be 4 or more")
    kind = docs.schema["doc_id"].dataType
    # ids travel as text: pandas would make floats of a nullable column
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInPandas(_find(min_words, min_periods), f"id string, n_words long, runs {RUNS}, collapsed string")
    return out.select(F.col("id").cast(kind).alias("doc_id"), "n_words", "runs", "collapsed")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the words of a tenth of the documents, by crc32 of the id, made periodic from
    some word on; a null id counts as one of the others."""
    words, h = T.words(F.col("text")), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    new = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")
    return docs.select("doc_id", F.when((h % 10 == 0) & (n > 0), new).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of all documents, a tenth of them made periodic, as digests."""
    out = periodic_runs(planted(T.table(spark, sf_dir, "documents")))
    best = F.get(F.array_sort("runs", _greater), F.lit(0))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    told = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(best["length"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(told.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def _greater(x, y):
    """Order by length / period, greatest first (cross products: exact), then start, then period."""
    a, b = x["length"] * y["period"], y["length"] * x["period"]
    less = (a > b) | ((a == b) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))
    same = (a == b) & (x["start"] == y["start"]) & (x["period"] == y["period"])
    return F.when(same, 0).when(less, -1).otherwise(1)
