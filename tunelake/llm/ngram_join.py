"""Jaccard join of word n-gram sets by partitioning the universe of n-grams.

Two sets of sizes |x| <= |y| with Jaccard similarity T differ in at most
H = |x| (1 - T) / T elements. Sizes fall into bands; a band fixes H for its
largest size and a number of segments. A token's hash names its segment, so a
set splits into disjoint subsets, and a segment is indexed with weight 1 (its
subset) or weight 2 (its subset and every subset with one deletion). Differences
can spoil segments of H in weight together, so with weights that sum to H + 1 + E
two similar sets meet in segments of weight E + 1: equal there, or one element apart
where the weight is 2. A set also signs in every lower band that its partners may be in.

Empty subsets say nothing, and all sets with the same one empty would meet there. A set in which
segments of weight E at most hold fewer tokens than their weight doesn't sign them: it meets each
similar set in some other segment, by a subset that isn't empty. Sets with more such segments, few by the choice
of E, sign all. Weights and E are chosen per band by cost: signatures to write against the segments that
hold nothing but n-grams which many sets have. Crowds there are met in linear time (below), so
the choice follows the sizes of sets and not their number.

Candidates are verified exactly on whole sets, after bounds on what they can share, from a few bits and then from one byte a token. Equal sets are one node. In a
bucket the least node leads; every node is first compared with one leader only, that
of most of its buckets, so a group of near copies costs its size, not its square; components then tell which nodes
of a bucket are still apart, and only pairs of different components are compared
(those outside the bucket's largest component against the others). No link between
components is lost, and links inside a component don't change it.

A crowded bucket (more than CROWD nodes) first has ROUNDS in which its nodes are dealt
into cells of about ROOM and compared there: a large group of near copies, few pairs of
which are similar, grows together at a cost linear in its size. What is apart after that
is compared by rarity: texts that share a frequent passage share whole segments without
being similar, but similar sets also share one of their rarest n-grams (the first
|x| - ceil(T |x|) + 1 in any fixed order), the first of these so early that enough n-grams
for a link can still follow in both. Nodes of crowded buckets are compared only where they
share such a one. The order is by counts of n-grams in CELLS hashed cells over the crowded
nodes; it changes the cost, never the links.

Scale: rows with the set of another row sign once; signatures are exchanged once, as
(key, node), in up to KEY_TURNS parts by key, and keys of a single node end there; joins by bucket can be split
when skewed, sets travel only for nodes in candidates, at a time about a quarter of what the sets take (small
tables: at most as much as they take). Tables between passes go to the shared scratch folder and are dropped after use. Sets and nodes are
identified by 64-bit hashes.

Defined cases: null, empty and blank texts have the empty set (0) and are linked
with nothing; fewer than N words are one n-gram; a component is named by its
smallest doc_id that isn't null; repeated rows and equal texts share a node; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm import text as T
from tunelake.session import cut_lineage, drop_scratch, release, scratch_path

N = 3
PERCENT = 90           # similarity at which sets link
BAND = 1.4             # ratio of the sizes in a band
LARGEST = 1 << 31      # n-grams of the largest set
COMMON = 0.15          # share of a set's n-grams that many sets have, for the choice of weights
CROWD_COST = 60.0      # of a set in one crowded bucket, in signatures
SPARE = (0, 1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64)
CACHE_WORDS = 100_000
CROWD = 16             # nodes of a bucket that are compared directly
ROOM = 8               # nodes of a crowded bucket that meet in a round
ROUNDS = 3             # at most; the last is the one that links less than a tenth of its pairs
CELLS = 1 << 14        # counters behind the order of rarity: bounds the driver's and the tasks' copy
BROADCAST_NODES = 1_000_000  # ids of 16 bytes
KEY_TURNS = 4          # parts in which signatures are exchanged, at most
TURN_KEYS = 8_000_000  # signatures that go in one part anyway
SET_SHARE = 4          # pairs carry at a time one part in so many of what the sets take,
TURN_BYTES = 1 << 26   # or these bytes, if the sets take more
EDGES = 20_000         # of a component's round that a file holds, at most about
BRIEF = 1              # places a token of the first bound, at least


def bands(percent: int, largest: int) -> list[tuple[int, int, int]]:
    """(least size, largest size, H) of bands; smaller sets than the first only link if equal."""
    h = lambda n: n * (100 - percent) // percent
    low = next(n for n in range(1, 102) if h(n) or n == 101)
    out = []
    while low <= largest:
        high = max(low, int(low * BAND))
        out.append((low, high, h(high)))
        low = high + 1
    return out


def allocate(low: int, high: int, h: int) -> tuple[int, int, int]:
    """Numbers of segments of weight 1 and 2 and the spare weight E, at the least cost for a set of the band."""
    def cost(one: int, two: int, spare: int) -> float:
        t = (low + high) / 2 / (one + two)
        few = one * math.exp(-t) + 2 * two * (1 + t) * math.exp(-t)  # weight with too few tokens
        u = t * (1 - COMMON)
        crowds = one * (math.exp(-u) - math.exp(-t)) + two * ((1 + u) * math.exp(-u) - (1 + t) * math.exp(-t))
        below, term = 0.0, math.exp(-few)
        for k in range(spare + 1):
            below += term
            term *= few / (k + 1)
        return one + two * (1 + t) + CROWD_COST * (crowds + max(0.0, 1 - below) * few)
    shapes = []
    for spare in SPARE:
        total = h + 1 + spare
        shapes += [(total - 2 * two, two, spare) for two in sorted({total // 2 * i // 8 for i in range(9)})]
    return min(shapes, key=lambda x: cost(*x))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; wraps on purpose."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sets:
    """Sorted distinct n-gram hashes of whole texts."""

    def __init__(self, n: int):
        self.n, self.known = n, {}

    def __call__(self, text: str | None) -> np.ndarray:
        import xxhash

        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space only
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(known) > CACHE_WORDS:
            known.clear()
        n = min(self.n, len(h))
        out = np.zeros(len(h) - n + 1, np.uint64)
        for j in range(n):
            out = _mix(out * np.uint64(3) + h[j:len(h) - n + 1 + j])
        return np.unique(out)


def signatures(tokens: np.ndarray, scheme: int, one: int, two: int, spare: int = -1) -> np.ndarray:
    """Bucket keys of a set in one band's scheme, without those of empty subsets if ``spare`` allows it."""
    m = one + two
    seg = ((tokens >> np.uint64(17)) % np.uint64(m)).astype(np.int64)
    order = np.argsort(seg, kind="stable")
    seg, val = seg[order], _mix(tokens[order] + np.uint64(0x9E3779B97F4A7C15))
    sums, size = np.zeros(m, np.uint64), np.bincount(seg, minlength=m)
    at = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
    sums[seg[at]] = np.add.reduceat(val, at)
    name = _mix((np.arange(m, dtype=np.uint64) << np.uint64(20)) + np.uint64(scheme + 1))
    few = (size[:one] == 0).sum() + 2 * (size[one:] < 2).sum()
    least = 1 if few <= spare else 0
    keys = _mix(sums ^ name)[size >= least]
    if two:
        late = (seg >= one) & (size[seg] > least)
        less = _mix((sums[seg[late]] - val[late]) ^ name[seg[late]])
        keys = np.concatenate([keys, less])
    return np.unique(keys)


def _node(tokens: np.ndarray) -> int:
    total = np.add.reduce(_mix(tokens ^ np.uint64(0xD6E8FEB86659FD93)))
    return int(_mix(np.array([total + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def _sign(n: int, schemes: list[tuple[int, int, int, int, int, int]], percent: int):
    """schemes: (low, high, H, one, two, spare) by band."""
    lows = [s[0] for s in schemes]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = Sets(n)
        for batch in batches:
            for a in range(0, len(batch), 500):
                part, rows = batch.iloc[a:a + 500], []
                for doc, text, tag in zip(part["id"], part["text"], part["tag"], strict=True):
                    t = sets(text)
                    b = int(np.searchsorted(lows, len(t), side="right")) - 1
                    keys, top = [], b
                    while b >= 0 and (b == top or percent * len(t) <= 100 * schemes[b][1]):
                        keys.append(signatures(t, b, *schemes[b][3:]))
                        b -= 1
                    keys = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
                    rows.append((doc, tag, len(t), _node(t) if len(t) else 0, keys))
                yield pd.DataFrame(rows, columns=["id", "tag", "n", "node", "keys"])
    return run


def _bits(tokens: np.ndarray) -> bytes:
    """One bit a token, in 8 places a token or more (a power of two)."""
    m = max(64, 1 << (8 * len(tokens) - 1).bit_length())
    out = np.zeros(m, bool)
    out[((tokens >> np.uint64(9)) & np.uint64(m - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def _tokens(n: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = Sets(n)
        for batch in batches:
            for a in range(0, len(batch), 500):
                ts = [t for t in map(sets, batch["text"].iloc[a:a + 500]) if len(t)]
                yield pd.DataFrame({"node": np.array([_node(t) for t in ts], np.int64), "n": np.array([len(t) for t in ts], np.int32),
                                    "bits": [_bits(t) for t in ts], "tokens": [t.tobytes() for t in ts]})
    return run


def _briefly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``bits`` in BRIEF places a token or more."""
    for batch in batches:
        brief = []
        for n, b in zip(batch["n"].tolist(), batch["bits"], strict=True):
            m = max(64, 1 << (BRIEF * n - 1).bit_length())
            brief.append(np.bitwise_or.reduce(np.frombuffer(b, np.uint64).reshape(-1, m // 64)).tobytes())
        yield pd.DataFrame({"node": batch["node"], "n": batch["n"], "bits": brief})


def _most_shared(nx: int, bx: bytes, ny: int, by: bytes) -> int:
    """An upper bound of the tokens that two sets share: a token whose bit the other set lacks isn't shared."""
    x, y = np.frombuffer(bx, np.uint64), np.frombuffer(by, np.uint64)
    while len(x) > len(y):  # bits of fewer places: halves laid over each other
        x = x[:len(x) // 2] | x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] | y[len(y) // 2:]
    return min(nx - int(np.bitwise_count(x & ~y).sum()), ny - int(np.bitwise_count(y & ~x).sum()))


def _possible(percent: int):
    """Pairs whose sizes and bits allow a link."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for nx, bx, ny, by in zip(batch["nx"].tolist(), batch["bx"], batch["ny"].tolist(), batch["by"], strict=True):
                keep.append(min(nx, ny) * 100 >= percent * max(nx, ny)
                            and (100 + percent) * _most_shared(nx, bx, ny, by) >= percent * (nx + ny))
            yield batch.loc[np.array(keep, bool), ["u", "v", "nx"]] if keep else batch[["u", "v", "nx"]]
    return run


def _linked(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = 0
                if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[np.array(keep, bool), ["u", "v"]] if keep else batch[["u", "v"]]
    return run


def _cell(tokens: np.ndarray) -> np.ndarray:
    return ((tokens >> np.uint64(37)) % np.uint64(CELLS)).astype(np.int64)


def _count_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(CELLS, np.int64)
    for batch in batches:
        for t in batch["tokens"]:
            counts += np.bincount(_cell(np.frombuffer(t, np.uint64)), minlength=CELLS)
    at = np.flatnonzero(counts)
    yield pd.DataFrame({"cell": at, "c": counts[at]})


def _rarest(counts: np.ndarray, percent: int):
    """The rarest n-grams of each set, as many as two similar sets can't both miss."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, t in zip(batch["node"], batch["tokens"], strict=True):
                t = np.frombuffer(t, np.uint64)
                first = len(t) - (percent * len(t) + 99) // 100 + 1
                rare = t[np.lexsort((t, counts[_cell(t)]))[:first]]
                yield pd.DataFrame({"node": np.full(len(rare), node, np.int64), "rare": rare.view(np.int64),
                                    "after": np.arange(len(t), len(t) - len(rare), -1), "n": np.full(len(rare), len(t))})
    return run


def _mixed(b: DataFrame) -> DataFrame:
    """Members (key, node, label) of the buckets with two labels or more, with the bucket's
    largest label and number of members. Members are exchanged once, for the counts and for themselves."""
    b = b.repartition("key")
    rest = [F.col(c) for c in b.columns if c not in ("key", "label")]  # never null; counted, so that both sides read the same exchange
    sums = b.groupBy("key", "label").agg(F.call_function("count", *rest).alias("c")).groupBy("key").agg(
        F.max(F.struct("c", "label")).alias("m"), F.sum("c").alias("members"), F.count(F.lit(1)).alias("k")).where("k > 1")
    return b.join(sums.select("key", F.col("m.label").alias("main"), "members"), "key")


def _apart(b: DataFrame, percent: int | None = None) -> DataFrame:
    """Pairs (u, v) of nodes of one bucket under different labels; with ``percent``, those whose
    n-grams from the shared one on (``after``) can still be enough for a link of sets of sizes n."""
    few = b.where("label <> main").select("key", *[F.col(c).alias(f"_{c}") for c in b.columns if c != "key"])
    differ = (F.col("label") != F.col("_label")) & ((F.col("label") == F.col("main")) | (F.col("label") < F.col("_label")))
    if percent is not None:
        differ &= F.least("after", "_after") * (100 + percent) >= percent * (F.col("n") + F.col("_n"))
    return few.join(b, "key").where(differ).select(F.least("_node", "node").alias("u"), F.greatest("_node", "node").alias("v"))


def _dealt(b: DataFrame, salt: int) -> DataFrame:
    """Members of crowded buckets dealt into cells of about ROOM nodes."""
    cell = F.pmod(F.xxhash64("node", F.lit(salt)), F.ceil(F.col("members") / ROOM))
    return b.select(F.xxhash64("key", cell).alias("key"), "node", "label")


def _by_rarity(b: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Nodes of crowded buckets by each of their rarest n-grams."""
    nodes = _if_few(cut_lineage(b.select("node", "label").distinct()))
    own = sets.select("node", "tokens").join(nodes, "node")
    counts = np.zeros(CELLS, np.int64)
    for r in own.select("tokens").mapInPandas(_count_cells, "cell long, c long").groupBy("cell").agg(F.sum("c").alias("c")).collect():
        counts[r["cell"]] = r["c"]  # CELLS rows at most
    rare = own.select("node", "tokens").mapInPandas(_rarest(counts, percent), "node long, rare long, after long, n long")
    return rare.join(nodes, "node").withColumnRenamed("rare", "key")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node reachable, for nodes with an edge. Alternating large and small stars."""
    e = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    seen, parts = None, 1 + e.count() // EDGES  # rounds never have more edges; each file of few rows costs as much as a full one
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
            least.select("u", F.col("m").alias("v"))).distinct()
        e = cut_lineage(e.coalesce(parts))
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    top = e.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(top).groupBy("node").agg(F.min("label").alias("label"))


def _if_few(ids: DataFrame) -> DataFrame:
    """Ids broadcast when there are at most BROADCAST_NODES of them; longer lists shuffle."""
    return F.broadcast(ids) if ids.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES else ids


def _sets_of(sets: DataFrame, ids: Column, pairs: DataFrame) -> DataFrame:
    """Sets of the nodes on one side of the pairs."""
    return sets.join(_if_few(pairs.select(ids.alias("node")).distinct()), "node", "left_semi")


def _once_each(sets: DataFrame, at: str) -> tuple[DataFrame, str]:
    """The sets stored at ``at``, each node's once, and where they are then: rows that repeat a chosen doc_id repeat its sets."""
    if sets.groupBy("node").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
        return sets, at
    spark, to = sets.sparkSession, scratch_path(sets.sparkSession, "sets")
    sets.dropDuplicates(["node"]).write.parquet(to)
    drop_scratch(spark, at)
    return spark.read.parquet(to), to


def _turns(pairs: DataFrame, load: float) -> Iterator[DataFrame]:
    """The pairs (u, v) in ``load`` parts, rounded up, one after another; each one's shuffle files go before the next begins."""
    n = max(1, math.ceil(load))
    for k in range(n):
        yield pairs.where(F.pmod(F.xxhash64("u", "v"), F.lit(n)) == k).select("u", "v")
        release(pairs.sparkSession)


def _sketched(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v, nx) that may link by the sketches (node, n, bits) of their sets."""
    x = sketches.select(F.col("node").alias("u"), F.col("n").alias("nx"), F.col("bits").alias("bx"))
    y = sketches.select(F.col("node").alias("v"), F.col("n").alias("ny"), F.col("bits").alias("by"))
    both = pairs.select("u", "v").join(x, "u").join(y, "v").select("u", "v", "nx", "bx", "ny", "by")
    return cut_lineage(both.mapInPandas(_possible(percent), "u long, v long, nx int"))


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that link: first by sizes, a few bits and a byte a token, which rule out nearly all others, then exactly on whole
    sets. ``sets`` has each node once."""
    bits = sets.select("node", "n", "bits")
    sizes = _if_few(sets.select("node", "n"))
    pairs = pairs.join(sizes.select(F.col("node").alias("u"), F.col("n").alias("nx")), "u").join(
        sizes.select(F.col("node").alias("v"), F.col("n").alias("ny")), "v")
    pairs = cut_lineage(pairs.where(F.least("nx", "ny") * 100 >= percent * F.greatest("nx", "ny")).select("u", "v"))
    brief = cut_lineage(bits.mapInPandas(_briefly, "node long, n int, bits binary"))
    # what pairs carry goes many times, once for each pair of a node: they take turns. The sets of a turn's own nodes
    # are no more than what its pairs carry
    own = bits.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("c")).first()
    size = own["n"] or 1
    once = max(8 * size / SET_SHARE, min(8 * size, TURN_BYTES))
    near = None
    for now in _turns(pairs, pairs.count() * (size / max(own["c"], 1)) / once):  # a byte a token, if no pair is ruled out before
        some = _sketched(now, brief, percent)
        ends = some.select(F.col("u").alias("node")).union(some.select(F.col("v").alias("node"))).distinct()
        some = _sketched(some, bits.join(_if_few(ends), "node", "left_semi"), percent)
        near = some if near is None else near.union(some)
    out = None
    for now in _turns(near, 8 * (near.agg(F.sum("nx")).first()[0] or 0) / once):
        whole = sets.select("node", "tokens")
        x = _sets_of(whole, F.col("u"), now).select(F.col("node").alias("u"), F.col("tokens").alias("x"))
        y = _sets_of(whole, F.col("v"), now).select(F.col("node").alias("v"), F.col("tokens").alias("y"))
        some = cut_lineage(now.join(x, "u").join(y, "v").select("u", "v", "x", "y").mapInPandas(_linked(percent), "u long, v long"))
        out = some if out is None else out.union(some)
        del x, y
    return out


def _labelled(docs: DataFrame, n: int, percent: int, tag: Column) -> DataFrame:
    """doc_id, ``tag`` (a long from doc_id and text), n (distinct n-grams), node and label, the component's, of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schemes = [(low, high, h, *allocate(low, high, h)) for low, high, h in bands(percent, LARGEST)]

    at = scratch_path(spark, "signed")
    # ids travel as text: pandas would make floats of a nullable column
    told = rows.select(F.col("doc_id").cast("string").alias("id"), "text", tag.alias("tag"))
    told.mapInPandas(_sign(n, schemes, percent), "id string, tag long, n int, node long, keys array<long>").select(
        F.col("id").cast("long").alias("doc_id"), "tag", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"), "keys",
        F.size("keys").alias("n_keys")).write.parquet(at)
    stored = spark.read.parquet(at)
    signed = cut_lineage(stored.select("doc_id", "tag", "n", "node"))
    # rows whose set another row has: the one with the smallest doc_id signs for them
    same = signed.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    copies = signed.select("doc_id", "node").join(same, "node").where("doc_id <> _first").select("doc_id", "node").distinct()
    s = stored.where("n_keys > 0").select("doc_id", "node", "keys").join(_if_few(cut_lineage(copies)), ["doc_id", "node"], "left_anti")
    buckets_at = scratch_path(spark, "buckets")
    turns = min(KEY_TURNS, 1 + (stored.agg(F.sum("n_keys")).first()[0] or 0) // TURN_KEYS)
    # every signature is exchanged once; keys of a single node end there
    w = Window.partitionBy("key")
    for k in range(turns):
        mine = s.select(F.explode(F.filter("keys", lambda key: F.pmod(key, F.lit(turns)) == k)).alias("key"), "node")  # noqa: B023
        met = mine.select("key", "node", F.min("node").over(w).alias("lead"), F.max("node").over(w).alias("_last"))
        met.where("lead < _last").drop("_last").distinct().write.mode("append").parquet(buckets_at)
        del mine, met
        release(spark)
    buckets = spark.read.schema("key long, node long, lead long").parquet(buckets_at)
    del s, stored
    drop_scratch(spark, at)
    release(spark)

    nodes = buckets.select("node").distinct()
    ids = cut_lineage(signed.join(nodes, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id")))
    wanted = _if_few(ids.select(F.col("doc_id").alias("_id")).distinct())
    chosen = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")
    at = scratch_path(spark, "sets")
    chosen.mapInPandas(_tokens(n), "node long, n int, bits binary, tokens binary").write.parquet(at)
    unpacked, at = _once_each(spark.read.parquet(at), at)

    led = buckets.where("node <> lead").groupBy("node", "lead").agg(F.count(F.lit(1)).alias("c"))
    stars = cut_lineage(led.groupBy("node").agg(F.max_by("lead", F.struct("c", "lead")).alias("lead")).select(
        F.col("lead").alias("u"), F.col("node").alias("v")))
    labels = cut_lineage(components(_verify(stars, unpacked, percent)))
    # a label is the link that stands for all that made it
    grown = lambda labels, more: components(labels.select(F.col("node").alias("u"), F.col("label").alias("v")).union(more))
    of = lambda b, labels: b.select("key", "node").join(_if_few(labels), "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label"))
    b = cut_lineage(_mixed(of(buckets, labels)))
    del led, nodes, buckets
    drop_scratch(spark, buckets_at)
    for salt in range(ROUNDS):
        pairs = cut_lineage(_apart(_mixed(_dealt(b.where(F.col("members") > CROWD), salt))).distinct())
        release(spark)
        more = _verify(pairs, unpacked, percent)
        linked = more.count()
        if not linked:
            break
        labels = cut_lineage(grown(labels, more))
        b = cut_lineage(_mixed(of(b, labels)))
        if 10 * linked < pairs.count():
            break
    apart = _apart(b.where(F.col("members") <= CROWD))
    crowded = b.where(F.col("members") > CROWD)
    if not crowded.isEmpty():
        apart = apart.union(_apart(cut_lineage(_mixed(_by_rarity(crowded, unpacked, percent))), percent))
        release(spark)
    rest = apart.distinct().join(
        stars.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")), ["u", "v"], "left_anti")
    rest = cut_lineage(rest)
    del apart, crowded, b
    release(spark)
    more = _verify(rest, unpacked, percent)
    final = labels if more.isEmpty() else grown(labels, more)
    named = cut_lineage(signed.join(final, "node", "left").select("doc_id", "tag", "n", "node", F.coalesce("label", "node").alias("label")))
    drop_scratch(spark, at)
    return named


def ngram_components(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    named = _labelled(docs, n, percent, F.lit(0).cast("long"))
    # every label's smallest doc_id; a label with one row needs no join, the planner splits hot ones
    least = named.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, "label", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                      F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One input row of each component: the one with the smallest doc_id (rows without doc_id come
    last), of its texts that with the least hash. Rows without words are no copies; equal rows once."""
    mark = F.xxhash64(F.col("text").cast("string"))
    c = _labelled(docs, n, percent, mark)
    first = c.where("n > 0").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("f"))
    keep = first.select("f.doc_id", "f.tag").union(c.where("n = 0").select("doc_id", "tag").distinct())
    times = c.groupBy(F.col("doc_id").alias("_d"), F.col("tag").alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("tag").eqNullSafe(F.col("_g"))
    keep = cut_lineage(keep.join(times, same).select(F.col("doc_id").alias("_k"), F.col("tag").alias("_t"), "_n"))
    named = T.as_row(docs)
    mine = F.xxhash64(F.col("_row.text").cast("string")) == F.col("_t")
    found = F.col("_row.doc_id").cast("long").eqNullSafe(F.col("_k")) & mine
    once = named.join(keep.where("_n = 1"), found, "left_semi").select("_row.*")
    again = keep.where("_n > 1")
    if again.isEmpty():
        return once
    # only rows that others equal in doc_id and text are compared once more
    return once.unionByName(named.join(again, found, "left_semi").select("_row.*").dropDuplicates(["doc_id", "text"]))


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Components of all documents under links of 3-word shingle sets."""
    return ngram_components(T.table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i:i + 2], ' ') AS g
      FROM (SELECT r, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
m AS (SELECT x, min(doc_id) AS component_id FROM reach JOIN d ON d.r = y GROUP BY x)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN m ON m.x = d.r
"""
