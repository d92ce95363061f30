"""SimHash fingerprints and near-duplicate groups by pigeonring filtering.

A fingerprint has 64 bits.  For a radius t the bits are cut into t+1 segments on a ring.  If two fingerprints differ in
at most t bits, the ring has a segment from which every chain of k consecutive segments holds at most
``floor(k*t/(t+1))`` differing bits: none in the first segment, at most one in the first two, and so on.  The index keys
take the first two links of that chain: equal first segment, and one of the two halves of the second segment equal (one
differing bit spares a half).  Pairs that share a key must pass the whole chain, then the full Hamming check.

Documents of equal fingerprint are one node (named by their smallest id) before anything is paired, so exact copies cost
nothing.  A key shared by more than ``CROWD`` fingerprints isn't paired: its fingerprints go an exact way instead, which
is linear.  Every one of them names the 65 fingerprints within one bit of itself; those that name a common one differ in
at most two bits, and any two that differ in at most two bits name a common one, so linking them to the smallest of the
at most 65 that name it loses no link of the group.

``near_duplicates`` finds texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.  Its first
candidates are texts whose fingerprints differ in at most two bits, by the same index.  Such fingerprints alone would miss
similar texts, so an exact search follows for what they leave apart, by prefixes: shingles have one order for all texts, frequent ones last, and two texts that are similar enough share one of
the first ``n - ceil(0.8 n) + 1`` shingles of either.  The members of every key are first held against its smallest one.
Where that leaves members of a key unconnected, all pairs among them are looked at, in blocks of ``SLICE`` members against
the others, and no pair is handed out that places, numbers and parity bitmaps of the shingles rule out; so nothing is lost
to a dissimilar head.  Every candidate is verified on the whole texts, unless other links connect its ends already.

Groups are connected components by alternating large-star and small-star steps, each cut to the shared folder.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, arrays_batch, cut, few, portions, remove, shared_folder, table

BITS = 64
#: Fingerprints under one index key that are paired with each other; beyond it the linear way is taken.
CROWD = 48
_LANES = np.arange(8, dtype=np.int64) * 256
_BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of the word shingles, repeats included; a shorter text is one shingle, an empty one none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - size]]
    cuts = map(slice, starts, [e - 1 for e in ends[size - 1 :]])
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), itertools.repeat(42)), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half the hashes; signed 64-bit."""
    if not len(hashes):
        return 0
    lanes = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _LANES).ravel(), minlength=2048).reshape(8, 256)
    bits = (lanes @ _BIT_OF_BYTE).ravel() * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """(id, fp) for each row; null and empty texts have fingerprint zero.  Only the two named columns are read."""

    def run(batches):
        for batch in (p for b in batches for p in portions(b, "text")):
            fps = [fingerprint(shingle_hashes(t or b"", size)) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield arrays_batch({"id": batch.column("id"), "fp": pa.array(fps, pa.int64())})

    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id bigint, fp bigint")


def _segments(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of radius+1 segments."""
    n = radius + 1
    at = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(at)]


def _part(fp: F.Column, first: int, width: int) -> F.Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def _keys(fp: F.Column, radius: int) -> F.Column:
    """Array of index keys; the last six bits tell segment and half."""
    cuts, out = _segments(radius), []
    for i, (first, width) in enumerate(cuts):
        if radius == 0:
            return F.array(fp)
        second, span = cuts[(i + 1) % len(cuts)]
        left = span // 2
        for half, (at, bits) in enumerate(((second, left), (second + left, span - left))):
            value = F.shiftleft(_part(fp, first, width), bits).bitwiseOR(_part(fp, at, bits))
            out.append(F.shiftleft(value, 6).bitwiseOR(F.lit(2 * i + half)))
    return F.array(*out)


def _chain(a: F.Column, b: F.Column, radius: int) -> F.Column:
    """Whether some segment starts a chain that stays within its proportional budgets all the way round, and the full distance is in the radius."""
    cuts, x, ways = _segments(radius), a.bitwiseXOR(b), []
    for i in range(len(cuts)):
        mask, links = 0, []
        for k in range(1, len(cuts) + 1):
            first, width = cuts[(i + k - 1) % len(cuts)]
            mask |= ((1 << width) - 1) << first
            signed = mask - (1 << 64) if mask >> 63 else mask
            links.append(F.bit_count(x.bitwiseAND(F.lit(signed))) <= k * radius // len(cuts))
        way = links[0]
        for link in links[1:]:
            way = way & link
        ways.append(way)
    some = ways[0]
    for way in ways[1:]:
        some = some | way
    return some & (F.bit_count(x) <= radius)


def links(nodes: DataFrame, *, radius: int = 2, crowd: int = CROWD) -> DataFrame:
    """(a, b), a < b: links between nodes (node, fp) of different fingerprints, enough of them to connect every pair within the radius.

    nodes must have one row for each fingerprint and no null.  Radius 0, 1 or 2.
    """
    if radius not in (0, 1, 2):
        raise ValueError("radius must be 0, 1 or 2")
    if radius == 0:
        return nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    keyed = nodes.select("node", "fp", F.explode(_keys(F.col("fp"), radius)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = cut(keyed.join(sizes, "key"))
    few = shared.filter(F.col("n") <= crowd)
    left, right = few.select("key", F.col("node").alias("a"), F.col("fp").alias("fa")), few.select("key", F.col("node").alias("b"), F.col("fp").alias("fb"))
    paired = left.join(right, "key").filter((F.col("a") < F.col("b")) & _chain(F.col("fa"), F.col("fb"), radius)).select("a", "b")
    crowded = shared.filter(F.col("n") > crowd).select("node", "fp").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)))
    named = crowded.select("node", "fp", F.explode(F.concat(F.array("fp"), flips)).alias("hub"))
    hubs = named.groupBy("hub").agg(F.min("node").alias("a"), F.count("*").alias("n"), F.max(F.when(F.col("hub") == F.col("fp"), F.col("node"))).alias("own")).filter("n > 1")
    if radius == 2:
        around = named.join(hubs, "hub").filter(F.col("node") > F.col("a")).select("a", F.col("node").alias("b"))
    else:  # one bit: only to a fingerprint that exists itself
        around = named.join(hubs, "hub").filter("own is not null and own != node").select(F.least("own", "node").alias("a"), F.greatest("own", "node").alias("b"))
    return paired.unionByName(around).distinct()


def _labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges, ascending, and the smallest node of each one's component."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v, label = at[: len(a)], at[len(a) :], np.arange(len(ids))
    while True:
        after, m = label.copy(), np.minimum(label[u], label[v])
        np.minimum.at(after, label[u], m)
        np.minimum.at(after, label[v], m)
        while not np.array_equal(after, after[after]):
            after = after[after]
        if np.array_equal(after, label):
            return ids, ids[label]
        label = after


def components(edges: DataFrame, *, most_rounds: int = 60, at_once: int = BROADCAST_ROWS) -> DataFrame:
    """(node, component) of every node that an edge (a, b) names; component is the smallest node of its connected component.

    Loops are ignored; an empty table gives an empty one.  At most at_once edges (of two numbers each) are one task's work: the rounds
    of star steps would cost thousands of tasks for a few megabytes.
    """

    def run(batches):
        found = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
        node, component = _labels(*(np.concatenate([np.zeros(0, np.int64), *[f[i] for f in found]]) for i in (0, 1)))
        yield arrays_batch({"node": node, "component": component})

    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    if now.count() <= at_once:
        return now.coalesce(1).mapInArrow(run, "node bigint, component bigint")
    for _ in range(most_rounds):
        # large star: every larger neighbour of u is linked to the smallest of u and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        after = cut(small)
        change = now.unionByName(after).groupBy("u", "v").agg(F.count("*").alias("n")).filter("n = 1").limit(1).count()
        now = after
        if not change:
            tips = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return tips.unionByName(tips.select(F.col("component").alias("node"), "component").distinct())
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def groups(fps: DataFrame, *, radius: int = 2) -> DataFrame:
    """(id, fp, component_id) for each row of (id, fp): the smallest id reachable over links of at most radius differing bits.

    Rows with a null id get the component of their fingerprint (null if no row of it has an id) but link nothing.
    """
    nodes = cut(fps.groupBy("fp").agg(F.min("id").alias("node")).filter("node is not null"))
    found = components(links(nodes, radius=radius))
    named = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return fps.join(named, "fp", "left").select("id", "fp", "component_id")


#: One text in so many is asked which shingles are frequent; of those found in FREQUENT of them or more, the MOST_FREQUENT commonest
#: go to the end of the order (a megabyte to each worker, whatever the input's size).
SAMPLE, FREQUENT, MOST_FREQUENT = 16, 4, 1 << 16
#: Members of a key that one block holds in memory against all others of the key.
SLICE = 512
#: Bits of the parity bitmaps that blocks compare; whole bitmaps have this many or more.
BLOCK_BITS = 1024


def _frequent(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of at most MOST_FREQUENT common shingles and their counts in a sample of the texts.  Only the order of shingles rests on it."""

    def run(batches):
        for batch in (p for b in batches for p in portions(b, "text")):
            found = [np.unique(shingle_hashes(t or b"", size)) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield arrays_batch({"w": pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64))})

    some = rows.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).distinct()
    counts = some.mapInArrow(run, "w bigint").groupBy("w").agg(F.count("*").alias("n")).filter(F.col("n") >= FREQUENT)
    counts = counts.orderBy(F.desc("n"), "w").limit(MOST_FREQUENT).toArrow()
    w, n = counts.column("w").to_numpy().astype(np.int64).view(np.uint64), counts.column("n").to_numpy().astype(np.int64)
    order = np.argsort(w)
    return w[order], n[order]


def prefix(h: np.ndarray, least: float, hot: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, int]:
    """The first shingles of a text (h: sorted, distinct) in one order for all texts: by hash, the frequent ones behind by count and
    hash; and how many of them aren't frequent.

    Sets of similarity least or more share at least least * n shingles of either, so their prefixes share one.
    """
    need = len(h) - math.ceil(least * len(h) - 1e-9) + 1 if len(h) else 0
    if not len(hot):
        return h[:need], need
    at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
    often = hot[at] == h
    rare = h[~often][:need]
    if len(rare) == need:
        return rare, need
    behind = h[often]
    return np.append(rare, behind[np.argsort(count[at[often]], kind="stable")][: need - len(rare)]), len(rare)


def parities(h: np.ndarray) -> bytes:
    """A bitmap of at least two bits a shingle: whether an odd number of the shingles (h: distinct) has a box's low bits.

    Two bitmaps differ in at most as many bits as the sets in shingles.  Of unequal lengths (powers of two) the longer one is folded.
    """
    bits = max(BLOCK_BITS, 1 << (2 * len(h) - 1).bit_length()) if len(h) else BLOCK_BITS
    odd = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bitmaps: np.ndarray, size: int) -> np.ndarray:
    """Rows of bitmaps (bytes) folded to size bytes each, as 64-bit words."""
    if bitmaps.shape[1] != size:
        bitmaps = np.bitwise_xor.reduce(bitmaps.reshape(len(bitmaps), -1, size), axis=1)
    return np.ascontiguousarray(bitmaps).view(np.uint64)


def _signatures(rows: DataFrame, size: int, least: float) -> DataFrame:
    """(id, text_a, text_b: the word sequence's hashes, fp: the fingerprint, n: shingles, bits: their parities, firsts: their prefix, rare: how many of it aren't frequent)."""
    shared = rows.sparkSession.sparkContext.broadcast(_frequent(rows, size))

    def run(batches):
        for batch in (p for b in batches for p in portions(b, "text")):
            columns = [[] for _ in range(7)]
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                joined = b" ".join((text or b"").lower().split())
                every = shingle_hashes(text or b"", size)
                h = np.unique(every)
                firsts, rare = prefix(h, least, *shared.value)
                for c, v in zip(columns, (xxhash.xxh64_intdigest(joined, 1) - (1 << 63), xxhash.xxh64_intdigest(joined, 2) - (1 << 63), fingerprint(every), len(h), parities(h), firsts.view(np.int64), rare), strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int32())
            yield arrays_batch({"id": batch.column("id")} | {k: pa.array(v, t) for k, v, t in zip(("text_a", "text_b", "fp", "n", "bits", "firsts", "rare"), columns, kinds, strict=True)})

    return rows.mapInArrow(run, "id bigint, text_a bigint, text_b bigint, fp bigint, n bigint, bits binary, firsts array<bigint>, rare int")


def alike(nodes: DataFrame, *, radius: int = 2) -> DataFrame:
    """(a, b), a < b: pairs of texts (node, fp) that connect all whose fingerprints differ in at most radius bits: each text with the
    smallest of its fingerprint, and these by the index."""
    own = cut(nodes.groupBy("fp").agg(F.min("node").alias("node"), F.count("*").alias("n")))
    shared = few(cut(own.filter("n > 1").select("fp", F.col("node").alias("a"))))
    same = nodes.join(shared, "fp").filter("node > a").select("a", F.col("node").alias("b"))
    return same.unionByName(links(own.select("node", "fp"), radius=radius))


def _most_apart(na, nb, least: float):
    """How many shingles sets of na and nb shingles can differ in at a similarity of least."""
    return (na + nb) * ((1 - least) / (1 + least)) + 1e-6


def _possible(pairs: DataFrame, prints: DataFrame, least: float) -> DataFrame:
    """(a, b) of the pairs whose parities allow the similarity."""

    def run(batches):
        for batch in (p for b in batches for p in portions(b, "bits_a", "bits_b")):
            raw = [batch.column(k).to_pylist() for k in ("bits_a", "bits_b")]
            sizes = np.array([[len(v) for v in side] for side in raw], np.int64).reshape(2, -1)
            most = _most_apart(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), least)
            good = np.zeros(batch.num_rows, bool)
            for la, lb in np.unique(sizes, axis=1).T.tolist():
                at = np.flatnonzero((sizes[0] == la) & (sizes[1] == lb))
                for lo in range(0, len(at), max(1, (1 << 22) // max(la, lb))):
                    some = at[lo : lo + max(1, (1 << 22) // max(la, lb))]
                    x, y = (folded(np.frombuffer(b"".join([side[i] for i in some.tolist()]), np.uint8).reshape(len(some), -1), min(la, lb)) for side in raw)
                    good[some] = np.bitwise_count(x ^ y).sum(1) <= most[some]
            yield batch.select(["a", "b"]).filter(pa.array(good))

    full = pairs.join(prints.toDF("a", "n_a", "bits_a"), "a").join(prints.toDF("b", "n_b", "bits_b"), "b")
    return full.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a bigint, b bigint").distinct()


def _similar(pairs: DataFrame, size: int, least: float) -> DataFrame:
    """(a, b) of the rows (a, b, text_of_a, text_of_b) whose shingle sets are similar enough."""

    def run(batches):
        for batch in (p for b in batches for p in portions(b, "text_of_a", "text_of_b")):
            keep = []
            for x, y in zip(*(batch.column(k).cast(pa.binary()).to_pylist() for k in ("text_of_a", "text_of_b")), strict=True):
                left, right = (np.unique(shingle_hashes(t or b"", size)) for t in (x, y))
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(both >= least * (len(left) + len(right) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "text_of_a", "text_of_b").mapInArrow(run, "a bigint, b bigint")


class _Members:
    """Some members of one key as arrays."""

    NAMES = ("node", "part", "n", "at", "bits")

    def __init__(self, *columns: np.ndarray) -> None:
        self.node, self.part, self.n, self.at, self.bits = columns

    def rows(self, which) -> _Members:
        return _Members(*[getattr(self, c)[which] for c in self.NAMES])

    def plus(self, other: _Members) -> _Members:
        return _Members(*[np.concatenate([getattr(self, c), getattr(other, c)]) for c in self.NAMES])

    def pairs(self, other: _Members, least: float, *, itself: bool = False) -> list[tuple[np.ndarray, np.ndarray]]:
        """Node pairs with other (itself: each once) of different parts that places, numbers and parities of shingles allow."""
        out, step = [], max(1, (1 << 18) // max(1, len(other.node)))
        for lo in range(0, len(self.node), step):
            own = self.rows(slice(lo, lo + step))
            most = np.minimum((own.n - own.at)[:, None], (other.n - other.at)[None])
            fits = (own.part[:, None] != other.part[None]) & (most >= (own.n[:, None] + other.n[None]) * (least / (1 + least)) - 1e-6)
            if itself:
                fits &= np.arange(lo, lo + len(own.node))[:, None] < np.arange(len(other.node))[None]
            i, j = np.nonzero(fits)
            for k in range(0, len(i), 1 << 15):
                x, y = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
                good = np.bitwise_count(own.bits[x] ^ other.bits[y]).sum(1) <= _most_apart(own.n[x], other.n[y], least)
                out.append((own.node[x[good]], other.node[y[good]]))
        return out


def _across(members: DataFrame, least: float) -> DataFrame:
    """(a, b): pairs of members (w, slice, slices, node, part, n, at, bits) of one key and different parts that may be similar.

    The key's members are dealt to slices; each slice stands in one task's memory, and the members of later slices pass it by.
    """

    def run(batches):
        key, held = None, None
        for batch in batches:
            w, block, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("w", "block", "own"))
            if not len(w):
                continue
            bits = np.concatenate([folded(np.frombuffer(v, np.uint8)[None], BLOCK_BITS // 8) for v in batch.column("bits").to_pylist()])
            every = _Members(*[batch.column(c).to_numpy() for c in _Members.NAMES[:-1]], bits)
            edges = np.flatnonzero((np.diff(w) != 0) | (np.diff(block) != 0) | (np.diff(own.astype(np.int8)) != 0)) + 1
            found = []
            for lo, hi in itertools.pairwise([0, *edges.tolist(), len(w)]):
                some = every.rows(slice(lo, hi))
                if (w[lo], block[lo]) != key:
                    key, held = (w[lo], block[lo]), None
                if held is not None:
                    found += held.pairs(some, least)
                if own[lo]:
                    found += some.pairs(some, least, itself=True)
                    held = some if held is None else held.plus(some)
            a, b = (np.concatenate([np.zeros(0, np.int64), *[f[k] for f in found]]) for k in (0, 1))
            yield arrays_batch({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    dealt = members.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), "slice"))).withColumn("own", F.col("block") == F.col("slice"))
    dealt = dealt.repartition("w", "block").sortWithinPartitions("w", "block", F.desc("own"))
    return dealt.select("w", "block", "own", *_Members.NAMES).mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, least: float = 0.8, slice_rows: int = SLICE) -> DataFrame:
    """(id, component_id) for each row of df with an id: the smallest id of its group of equal and near-duplicate texts.

    Texts are equal if their words are, with A-Z lower-cased.  Null and empty texts are equal.  Rows of one id are one
    document: their texts belong to one group.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    place = shared_folder(spark, "signatures")
    _signatures(rows, size, least).write.parquet(place)
    signed = spark.read.parquet(place)
    same = ["text_a", "text_b"]
    node = F.min("id").alias("node")
    entries = signed.groupBy(*same).agg(node, *[F.first(c).alias(c) for c in ("firsts", "rare")]).select("node", "rare", F.posexplode("firsts").alias("at", "w"))
    # rare shingles have small groups, a window's task holds many; frequent ones are combined before the shuffle and joined
    every = Window.partitionBy("w")
    seldom = entries.filter("at < rare").withColumns({"many": F.count("*").over(every), "head": F.min("node").over(every)}).filter("many > 1")
    often = entries.filter("at >= rare")
    heads = often.groupBy("w").agg(F.count("*").alias("many"), F.min("node").alias("head")).filter("many > 1")
    names = ["w", "node", "at", "many", "head"]
    keyed = cut(seldom.select(*names).unionByName(often.join(heads, "w").select(*names)))
    place = shared_folder(spark, "parities")
    asked = few(cut(keyed.select("node").distinct()))
    signed.join(asked, signed["id"] == asked["node"]).groupBy("node", *same).agg(F.first("n").alias("n"), F.first("bits").alias("bits")).select("node", "n", "bits").write.parquet(place)
    prints = spark.read.schema("node bigint, n bigint, bits binary").parquet(place)

    def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """The links among pairs (written already).  The texts of b travel to those of a."""
        later = texts.toDF("b", "text_of_b").join(few(pairs), "b")
        heads = texts.toDF("a", "text_of_a").join(few(cut(pairs.select("a").distinct())), "a")
        return cut(_similar(later.join(heads, "a"), size, least).distinct())

    def apart_by(pairs: DataFrame, found: DataFrame) -> DataFrame:
        """The pairs whose ends the components don't connect."""
        part = lambda x: found.toDF(x, f"part_{x}")
        return pairs.join(part("a"), "a", "left").join(part("b"), "b", "left").filter("coalesce(part_a, a) != coalesce(part_b, b)").select("a", "b")

    def linked(pairs: DataFrame, known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """All links among pairs that connect anything, with the known ones, and the components: each node's pair with the
        smallest other first, then those whose ends are still apart."""
        pairs = cut(_possible(pairs, prints, least))
        wanted = few(cut(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()))
        place = shared_folder(spark, "candidate-texts")
        own = rows.join(wanted, rows["id"] == wanted["node"]).groupBy("node", F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"))
        own.select("node", "text").write.parquet(place)
        texts = spark.read.schema("node bigint, text string").parquet(place)
        first = cut(pairs.groupBy("b").agg(F.min("a").alias("a")))
        near = verified(first, texts)
        near = near if known is None else near.unionByName(known)
        found = cut(components(near))
        rest = cut(apart_by(pairs.join(first.toDF("b", "tried"), "b").filter("a != tried").select("a", "b"), found))
        if not rest.isEmpty():
            near = near.unionByName(verified(rest, texts))
            found = cut(components(near))
        remove(spark, place)
        return near, found

    # a text without a key shares no prefix with any other, so it is similar to none and its pairs go
    near, found = linked(alike(cut(signed.groupBy(*same).agg(node, F.first("fp").alias("fp")).select("node", "fp"))), None)
    heads = keyed.filter("node > head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    near, found = linked(apart_by(heads, found), near)
    # a key whose members beside the head are all connected by now holds no further link
    others = keyed.filter("node > head").join(found, "node", "left").withColumn("part", F.coalesce("component", "node"))
    apart = others.groupBy("w").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("w")
    others = others.join(apart, "w").join(prints, "node")
    others = others.withColumn("slice", F.pmod(F.xxhash64("node", "w"), F.ceil(F.col("many") / slice_rows)))
    cross = cut(_across(others.select("w", "slice", *_Members.NAMES), least))
    if not cross.isEmpty():
        found = linked(cross, near)[1]
    named = signed.groupBy(*same).agg(node).join(found, "node", "left").select(*same, F.coalesce("component", "node").alias("component_id"))
    return signed.select("id", *same).join(named, same).select("id", "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest id stays, once; rows without an id can't be told apart and stay."""
    found = cut(near_duplicates(docs))
    surplus = found.groupBy("id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("n"))
    gone = surplus.filter("component_id < id").select(F.col("id").alias("__id"))
    left = docs.join(gone, docs["doc_id"] == gone["__id"], "left_anti")
    again = surplus.filter("n > 1 and component_id = id").select(F.col("id").alias("__id"))
    if again.isEmpty():
        return left
    return left.join(again, left["doc_id"] == again["__id"], "left_anti").unionByName(left.join(again, left["doc_id"] == again["__id"], "left_semi").dropDuplicates(["doc_id"]))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    fps = cut(fingerprints(table(spark, sf_dir, "documents"), size=3))
    return groups(fps).select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op4_simhash_dedup": op4_simhash_dedup}
