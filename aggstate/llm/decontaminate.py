"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted similarity.

An item of n words is compared with windows of n words (the whole text, if it is shorter).  Words are lower-cased
runs of letters, digits and non-ASCII characters; shingles have five words (an item of fewer words is one shingle, and so are its
windows).  A shingle's weight is ``1 + ln(N / df)`` over the N items (null ones left out), repeats included.  The similarity of two multisets
of shingles is the sum of the smaller weights over the sum of the larger ones.

Only windows that hold a shingle of an item can have a similarity over zero; those are fingerprinted, all of them, from
running sums.  The fingerprints are looked up in eight blocks of eight bits: with a radius of 23, one block differs in
at most two bits, so probing each block's value and its neighbours within two bits finds every item in the radius.
Windows at a similarity of 0.8 differ in 9 to 10 bits on average; none of 4000 random ones lay outside the radius (the
tests repeat the measurement).  Candidates are verified by the exact similarity (0.8 or more), those whose common weight
can't reach it or the best so far are left out; of an item's windows in a document the most similar one is kept, of
equals the first.  Long texts are read in segments of ``SEGMENT`` windows.

Null and empty texts and items match nothing.  Repeated rows are answered each.  Items are read in blocks of at most
``ITEMS`` items and about ``BLOCK_CHARS`` characters, and each block is held against all rows; one block is broadcast,
with the df over all items of every shingle that more than one item has.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NOT_ALPHANUMERIC, U64, arrays_batch, blocks, byte_class, mix64, string_buffer, table, words_of

SHINGLE, RADIUS, LEAST = 5, 23, 0.8
ITEMS, BLOCK_CHARS = 4096, 32 << 20
SEGMENT = 8192
_SIEVE = 20


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of size words, by the first word's place."""
    n = max(0, len(words) - size + 1)
    h = np.zeros(n, U64)
    for k in range(size):
        h = mix64(h * U64(0x9E3779B97F4A7C15) + words[k : k + n])
    return h


def signs(h: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each hash."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64) * 2 - 1


def pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of sums; sums that differ by rounding alone agree."""
    return np.packbits(np.round(sums, 6) > 0, axis=1, bitorder="little").view(U64).ravel()


def item_shingles(text: str, size: int) -> tuple[int, int, np.ndarray]:
    """(words in a shingle, words, shingles) of an item."""
    data = np.frombuffer(text.encode(), np.uint8)
    words = words_of(data, np.array([0, len(data)]), *byte_class(NOT_ALPHANUMERIC))[0]
    k = min(size, len(words))
    return k, len(words), shingles(words, k)


def repeated_shingles(items: DataFrame, size: int = SHINGLE) -> dict[int, dict[int, int]]:
    """By shingle size: in how many of all items (text) a shingle is, for those in more than one."""

    def run(batches):
        for batch in batches:
            found = [(k, np.unique(h)) for k, _, h in (item_shingles(t, size) for t in batch.column("text").to_pylist())]
            k = np.concatenate([np.zeros(0, np.int32), *[np.full(len(h), k, np.int32) for k, h in found]])
            yield arrays_batch({"k": k, "w": np.concatenate([np.zeros(0, U64), *[h for _, h in found]]).view(np.int64)})

    counts = items.select("text").mapInArrow(run, "k int, w bigint").groupBy("k", "w").agg(F.count("*").alias("n")).filter("n > 1").toArrow()
    out: dict[int, dict[int, int]] = {}
    for k, w, n in zip(counts.column("k").to_pylist(), counts.column("w").to_numpy().astype(np.int64).view(U64).tolist(), counts.column("n").to_pylist(), strict=True):
        out.setdefault(k, {})[w] = n
    return out


class Index:
    """What one block of items needs: shingles with weights and places, fingerprints, and the multi-index blocks, by shingle size."""

    def __init__(self, items: list[tuple[int, str]], size: int = SHINGLE, radius: int = RADIUS, total: int | None = None, df: dict[int, dict[int, int]] | None = None) -> None:
        """df: what repeated_shingles gives over all items, if these are only some of them."""
        self.size, self.radius, self.parts = size, radius, {}
        by_size: dict[int, list] = {}
        for item, text in items:
            k, words, h = item_shingles(text, size)
            if words:
                by_size.setdefault(k, []).append((item, words, h))
        total = total or sum(map(len, by_size.values()))
        for k, members in by_size.items():
            counts = Counter(x for _, _, h in members for x in set(h.tolist())) if df is None else df.get(k, {})
            part = {"ids": [m[0] for m in members], "words": np.array([m[1] for m in members]), "bags": [Counter(m[2].tolist()) for m in members]}
            pairs = np.array([(x, i) for i, m in enumerate(members) for x in set(m[2].tolist())], dtype=U64).reshape(-1, 2)
            pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
            part["keys"], first = np.unique(pairs[:, 0], return_index=True)
            part["first"], part["owner"] = np.append(first, len(pairs)), pairs[:, 1].astype(np.int64)
            part["rare"] = 1 + math.log(total)
            often = sorted(x for x, n in counts.items() if n > 1)  # of other blocks' items too; all others weigh as rare ones
            part["often"] = np.array(often, U64)
            part["weight"] = np.array([1 + math.log(total / counts[x]) for x in often])
            part["sieve"] = np.zeros(1 << _SIEVE, bool)
            part["sieve"][(part["keys"] >> U64(64 - _SIEVE)).astype(np.int64)] = True
            part["lookup"] = dict(zip(often, part["weight"].tolist(), strict=True))
            prints = np.concatenate([pack((signs(m[2]) * self.weights(part, m[2])[:, None]).sum(0, keepdims=True)) for m in members])
            part["prints"] = prints
            part["sets"] = [np.unique(m[2]) for m in members]
            part["heavy"] = [float(self.weights(part, m[2]).sum()) for m in members]
            probes = np.zeros((8, 256, len(members)), bool)
            values = prints.view(np.uint8).reshape(-1, 8)
            near = radius // 8
            variants = [v for v in range(256) if v.bit_count() <= near]
            for j in range(8):
                for v in variants:
                    probes[j, values[:, j] ^ v, np.arange(len(members))] = True
            part["probes"] = probes
            self.parts[k] = part

    @staticmethod
    def weights(part: dict, h: np.ndarray) -> np.ndarray:
        if not len(part["often"]):
            return np.full(len(h), part["rare"])
        at = np.minimum(np.searchsorted(part["often"], h), len(part["often"]) - 1)
        return np.where(part["often"][at] == h, part["weight"][at], part["rare"])

    def similarity(self, part: dict, item: int, window: list[int]) -> float:
        """Weighted Jaccard similarity of a window's shingles with an item's."""
        bag, own, look, rare = part["bags"][item], Counter(window), part["lookup"], part["rare"]
        low = sum(look.get(x, rare) * min(n, own[x]) for x, n in bag.items() if x in own)
        high = sum(look.get(x, rare) * max(n, own.get(x, 0)) for x, n in bag.items()) + sum(look.get(x, rare) * n for x, n in own.items() if x not in bag)
        return low / high

    def row(self, part: dict, k: int, h: np.ndarray, hits: np.ndarray, least: float) -> list[tuple[int, int, int, int, float]]:
        """(item id, first word, words, distance, similarity) for each item that a row with shingles h has; hits: places of items' shingles."""
        at = np.searchsorted(part["keys"], h[hits])
        counts = part["first"][at + 1] - part["first"][at]
        owner = part["owner"][np.arange(int(counts.sum())) + np.repeat(part["first"][at] - np.cumsum(counts) + counts, counts)]
        place = np.repeat(hits, counts)  # each owner's hit
        best: dict[int, tuple] = {}
        for size in np.unique(part["words"][owner] - k + 1).tolist():
            own = part["words"][owner] - k + 1 == size
            span, mine, items = min(size, len(h)), place[own], owner[own]
            # a row can hold far-apart hits: windows are made around each run of them
            gaps = np.flatnonzero(np.diff(mine) > 2 * span)
            runs = zip(np.append(0, gaps + 1).tolist(), np.append(gaps, len(mine) - 1).tolist(), strict=True)
            for a, b in runs:
                begin, end = max(0, int(mine[a]) - span + 1), min(len(h) - span, int(mine[b])) + 1
                for lo in range(begin, end, SEGMENT):
                    hi = min(lo + SEGMENT, end) + span - 1
                    x, y = np.searchsorted(mine, (lo, hi))
                    if x < y:
                        self.segment(part, k, h[lo:hi], lo, span, mine[x:y] - lo, np.unique(items[x:y]), least, best)
        return [best[i] for i in sorted(best)]

    def segment(self, part: dict, k: int, h: np.ndarray, lo: int, span: int, hits: np.ndarray, items: np.ndarray, least: float, best: dict[int, tuple]) -> None:
        """Adds to best what the windows of span shingles in h hold of items; lo: the place of h's first shingle."""
        weight = self.weights(part, h)
        sums = np.zeros((len(h) + 1, 64))
        np.cumsum(signs(h) * weight[:, None], axis=0, out=sums[1:])
        touched = np.zeros(len(h) + 1, np.int64)
        touched[hits + 1] = 1
        touched = np.cumsum(touched)
        starts = np.arange(len(h) - span + 1)
        starts = starts[touched[starts + span] > touched[starts]]
        prints = pack(sums[starts + span] - sums[starts])
        values = prints.view(np.uint8).reshape(-1, 8)
        some = np.zeros((len(starts), len(items)), bool)
        for j in range(8):
            some |= part["probes"][j][values[:, j][:, None], items[None]]
        distance = np.bitwise_count(prints[:, None] ^ part["prints"][items][None])
        some &= distance <= self.radius
        total = np.append(0.0, np.cumsum(weight))
        for column, i in enumerate(items.tolist()):
            rows = np.flatnonzero(some[:, column])
            if not len(rows):
                continue
            # the common weight is at most that of the window's shingles that the item has, and the item's own
            common = np.append(0.0, np.cumsum(np.where(np.isin(h, part["sets"][i]), weight, 0.0)))
            at = starts[rows]
            most = np.minimum(common[at + span] - common[at], part["heavy"][i])
            most = most / (part["heavy"][i] + total[at + span] - total[at] - most) + 1e-9
            for r in np.lexsort((at, -most)).tolist():
                if most[r] < max(least, best[i][4] if i in best else 0.0):
                    break
                start = lo + int(at[r])
                sim = self.similarity(part, i, h[int(at[r]) : int(at[r]) + span].tolist())
                if sim >= least - 1e-9 and (i not in best or (-sim, start) < (-best[i][4], best[i][1])):
                    best[i] = (part["ids"][i], start, span + k - 1, int(distance[rows[r], column]), sim)

    def scan(self, column: pa.Array, least: float) -> list[tuple[int, tuple]]:
        """(row of the batch, match) in order of rows."""
        lower, word = byte_class(NOT_ALPHANUMERIC)
        data, offsets = string_buffer(column)
        out = []
        for lo, hi in blocks(offsets):
            words, row, _, _ = words_of(data, offsets[lo : hi + 1], lower, word)
            begin = np.searchsorted(row, np.arange(hi - lo + 1))
            for k, part in self.parts.items():
                h = shingles(words, k)
                at = np.flatnonzero(part["sieve"][(h >> U64(64 - _SIEVE)).astype(np.int64)])
                at = at[row[at] == row[at + k - 1]]
                found = np.minimum(np.searchsorted(part["keys"], h[at]), len(part["keys"]) - 1)
                at = at[part["keys"][found] == h[at]]
                owner = row[at]
                for r in np.unique(owner).tolist():
                    own = at[np.searchsorted(owner, r) : np.searchsorted(owner, r, "right")] - begin[r]
                    mine = h[begin[r] : begin[r + 1] - k + 1]
                    out += [(lo + r, m) for m in self.row(part, k, mine, own, least)]
        return out


def matches(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", least: float = LEAST, radius: int = RADIUS) -> DataFrame:
    """(id, item_id, start_word, n_words, distance, similarity): one row for each row of docs and item it holds."""
    spark = docs.sparkSession
    rows = items.select(F.col(item_col).alias("item"), F.lower(F.col(item_text)).alias("text")).filter("item is not null and text is not null")
    size = rows.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    parts = max(1, -(-size["n"] // ITEMS), -(-(size["chars"] or 0) // BLOCK_CHARS))
    chosen = docs.select(F.col(id_col).cast("bigint").alias("id"), F.lower(F.col(text_col)).alias("text"))
    df = repeated_shingles(rows) if parts > 1 else None
    out = None
    for b in range(parts):
        own = rows if parts == 1 else rows.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == b)
        index = Index([(r["item"], r["text"]) for r in own.orderBy("item", "text").collect()], radius=radius, total=size["n"], df=df)
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in batches:
                found = shared.value.scan(batch.column("text"), least)
                ids = batch.column("id").take(pa.array([r for r, _ in found], pa.int64()))
                columns = list(zip(*[m for _, m in found], strict=True)) or [[]] * 5
                yield arrays_batch({"id": ids, "item_id": pa.array(columns[0], pa.int64()), "start_word": pa.array(columns[1], pa.int64()), "n_words": pa.array(columns[2], pa.int64()), "distance": pa.array(columns[3], pa.int32()), "similarity": pa.array(columns[4], pa.float64())})

        part = chosen.mapInArrow(run, "id bigint, item_id bigint, start_word bigint, n_words bigint, distance int, similarity double")
        out = part if out is None else out.unionByName(part)
    return out


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; those without an id can't be told apart and stay."""
    found = matches(docs, table(spark, sf_dir, "benchmark")).select(F.col("id").alias("__id")).filter("__id is not null").distinct()
    return docs.join(found, docs["doc_id"] == found["__id"], "left_anti")


QUERIES = {"op8_benchmark_decontamination": op8_benchmark_decontamination}
