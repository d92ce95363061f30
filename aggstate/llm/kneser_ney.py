"""Language-model scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark.

Counting.  Each task hashes its texts' words (64 bits), makes every bigram of a few megabytes of text distinct with its
count, and hands out one compressed block for each shard.  A bigram's shard is chosen by its context's hash and, within
that, by its word's, so the bigrams of a frequent context are spread over ``SPREAD`` shards, or one in 64 of all.  There is
a shard for each ``SHARD_BYTES`` of input as Spark estimates it, so a task's memory doesn't grow with the input.  Its task merges its
blocks, writes the sorted hash array and the counts into the shared folder, and returns sums by word: count, number of
different contexts, and as a context its total and how many continuations were seen once, twice and more often.  Those
sums are added up and written as sorted hash arrays too, by ranges of the hash.

Scoring.  Workers memory-map the arrays, so the model takes page cache instead of heap, and look up each batch's distinct
bigrams by binary search.  Files are written under a task's own name and renamed, so a repeated task does no harm.  The
shared folder must be a path that all workers can open (a ``file:`` URI or a mounted path).

The model: p(w | v) = max(c(vw) - D(c(vw)), 0) / c(v) + g(v) p(w), with g(v) the discounts taken from v's continuations
over c(v), and p(w) the same over continuation counts, interpolated with 1 / (V + 1).  Discounts follow from the counts of
counts.  A context that was not seen leaves p(w).  Probabilities over the V known tokens and one unknown sum to one.

Null and empty texts are the end token alone.  Rows with a null id count as training rows.  Repeated rows count each
time.  An empty training table gives every token probability one.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, U64, arrays_batch, blocks, byte_class, mix64, shared_folder, string_buffer, table, words_of

END, BEGIN = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
#: Shards that the bigrams of one context are spread over at least.
SPREAD = 8
#: Bytes of input (as stored) for each shard.
SHARD_BYTES = 2 << 20
#: Tasks that the shards are dealt to at most; a task takes one after the other.
MOST_TASKS = 1 << 15
#: Arrays that a worker keeps mapped at a time.
MAPPED = 8192
#: Tokens whose bigrams are made distinct together before they are handed out.
PORTION = 4_000_000
LEAST_DISCOUNT = 0.05


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(context * U64(0x9E3779B97F4A7C15) ^ word)


def spread_of(shards: int) -> int:
    return max(SPREAD, shards // 64)


def shard_of(context: np.ndarray, word: np.ndarray, shards: int) -> np.ndarray:
    spread = spread_of(shards)
    return ((context >> U64(20)) % U64(max(1, shards // spread)) * U64(spread) + (word >> U64(20)) % U64(spread)).astype(np.int64)


def shards_for(df: DataFrame) -> int:
    """Shards by the size of df's input; by the session's shuffle partitions where Spark doesn't know it (tables of the driver)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    shards = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if size >= 1 << 60 else -(-size // SHARD_BYTES)
    return max(2, -(-shards // SPREAD)) * SPREAD


def tokens_of(column: pa.Array):
    """For blocks of the column's rows: (first row, tokens, contexts, first token of each row with the end)."""
    lower, word = byte_class(SPACES)
    data, offsets = string_buffer(column)
    for lo, hi in blocks(offsets):
        words, row, _, _ = words_of(data, offsets[lo : hi + 1], lower, word)
        ends = np.cumsum(np.bincount(row, minlength=hi - lo) + 1)
        tokens = np.full(int(ends[-1]), END)
        tokens[np.arange(len(words)) + row] = words
        contexts = np.roll(tokens, 1)
        contexts[np.append(0, ends[:-1])] = BEGIN
        yield lo, tokens, contexts, np.append(0, ends)


def _distinct(context: np.ndarray, word: np.ndarray, count: np.ndarray | None, by: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct bigrams in order of by (their key), with counts."""
    order = np.argsort(by, kind="stable")
    by = by[order]
    first = np.flatnonzero(np.append(True, by[1:] != by[:-1])) if len(by) else np.zeros(0, np.int64)
    sums = np.diff(np.append(first, len(by))) if count is None else np.add.reduceat(count[order], first) if len(by) else np.zeros(0, np.int64)
    return context[order[first]], word[order[first]], sums.astype(np.int64), by[first]


def _counting(shards: int):
    def count(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        held: list[tuple] = []
        size = 0

        def portion():
            nonlocal held, size
            context, word = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            context, word, n, _ = _distinct(context, word, None, pair_key(context, word))
            shard = shard_of(context, word, shards)
            order = np.lexsort((context, shard))
            context, word, n, shard = context[order], word[order], n[order], shard[order]
            edges = np.searchsorted(shard, np.arange(shards + 1))
            held, size = [], 0
            full = np.flatnonzero(np.diff(edges))
            out = []
            for s in full.tolist():
                a, b = edges[s], edges[s + 1]
                fresh = np.append(True, context[a + 1 : b] != context[a : b - 1])
                runs = np.diff(np.append(np.flatnonzero(fresh), b - a)).astype("<u4")
                out.append(np.array([b - a, len(runs)], "<u4").tobytes() + squeeze.compress(context[a:b][fresh].tobytes() + runs.tobytes() + n[a:b].astype("<u4").tobytes() + word[a:b].tobytes()))
            return arrays_batch({"shard": full.astype(np.int32), "block": pa.array(out, pa.binary())})

        for batch in batches:
            for _, tokens, contexts, _ in tokens_of(batch.column("text")):
                held.append((contexts, tokens))
                size += len(tokens)
                if size >= PORTION:
                    yield portion()
        if held:
            yield portion()

    return count


def _open_block(block: bytes) -> tuple[np.ndarray, ...]:
    n, runs = np.frombuffer(block, "<u4", 2).tolist()
    raw = zstandard.ZstdDecompressor().decompress(block[8:], max_output_size=runs * 12 + n * 12)
    at = runs * 8
    context = np.repeat(np.frombuffer(raw, U64, runs), np.frombuffer(raw, "<u4", runs, at))
    at += runs * 4
    return context, np.frombuffer(raw[at + n * 4 :], U64, n), np.frombuffer(raw, "<u4", n, at).astype(np.int64)


def local_path(uri: str) -> str:
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"workers can't memory-map {uri}; name a mounted path")
    return unquote(parts.path)


def _save(folder: str, name: str, **arrays: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    for kind, array in arrays.items():
        own = f"{folder}/.{name}-{kind}-{uuid.uuid4().hex}"
        with open(own, "wb") as f:
            f.write(np.ascontiguousarray(array).tobytes())
        os.replace(own, f"{folder}/{name}.{kind}")


WORD_SUMS = ("n", "contexts", "total", "once", "twice", "more")


def _merging(folder: str):
    def merge(key, group):
        parts = [_open_block(b) for b in group.column("block").to_pylist()]
        context, word, n = (np.concatenate([p[k] for p in parts]) for k in range(3))
        context, word, n, keys = _distinct(context, word, n, pair_key(context, word))
        _save(folder, f"pairs-{key[0].as_py()}", keys=keys, counts=n.astype("<u8"))
        names, where = np.unique(np.concatenate([word, context]), return_inverse=True)
        w, c = where[: len(word)], where[len(word) :]
        total = lambda at, weights=None: np.bincount(at, weights=weights, minlength=len(names)).astype(np.int64)
        sums = {"n": total(w, n), "contexts": total(w), "total": total(c, n), "once": total(c[n == 1]), "twice": total(c[n == 2]), "more": total(c[n > 2])}
        # how often each small count occurs goes along under a key that no word can have in the sums
        small = np.bincount(np.minimum(n, 5), minlength=6)[1:5]
        return pa.table({"kind": pa.array([0] * len(names) + [1] * 4, pa.int32()), "word": np.append(names.view(np.int64), np.arange(1, 5)), **{k: np.append(v, small if k == "n" else np.zeros(4, np.int64)) for k, v in sums.items()}})

    return merge


def discounts(counts_of_counts: dict[int, int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how many items were seen 1 to 4 times."""
    n1, n2, n3, n4 = (counts_of_counts.get(k, 0) for k in (1, 2, 3, 4))
    if not (n1 and n2):
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2]
    return np.array([0.0, *[min(max(d, LEAST_DISCOUNT), k - 0.0) for k, d in enumerate(raw, 1)]])


def train(df: DataFrame, *, text_col: str = "text", shards: int | None = None) -> dict:
    """Counts df's texts and writes the arrays; returns where they are and the few numbers that all words share."""
    spark = df.sparkSession
    chosen = df.select(F.col(text_col).alias("text"))
    shards = max(2, -(-shards // SPREAD)) * SPREAD if shards else shards_for(chosen)
    folder = local_path(shared_folder(spark, "ngrams"))
    blocks_ = chosen.mapInArrow(_counting(shards), "shard int, block binary")
    merged = blocks_.repartition(min(shards, MOST_TASKS), "shard").groupBy("shard").applyInArrow(_merging(folder), "kind int, word bigint, " + ", ".join(f"{k} bigint" for k in WORD_SUMS))
    sums = merged.groupBy("kind", "word").agg(*[F.sum(k).alias(k) for k in WORD_SUMS])
    place = f"{shared_folder(spark, 'words')}"
    sums.write.parquet(place)
    words = spark.read.parquet(place)
    of_pairs = {r["word"]: r["n"] for r in words.filter("kind = 1").collect()}
    words = words.filter("kind = 0")
    known = words.filter("n > 0")
    head = known.agg(F.count("*").alias("v"), F.sum("n").alias("tokens"), F.sum("contexts").alias("types")).first()
    of_words = {r["few"]: r["k"] for r in known.groupBy(F.least("contexts", F.lit(5)).alias("few")).agg(F.count("*").alias("k")).collect()}
    d1 = discounts(of_words)
    spared = sum(k * d1[min(few, 3)] for few, k in of_words.items())
    ranges = shards
    top = F.pmod(F.shiftrightunsigned("word", 40), F.lit(ranges)).cast("int")

    def save(key, group):
        names = group.column("word").to_numpy().view(U64)
        order = np.argsort(names)
        values = np.stack([group.column(k).to_numpy()[order] for k in WORD_SUMS], 1).astype("<i8")
        _save(folder, f"words-{key[0].as_py()}", keys=names[order], sums=values)
        return pa.table({"range": pa.array([key[0].as_py()], pa.int32()), "rows": pa.array([len(order)], pa.int64())})

    words.withColumn("range", top).repartition(min(ranges, MOST_TASKS), "range").groupBy("range").applyInArrow(save, "range int, rows bigint").agg(F.sum("rows")).collect()
    return {"folder": folder, "shards": shards, "ranges": ranges, "v": head["v"], "tokens": head["tokens"] or 0, "types": head["types"] or 0, "d1": d1, "d2": discounts(of_pairs), "spared": float(spared)}


class Lookup:
    """The arrays of a model, mapped when they are first needed."""

    def __init__(self, model: dict) -> None:
        self.m, self.maps = model, {}

    def open(self, name: str, second: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
        if name not in self.maps:
            if len(self.maps) >= MAPPED:
                self.maps.clear()
            files = [f"{self.m['folder']}/{name}.{k}" for k in ("keys", second)]
            if os.path.exists(files[0]) and os.path.getsize(files[0]):
                values = np.memmap(files[1], kind, "r")
                self.maps[name] = np.memmap(files[0], U64, "r"), values.reshape(-1, len(WORD_SUMS)) if second == "sums" else values
            else:
                self.maps[name] = np.zeros(0, U64), np.zeros((0, len(WORD_SUMS)) if second == "sums" else 0, np.int64)
        return self.maps[name]

    def _find(self, keys: np.ndarray, part: np.ndarray, prefix: str, second: str, kind: str, out: np.ndarray) -> np.ndarray:
        order = np.lexsort((keys, part))
        edges = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1])) if len(order) else []
        for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
            own = order[a:b]
            names, values = self.open(f"{prefix}-{int(part[own[0]])}", second, kind)
            if len(names):
                at = np.minimum(np.searchsorted(names, keys[own]), len(names) - 1)
                hit = names[at] == keys[own]
                out[own[hit]] = values[at[hit]]
        return out

    def words(self, names: np.ndarray) -> np.ndarray:
        """The sums of each word (distinct), zeros for others."""
        part = ((names >> U64(40)) % U64(self.m["ranges"])).astype(np.int64)
        return self._find(names, part, "words", "sums", "<i8", np.zeros((len(names), len(WORD_SUMS)), np.int64))

    def pairs(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        return self._find(pair_key(context, word), shard_of(context, word, self.m["shards"]), "pairs", "counts", "<u8", np.zeros(len(word), np.int64))

    def score(self, tokens: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training count and log10 probability of each token after its context."""
        m = self.m
        names, where = np.unique(np.concatenate([tokens, contexts]), return_inverse=True)
        sums = self.words(names)
        key = pair_key(contexts, tokens)
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        w, c = where[: len(tokens)][first], where[len(tokens) :][first]
        n = self.pairs(contexts[first], tokens[first])
        d1, d2 = m["d1"], m["d2"]
        if not m["types"]:
            return np.zeros(len(tokens), np.int64), np.zeros(len(tokens))
        lower = (np.maximum(sums[:, 1] - d1[np.minimum(sums[:, 1], 3)], 0) + m["spared"] / (m["v"] + 1)) / m["types"]
        total = sums[c, 2]
        safe = np.maximum(total, 1)
        back = np.where(total > 0, (sums[c, 3] * d2[1] + sums[c, 4] * d2[2] + sums[c, 5] * d2[3]) / safe, 1.0)
        p = np.where(total > 0, np.maximum(n - d2[np.minimum(n, 3)], 0) / safe, 0.0) + back * lower[w]
        return sums[where[: len(tokens)], 0], np.log10(p)[inverse]


def score(df: DataFrame, model: dict, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) for each row of df."""

    def run(batches):
        look = Lookup(model)
        scale = model["tokens"] + 0.1 * ((model["v"] or 0) + 1)
        for batch in batches:
            for lo, tokens, contexts, edges in tokens_of(batch.column("text")):
                n, p = look.score(tokens, contexts)
                size = np.diff(edges)
                yield arrays_batch({
                    "id": batch.column("id").slice(lo, len(size)), "n_tokens": size, "n_known": np.add.reduceat((n > 0).astype(np.int64), edges[:-1]),
                    "base_score": np.add.reduceat(np.log10((n + 0.1) / scale), edges[:-1]), "score": np.add.reduceat(p, edges[:-1]),
                })

    chosen = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, f"id {chosen.schema['id'].dataType.simpleString()}, n_tokens bigint, n_known bigint, base_score double, score double")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    model = train(docs.filter(~held_out))
    out = score(docs, model).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model["tokens"]).cast("bigint").alias("train_tokens"), "base_score", "score")


QUERIES = {"op5_lm_scoring": op5_lm_scoring}
