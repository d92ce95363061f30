"""What the operators share: lineage cuts in the shared folder, and word hashing over Arrow buffers.

Words are hashed straight from the Arrow string buffer, without a Python object for each word: a prefix sum of
``byte * B**i`` (mod 2**64) gives every word's polynomial hash as a difference, times ``B**-start``; a 64-bit finaliser
spreads it.  B is odd, therefore invertible.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Rows of an Arrow batch.  Spark counts rows, not bytes, and texts are long: its 10,000 would be tens of megabytes in each of several buffers.
BATCH_ROWS = 1024
#: Rows of a few numbers each that may be broadcast after counting them: at most 16 MB.
BROADCAST_ROWS = 1 << 19
#: Bytes hashed at a time: small enough for the arrays to stay in a core's cache.
CHUNK = 1 << 19


def text_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_ROWS rows, unless they are smaller already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def drop_shuffles(spark: SparkSession) -> None:
    """Lets every action delete its own shuffle files when it ends: nothing but a repeated run would read them, and that writes them anew.

    Otherwise they stay until the driver's heap is collected, and a chain of a hundred joins keeps several times its input on disk."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", True)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a folder of our own only where none is set and all runs on one machine."""
    text_batches(spark)
    drop_shuffles(spark)
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not folder and not context.master.startswith("local"):
            raise ValueError("a cluster must name its shared folder in spark.checkpoint.dir")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="aggstate-checkpoint-"))
    return folder or context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it from there, so that a lost executor costs no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def few(df: DataFrame) -> DataFrame:
    """df (written already, rows of a few numbers) for a join: broadcast if it has at most BROADCAST_ROWS rows, else as it is."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name (URI) below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of ours below the shared folder once nothing is read from it any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def masked(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns named by number, so that no name can clash with a helper's, and the new name of each."""
    names = {name: f"__c{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


@functools.cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(1 << bits, _BASE, U64), np.full(1 << bits, _INVERSE, U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def byte_class(separators: str) -> tuple[np.ndarray, np.ndarray]:
    """Tables by byte: A-Z in lower case, and whether the byte belongs to a word. separators: the other bytes, after lowering."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.ones(256, bool)
    word[[ord(c) for c in separators]] = False
    return lower, word[lower]


SPACES = "".join(map(chr, (32, *range(9, 14))))
NOT_ALPHANUMERIC = "".join(map(chr, (*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))))


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64, one more than rows) of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), ends


def blocks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most limit bytes, or of one row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, to
        row = to


def portions(batch: pa.RecordBatch, *columns: str, limit: int = 8 * CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about limit bytes of text in columns, so that Python holds no whole batch of strings."""
    if batch.num_rows:
        for lo, hi in blocks(np.sum([string_buffer(batch.column(c))[1] for c in columns], axis=0), limit):
            yield batch.slice(lo, hi - lo)


def _pieces(raw: np.ndarray, firsts: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of raw of about CHUNK bytes that part no word; firsts: where rows begin, ascending."""
    lo = 0
    while lo < len(raw):
        hi = lo + CHUNK
        k = int(np.searchsorted(firsts, hi))
        row = int(firsts[k]) if k < len(firsts) else len(raw)
        while hi < row:  # the next place outside a word, but not beyond the row
            free = np.flatnonzero(~word[raw[hi : min(row, hi + 4096)]])
            if len(free):
                row = hi + int(free[0])
            else:
                hi += 4096
        yield lo, min(row, len(raw))
        lo = min(row, len(raw))


def words_of(data: np.ndarray, offsets: np.ndarray, lower: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, ...]:
    """Every word of the rows whose bytes are data[offsets[0]:offsets[-1]]: hash, row, start and end byte (from offsets[0]).

    Long rows are read in pieces, so the working arrays are those of a few chunks (or of the longest word), not of the row.
    """
    base, total = int(offsets[0]), int(offsets[-1] - offsets[0])
    if total <= 2 * CHUNK:
        return _words_of(data, offsets, lower, word)
    found = []
    for lo, hi in _pieces(data[base : base + total], np.unique(offsets - base), word):
        own, row, starts, ends = _words_of(data, np.clip(offsets, base + lo, base + hi), lower, word)
        found.append((own, row, starts + lo, ends + lo))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _words_of(data: np.ndarray, offsets: np.ndarray, lower: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, ...]:
    base, total = int(offsets[0]), int(offsets[-1] - offsets[0])
    rows = len(offsets) - 1
    if total == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = data[base : base + total]
    inside = word[raw]
    first = (offsets[:-1] - base)[np.diff(offsets) > 0]  # the first bytes of rows
    fresh = np.empty(total, bool)
    fresh[0] = True
    np.logical_not(inside[:-1], out=fresh[1:])
    fresh[first] = True
    starts = np.flatnonzero(inside & fresh)
    last = np.empty(total, bool)
    last[-1] = True
    np.logical_not(inside[1:], out=last[:-1])
    last[first[1:] - 1] = True
    ends = np.flatnonzero(inside & last) + 1
    up, down = _powers(max(19, (total - 1).bit_length()))
    prefix = np.zeros(total + 1, U64)
    np.cumsum((lower[raw].astype(U64) + U64(1)) * up[:total], out=prefix[1:])
    hashes = mix64((prefix[ends] - prefix[starts]) * down[starts] ^ (ends - starts).astype(U64))
    counts = np.searchsorted(starts, offsets - base)
    return hashes, np.repeat(np.arange(rows), np.diff(counts)), starts, ends


def hash_text(text: str, separators: str) -> list[int]:
    """The hashes of a text's words, as words_of gives them."""
    data = np.frombuffer(text.encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]), *byte_class(separators))[0].tolist()


def arrays_batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()], names=list(columns))
