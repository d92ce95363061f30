"""Aggregate states as columns: build, merge, finalise, guard.

Registers are merged as rows (key, bucket, rank) with a maximum, which Spark combines before the shuffle, so a group of any
size is no single task's memory.  A state column carries its family, K and origin as metadata, and ``merge_states`` refuses
to mix them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aggstate.functions import estimates as E
from aggstate.functions import registers as R


@dataclass(frozen=True)
class Family:
    """A kind of state: which K a sketch's column gets, how registers are written and read, and a state's estimate."""

    k_for: Callable[[int], int]
    encode: Callable[[np.ndarray, int], bytes]
    decode: Callable[[bytes, int], np.ndarray]
    from_sketch: Callable[[bytes, int], bytes]
    hashes: Callable[[bytes], np.ndarray | None] = lambda state: None  # noqa: E731, of a state that holds them all

    def estimate(self, state: bytes, k: int) -> float:
        small = self.hashes(state)
        return float(len(np.unique(small))) if small is not None else R.estimate(self.decode(state, k))


FAMILIES = {
    "hll": Family(lambda lg: lg, lambda v, k: None, R.sketch_registers, lambda s, k: s),
    "hll12": Family(lambda lg: 12, lambda v, k: R.encode_hll12(v), lambda s, k: R.decode_hll12(s), lambda s, k: R.hll12_from_sketch(s), R.hll12_small),
    "combined": Family(R.target_k, R.encode_combined, R.decode_combined, R.combined_from_sketch),
}


def tagged(column: Column, name: str, *, family: str, k: int, origin: str) -> Column:
    return column.alias(name, metadata={"family": family, "k": k, "origin": origin})


def tag(df: DataFrame, name: str) -> dict:
    return df.schema[name].metadata or {}


def hashed(value: Column) -> Column:
    """The integer hash of native states, as a signed 64-bit pattern."""

    @F.pandas_udf("bigint")
    def run(v: pd.Series) -> pd.Series:
        return pd.Series(R.int_hash64(v.to_numpy()).view(np.int64))

    return run(value.cast("bigint"))


def bucket_rank(hash_: Column, k: int) -> tuple[Column, Column]:
    tail = F.shiftrightunsigned(hash_, k)
    low = tail.bitwiseAND(-tail)
    return hash_.bitwiseAND(F.lit((1 << k) - 1)), F.when(tail == 0, F.lit(65 - k)).otherwise(F.bit_count(low - 1) + 1).cast("int")


def native(df: DataFrame, keys: Sequence[str], value: str, k: int) -> DataFrame:
    """(keys, bucket, rank) of integers; null values don't count."""
    known = df.filter(F.col(value).isNotNull()).select(*keys, hashed(F.col(value)).alias("h"))
    bucket, rank = bucket_rank(F.col("h"), k)
    return known.select(*keys, bucket.alias("bucket"), rank.alias("rank")).groupBy(*keys, "bucket").agg(F.max("rank").alias("rank"))


def opened(df: DataFrame, keys: Sequence[str], state: str, *, family: str, k: int) -> DataFrame:
    """(keys, bucket, rank) of binary states: hll (sketches), hll12 or combined; null states are empty."""
    read = lambda s: FAMILIES[family].decode(s, k)

    def run(batches):
        for batch in batches:
            where, bucket, rank = [], [], []
            for i, s in enumerate(batch.column("__state").to_pylist()):
                values = read(s)
                at = np.flatnonzero(values)
                where.append(np.full(len(at), i))
                bucket.append(at)
                rank.append(values[at])
            rows = np.concatenate(where) if where else np.zeros(0, np.int64)
            own = [batch.column(c).take(pa.array(rows)) for c in keys]
            rest = [pa.array(np.concatenate(x) if x else np.zeros(0), t) for x, t in ((bucket, pa.int64()), (rank, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*own, *rest], names=[*keys, "bucket", "rank"])

    chosen = df.select(*keys, F.col(state).alias("__state")).filter("__state is not null")
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "__state"], "bucket bigint, rank int"])
    return chosen.mapInArrow(run, schema)


def unite(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, "bucket").agg(F.max("rank").alias("rank"))


def estimates(rows: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """(keys, estimate) of united registers: linear counting up to 2.5 * 2**k while a bucket is empty, the raw estimate above."""
    m = 1 << k
    sums = rows.groupBy(*keys).agg(F.sum(F.pow(F.lit(2.0), -F.col("rank"))).alias("s"), F.count("*").alias("used"))
    zeros = F.lit(m) - F.col("used")
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (F.col("s") + zeros)
    return sums.select(*keys, F.when((raw <= 2.5 * m) & (zeros > 0), m * F.log(m / zeros)).otherwise(raw).alias("estimate"))


def sealed(rows: DataFrame, keys: Sequence[str], *, family: str, k: int) -> DataFrame:
    """(keys, state): united registers as binary states of hll12 or combined.  A group has at most 2**k rows."""
    write = FAMILIES[family].encode
    packed = rows.groupBy(*keys).agg(F.collect_list(F.shiftleft(F.col("bucket").cast("bigint"), 8).bitwiseOR(F.col("rank").cast("bigint"))).alias("packed"))
    chosen = packed.select("packed", *keys).toDF("packed", *[f"k{i}" for i in range(len(keys))])

    def run(batches):
        for batch in batches:
            found = batch.column("packed")
            values, edges = found.flatten().to_numpy(), np.append(0, np.cumsum(found.value_lengths().to_numpy()))
            states = []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                registers = np.zeros(1 << k, np.int64)
                registers[values[lo:hi] >> 8] = values[lo:hi] & 255
                states.append(write(registers, k))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(states, pa.binary())], names=[*batch.schema.names[1:], "state"])

    schema = [f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "packed"]
    return chosen.mapInArrow(run, ", ".join([*schema, "state binary"])).toDF(*keys, "state")


def merged_states(df: DataFrame, keys: Sequence[str], column: str, *, family: str, k: int) -> DataFrame:
    """(keys, column): the union of each key's states, as a state."""
    return sealed(unite(opened(df, keys, column, family=family, k=k), keys), keys, family=family, k=k).withColumnRenamed("state", column)


def finalised(state: Column, *, family: str, k: int = 12) -> Column:
    """The estimate of each row's own state; a small state of hll12 counts its hashes."""

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else FAMILIES[family].estimate(v, k)).astype(float)

    return run(state)


def direct(df: DataFrame, keys: Sequence[str], value: str, k: int) -> DataFrame:
    """(keys, estimate): distinct integers, exact up to 2**(k - 5) of them (as small containers are), estimated above."""
    exact = df.filter(F.col(value).isNotNull()).select(*keys, hashed(F.col(value)).alias("h")).groupBy(*keys, "h").agg(F.lit(1).alias("one"))
    bucket, rank = bucket_rank(F.col("h"), k)
    rows = exact.select(*keys, "h", bucket.alias("bucket"), rank.alias("rank"))
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n")).alias("n")
    found = estimates(unite(rows, keys), keys, k).alias("e")
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"e.{c}")) for c in keys]
    return counts.join(found, same).select(*[F.col(f"n.{c}").alias(c) for c in keys], F.when(F.col("n") <= 1 << (k - 5), F.col("n").cast("double")).otherwise(F.col("estimate")).alias("estimate"))


def column_ks(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """The K that each sketch column's states get: from its coarsest sketch, in one pass; 12 for a column without sketches."""
    lows = df.agg(*[F.min(F.conv(F.hex(F.substring(c, 4, 1)), 16, 10).cast("int")).alias(c) for c in columns]).first()
    return {c: 12 if lows[c] is None else R.target_k(lows[c]) for c in columns}


def merge_states(df: DataFrame, other: DataFrame, keys: Sequence[str], state: str, *, unsafe: bool = False) -> DataFrame:
    """(keys, estimate) over two tables of states of one family and K.  States of different origins hash differently, so mixing them
    would count everything twice; that raises, unless it is asked for."""
    a, b = tag(df, state), tag(other, state)
    if not a or (a["family"], a["k"]) != (b.get("family"), b.get("k")):
        raise TypeError(f"states of different types: {a} and {b}")
    if a["origin"] != b["origin"] and not unsafe:
        raise TypeError(f"states of different origins: {a['origin']} and {b['origin']}")
    rows = opened(df, keys, state, family=a["family"], k=a["k"]).unionByName(opened(other, keys, state, family=a["family"], k=a["k"]))
    return estimates(unite(rows, keys), keys, a["k"])


def checked_cast(state: Column, *, family: str, k: int = 12) -> Column:
    """state, if its type byte and size are right; else the query fails."""
    size, first = (R.hll12_size(), "01") if family == "hll12" else (R.layout(k)["size"], "03")
    good = (F.octet_length(state) == size) & (F.hex(F.substring(state, 1, 1)) == first)
    return F.when(state.isNull() | good, state).otherwise(F.raise_error(F.lit(f"not a {family} state")))


@F.pandas_udf(T.BinaryType())
def hll12_state(sketch: pd.Series) -> pd.Series:
    """A sketch carried over to the 12-bit state."""
    return sketch.map(lambda s: None if s is None else R.hll12_from_sketch(s))


def combined_state(sketch: Column, k: int) -> Column:
    @F.pandas_udf("binary")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else R.combined_from_sketch(v, k))

    return run(sketch)


def sketch_fields(sketch: Column) -> Column:
    """A sketch's header as a struct."""
    kind = "struct<pre_ints:int,ser_ver:int,family:int,lg_k:int,lg_arr:int,flags:int,count_or_min:int,mode:int,type:string,empty:boolean>"

    @F.pandas_udf(kind)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([R.preamble(v) for v in s])

    return run(sketch)


@F.pandas_udf(T.BinaryType())
def theta_state(sketch: pd.Series) -> pd.Series:
    """A theta sketch as a native state: its length (LEB128), then the compact sketch of serial version 3."""

    def one(data: bytes | None) -> bytes | None:
        if data is None:
            return None
        body, head = R.theta_uncompressed(data), b""
        n = len(body)
        while n > 127:
            head, n = head + bytes([n & 127 | 128]), n >> 7
        return head + bytes([n]) + body

    return sketch.map(one)


@F.pandas_udf(T.DoubleType())
def merged_estimate(joined: pd.Series) -> pd.Series:
    """The estimate of sketches given as comma-separated base64: 0 if there are none, -1 if any can't be read; six decimals."""
    import base64

    def one(text: str | None) -> float:
        try:
            parts = [base64.b64decode("".join(p.split()), validate=True) for p in (text or "").split(",") if p]
            if not parts:
                return 0.0
            k = min(R.preamble(p)["lg_k"] for p in parts)
            return round(R.estimate(R.union(*[R.sketch_registers(p, k) for p in parts])), 6)
        except Exception:  # parity with functions that must never stop a query
            return -1.0

    return joined.map(one)


# ---- HLL sketches as they are


def hll_estimate(sketch: Column) -> Column:
    """The estimate of each row's HLL sketch as a double (the built-in function rounds it)."""

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else E.estimate(v)).astype(float)

    return run(sketch)


def hll_bounds(sketch: Column, deviations: int = 2) -> Column:
    """A struct of estimate, lower and upper bound of each row's HLL sketch."""

    @F.pandas_udf("struct<estimate:double,lower:double,upper:double>")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(E.estimate(v), *E.bounds(v, deviations)) for v in s], columns=["estimate", "lower", "upper"], dtype=float)

    return run(sketch)


@F.pandas_udf(T.StringType())
def hll_summary(sketch: pd.Series) -> pd.Series:
    """Each row's HLL sketch in words."""
    return sketch.map(lambda v: None if v is None else E.summary(v))


@F.pandas_udf(T.StringType())
def hll_mode(sketch: pd.Series) -> pd.Series:
    """LIST, SET or HLL."""
    return sketch.map(lambda v: None if v is None else ("LIST", "SET", "HLL")[R.preamble(v)["mode"]])


@F.pandas_udf(T.StringType())
def container(state: pd.Series) -> pd.Series:
    """The container that a combined state's first byte names."""
    return state.map(lambda v: None if v is None else R.container(v))


def empty_sketch(lg_k: int) -> bytes:
    """An HLL sketch of nothing (list mode, 8-bit target)."""
    return bytes([2, 1, 7, lg_k, 3, 4, 0, 8])


def approx_distinct(df: DataFrame, keys: Sequence[str], sketch: str, lg_k: int = 12) -> DataFrame:
    """(keys, sketch, estimate): sketches united at 2**lg_k buckets, whatever theirs are (finer ones are folded, coarser ones win)."""
    none = F.lit(empty_sketch(lg_k))
    united = df.groupBy(*keys).agg(F.hll_union_agg(F.col(sketch), F.lit(True)).alias(sketch)).withColumn(sketch, F.hll_union(F.col(sketch), none, True))
    return united.select(*keys, sketch, hll_estimate(F.col(sketch)).alias("estimate"))


def theta_estimate(sketch: Column) -> Column:
    """Retained entries over theta, as a double."""

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else E.theta_estimate(v)).astype(float)

    return run(sketch)


# ---- theta sketches that lose nothing


def theta_parts(rows: DataFrame, value: str, lg: int) -> int:
    """Into how many parts rows must be dealt by value so that no sketch of 2**lg entries, of any group, overflows.

    Twice as many as the distinct values need: theta stays 1 in every part, so parts count exactly, and as no value is in two of them
    their counts add up.  One pass over the rows.
    """
    return 1 + int(rows.agg(F.approx_count_distinct(value, 0.02)).first()[0]) * 2 // (1 << lg)


def theta_part(value: str | Column, parts: int) -> Column:
    """The part of a value, as a key beside a group's own."""
    return F.pmod(F.xxhash64(value), F.lit(parts)).alias("part")


def theta_count(sketch: str | Column, lg: int) -> Column:
    """The count of one part's sketch; fails where a part has overflowed, as sums of estimates aren't exact."""
    n = F.theta_sketch_estimate(sketch)
    return F.when(n <= 1 << lg, n).otherwise(F.raise_error(F.lit("a part of a theta sketch has overflowed: deal the values to more parts")).cast("bigint"))
