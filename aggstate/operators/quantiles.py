"""Quantile states: classic sketches and weighted digests, replay of sketches as weighted samples, weighted quantiles, rank checks.

States are built in two steps, by partition and then by key, so no task sees more of a key than a few kilobytes from each
partition.  A task writes its states out and starts afresh when it holds ``HELD`` keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aggstate.functions import quantile_bytes as Q

SAMPLES = 1000
HELD = 4096
#: Steps of the sketch that cuts a key's values into bins before they are put in order.
BINS = 256


def replay_weights(n: Column, most: int = SAMPLES) -> Column:
    """Weights of the min(n, most) samples of n values: as even as can be, the larger ones first; they sum to n."""
    m = F.least(n, F.lit(most)).cast("bigint")
    weights = F.transform(F.sequence(F.lit(0).cast("bigint"), m - 1), lambda i: F.floor(n / m) + F.when(i < n % m, 1).otherwise(0))
    return F.when(m > 0, weights).otherwise(F.array().cast("array<bigint>"))


def replay(df: DataFrame, keys: Sequence[str], value: str, most: int = SAMPLES) -> DataFrame:
    """(keys, value, weight): each group's values as at most ``most`` weighted samples at evenly spaced ranks.

    The i-th of m samples stands at rank (i + 1/2) / m.  With n <= most every value is its own sample.
    """
    by = Window.partitionBy(*keys)
    ranked = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("value"), F.row_number().over(by.orderBy(value)).alias("r"), F.count("*").over(by).alias("n"))
    ranked = ranked.withColumn("m", F.least("n", F.lit(most)))
    # the sample i takes the value at place floor((2 i + 1) n / 2 m)
    first = F.floor((2 * (F.col("r") - 1) * F.col("m") + F.col("n")) / (2 * F.col("n")))
    i = F.greatest(F.lit(0), first - 1)
    place = lambda k: F.floor((2 * k + 1) * F.col("n") / (2 * F.col("m")))
    chosen = F.when(place(i) == F.col("r") - 1, i).when(place(i + 1) == F.col("r") - 1, i + 1)
    out = ranked.withColumn("i", chosen).filter("i is not null and i < m")
    return out.select(*keys, "value", (F.floor(F.col("n") / F.col("m")) + F.when(F.col("i") < F.col("n") % F.col("m"), 1).otherwise(0)).cast("bigint").alias("weight"))


def weighted_quantile(df: DataFrame, keys: Sequence[str], level: float, value: str = "value", weight: str = "weight") -> DataFrame:
    """(keys, quantile): the smallest value whose cumulative weight reaches level of the total.

    Approximate quantiles of a key's distinct values cut them into bins; exact sums by bin tell the one that holds the answer, and only
    its values are put in order.  So a key with a third of all rows is no single task's sort.
    """
    sums = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v")).agg(F.sum(weight).alias("w"))
    cuts = sums.groupBy(*keys).agg(F.percentile_approx("v", [i / BINS for i in range(1, BINS)], F.lit(4 * BINS)).alias("cuts"), F.sum("w").alias("t"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    joined = sums.alias("a").join(cuts.alias("b"), same).select(*[F.col(f"a.{k}").alias(k) for k in keys], "v", "w", "t", F.size(F.filter("cuts", lambda c: c < F.col("v"))).alias("bin"))
    bins = joined.groupBy(*keys, "bin").agg(F.sum("w").alias("own"), F.first("t").alias("t"))
    bins = bins.withColumn("until", F.sum("own").over(Window.partitionBy(*keys).orderBy("bin")))
    chosen = bins.filter((F.col("until") >= F.lit(level) * F.col("t")) & (F.col("until") - F.col("own") < F.lit(level) * F.col("t"))).select(*keys, "bin", (F.col("until") - F.col("own")).alias("before"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "bin"]]
    inside = joined.alias("a").join(chosen.alias("b"), same).select(*[F.col(f"a.{k}").alias(k) for k in keys], "v", "w", "t", "before")
    run = inside.withColumn("c", F.col("before") + F.sum("w").over(Window.partitionBy(*keys).orderBy("v")))
    return run.filter(F.col("c") >= F.lit(level) * F.col("t")).groupBy(*keys).agg(F.min("v").alias("quantile"))


def rank_interval(df: DataFrame, keys: Sequence[str], value: str, candidates: DataFrame, candidate: str) -> DataFrame:
    """Candidates (keys, candidate) with the shares of values below them and not above them."""
    joined = candidates.join(df.select(*keys, F.col(value).alias("__v")), list(keys))
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    return joined.groupBy(*keys, candidate).agg(share(F.col("__v") < F.col(candidate)).alias("below"), share(F.col("__v") <= F.col(candidate)).alias("upto"))


def valid_quantile(below: Column, upto: Column, level: float, band: float = 0.05) -> Column:
    """Whether level lies in the candidate's rank interval, widened by band."""
    return F.lit(level).between(below - band, upto + band)


# ---- states


def _by_key(df: DataFrame, keys: Sequence[str], columns: Sequence[Column], state: Callable[[list[pd.Series], object], object], seal: Callable[[object], bytes]) -> DataFrame:
    """(keys, state): folds the rows of each key into a state, by partition."""
    chosen = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[c.alias(f"v{i}") for i, c in enumerate(columns)])
    names, width = [f"k{i}" for i in range(len(keys))], len(columns)  # columns themselves can't travel to workers

    def run(batches):
        held: dict = {}

        def out() -> pa.RecordBatch:
            rows = list(held)
            own = [pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))]
            return pa.RecordBatch.from_arrays([*own, pa.array([seal(v) for v in held.values()], pa.binary())], names=[*names, "state"])

        kinds: list = []
        for batch in batches:
            kinds = [batch.schema.field(n).type for n in names]
            table = pa.Table.from_batches([batch])
            index = table.select(names).append_column("row", pa.array(np.arange(len(table)))).group_by(names, use_threads=False).aggregate([("row", "list")])
            values = [batch.column(f"v{i}").to_numpy(zero_copy_only=False) for i in range(width)]
            for row in index.to_pylist():
                key = tuple(row[n] for n in names)
                held[key] = state([v[row["row_list"]] for v in values], held.get(key))
            if len(held) >= HELD:
                yield out()
                held = {}
        if held:
            yield out()

    schema = ", ".join([*[f"{n} {chosen.schema[n].dataType.simpleString()}" for n in names], "state binary"])
    return chosen.mapInArrow(run, schema).toDF(*keys, "state")


def merge_state(df: DataFrame, keys: Sequence[str], column: str, merge: Callable[[list[bytes]], bytes]) -> DataFrame:
    """(keys, column): the states of each key merged, first by partition, then by key; null states are left out."""
    known = df.filter(F.col(column).isNotNull())
    parts = _by_key(known, keys, [F.col(column)], lambda v, old: merge([*([old] if old else []), *v[0]]), lambda v: v)
    schema = parts.schema

    def run(group: pa.Table) -> pa.Table:
        own = group.slice(0, 1)
        return own.set_column(len(keys), "state", pa.array([merge(group.column("state").to_pylist())], pa.binary()))

    return parts.groupBy(*keys).applyInArrow(run, schema).withColumnRenamed("state", column)


def merge_classic(states: Sequence[bytes]) -> bytes:
    out = Q.Classic.open(states[0])
    for s in states[1:]:
        out.merge(Q.Classic.open(s))
    return out.tobytes()


def classic(df: DataFrame, keys: Sequence[str], value: str, k: int = 256) -> DataFrame:
    """(keys, state): classic quantile sketches."""
    known = df.filter(F.col(value).isNotNull())
    parts = _by_key(known, keys, [F.col(value).cast("double")], lambda v, old: (old or Q.Classic(k)).update(v[0]), lambda v: v.tobytes())
    return merge_state(parts, keys, "state", merge_classic)


def merge_digests(states: Sequence[bytes]) -> bytes:
    parts = [Q.unseal(s) for s in states]
    return Q.seal(Q.digest(*(np.concatenate([p[i] for p in parts]) for i in (0, 1))))


def digests(df: DataFrame, keys: Sequence[str], value: str = "value", weight: str | None = "weight") -> DataFrame:
    """(keys, state): weighted digests of (value, weight) rows; without a weight each row counts once."""
    weights = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    known = df.filter(F.col(value).isNotNull() & weights.isNotNull())

    def fold(v, old):
        values, own = v if old is None else (np.concatenate([a, b]) for a, b in zip(old, v, strict=True))
        return Q.digest(values, own)

    parts = _by_key(known, keys, [F.col(value).cast("double"), weights], fold, Q.seal)
    return merge_state(parts, keys, "state", merge_digests)


def digest_quantile(state: Column, level: float) -> Column:
    """The value of a digest at a normalised rank."""

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else Q.digest_quantile(Q.unseal(v), level)).astype(float)

    return run(state)


def dealt(df: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """df with a part for each row: a group of keys has as many parts as make them half of most rows on average, or one part.

    Sketches of most entries by keys and part lose no value; ``replay_sketches`` with whole fails if chance overfills a part."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).select(*[F.col(k).alias(f"__{k}") for k in keys], "__n")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    rows = df.withColumn("__row", F.xxhash64(F.monotonically_increasing_id())).join(sizes, same)
    return rows.select(*df.columns, F.pmod("__row", F.floor(F.col("__n") * 2 / most) + 1).alias("part"))


def replay_sketches(df: DataFrame, keys: Sequence[str], sketch: str, most: int = SAMPLES, *, whole: bool = False) -> DataFrame:
    """(keys, value, weight): each row's sketch (KLL of doubles or classic) as at most ``most`` weighted samples; empty and null ones give none.

    whole: fails where a sketch has dropped values or holds more than most."""
    names = [f"k{i}" for i in range(len(keys))]
    chosen = df.filter(F.col(sketch).isNotNull()).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(sketch).alias("s"))

    def run(batches):
        for batch in batches:
            samples = [Q.sample(s) for s in batch.column("s").to_pylist()]
            found = [Q.replay(s, most) for s in samples]
            if whole and any((weights > 1).any() for _, weights in samples + found):
                raise ValueError("a sketch doesn't hold all of its values")
            rows = pa.array(np.repeat(np.arange(len(found)), [len(v) for v, _ in found]))
            value, weight = (np.concatenate([np.zeros(0, t), *[f[i] for f in found]]) for i, t in ((0, float), (1, np.int64)))
            yield pa.RecordBatch.from_arrays([*[batch.column(n).take(rows) for n in names], pa.array(value), pa.array(weight)], names=[*names, "value", "weight"])

    schema = ", ".join([*[f"{n} {chosen.schema[n].dataType.simpleString()}" for n in names], "value double, weight bigint"])
    return chosen.mapInArrow(run, schema).toDF(*keys, "value", "weight")


def sketch_info(sketch: Column) -> Column:
    """A struct of a sketch's family, n, k, min, max and normalised rank error."""

    @F.pandas_udf("struct<family:string,n:bigint,k:int,min:double,max:double,error:double>")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([Q.info(v) | {"error": Q.rank_error(v)} for v in s], columns=["family", "n", "k", "min", "max", "error"])

    return run(sketch)


def sketch_rank(sketch: Column, value: Column, *, inclusive: bool = False) -> Column:
    """The normalised rank of each row's value in its sketch: the share below it, or not above it."""

    @F.pandas_udf("double")
    def run(s: pd.Series, v: pd.Series) -> pd.Series:
        return pd.Series([Q.rank(Q.sample(a), b, inclusive) for a, b in zip(s, v, strict=True)], dtype=float)

    return run(sketch, value.cast("double"))


def sketch_quantile(sketch: Column, level: Column) -> Column:
    """The value at each row's own rank (built-in functions take a constant one alone)."""

    @F.pandas_udf("double")
    def run(s: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series([Q.quantiles(Q.sample(a), np.array([b]))[0] if Q.info(a)["n"] else np.nan for a, b in zip(s, p, strict=True)], dtype=float)

    return run(sketch, level.cast("double"))
