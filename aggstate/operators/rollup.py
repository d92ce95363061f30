"""Rollup: time buckets and dimensions with additive measures and sketch columns, at one or many grains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def measures(user: str = "user", page: str = "page", added: str = "added") -> list[Column]:
    """Counts, sums and sketches of one pass; all of them are combined before the shuffle."""
    return [
        F.count(F.lit(1)).alias("events"),
        F.sum(added).cast("bigint").alias("sum_added"),
        F.hll_sketch_agg(user, F.lit(12)).alias("users_hll"),
        F.hll_sketch_agg(page, F.lit(14)).alias("pages_hll"),
        F.theta_sketch_agg(user, F.lit(14)).alias("users_theta"),
        F.kll_sketch_agg_double(F.col(added).cast("double"), F.lit(200)).alias("added_kll"),
    ]


def rollup(events: DataFrame, *, time: str = "time", grain: str = "HOUR", dims: Sequence[str] = (), aggregates: Sequence[Column] | None = None) -> DataFrame:
    """One row for each time bucket and value of dims; a null dimension is a value of its own."""
    bucket = F.date_trunc(grain, F.col(time)).alias("ts")
    return events.groupBy(bucket, *dims).agg(*(measures() if aggregates is None else aggregates))


def merged(parts: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """A coarser rollup from a finer one: sums are added, sketches united, nothing is counted twice."""
    return parts.groupBy(*keys).agg(
        F.sum("events").cast("bigint").alias("events"),
        F.sum("sum_added").cast("bigint").alias("sum_added"),
        F.hll_union_agg("users_hll", F.lit(True)).alias("users_hll"),
        F.hll_union_agg("pages_hll", F.lit(True)).alias("pages_hll"),
        F.theta_union_agg("users_theta", F.lit(14)).alias("users_theta"),
        F.kll_merge_agg_double("added_kll").alias("added_kll"),
    )


GRAINS = (("hour_dims", "HOUR", ("channel", "country", "robot")), ("hour_channel", "HOUR", ("channel",)), ("day_channel", "DAY", ("channel",)), ("day_total", "DAY", ()))


def grains(hourly: DataFrame, wanted: Sequence[tuple[str, str, tuple[str, ...]]] = GRAINS) -> DataFrame:
    """All grains of an hourly rollup in one table; grain tells them apart, as a null dimension can be data at the finest one."""
    every = sorted({d for _, _, dims in wanted for d in dims})
    out = None
    for name, unit, dims in wanted:
        own = merged(hourly.withColumn("ts", F.date_trunc(unit, "ts")), ["ts", *dims])
        own = own.select(F.lit(name).alias("grain"), "ts", *[F.col(d) if d in dims else F.lit(None).cast("string").alias(d) for d in every], "events", "sum_added", "users_hll", "pages_hll", "users_theta", "added_kll")
        out = own if out is None else out.unionByName(own)
    return out


def identity_grain(parts: DataFrame, keys: Sequence[str], sketch: str) -> DataFrame:
    """(keys, events, sketch): a group of one row carries its sketch's bytes as they are; larger groups are united."""
    rows = parts.groupBy(*keys).agg(F.sum("events").cast("bigint").alias("events"), F.count(F.lit(1)).alias("__n"), F.first(sketch).alias("__one"), F.hll_union_agg(sketch, F.lit(True)).alias("__all"))
    return rows.select(*keys, "events", F.when(F.col("__n") == 1, F.col("__one")).otherwise(F.col("__all")).alias(sketch))


def top(df: DataFrame, measure: str, n: int, *ties: str) -> DataFrame:
    """The n largest rows by measure; ties are broken by the columns in ties."""
    return df.orderBy(F.desc(measure), *ties).limit(n)
