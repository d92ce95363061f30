"""Aggregating tables: appended parts, merged when read, collapsed by an explicit compaction.

Layout: ``parts/<id>`` holds an append; ``merged/<n>`` the rows of the n-th compaction; ``ids/<n>`` the ids of all parts that these
rows hold, and ``done/<n>`` says that both are complete.  Readers take the newest finished compaction and every part that
it doesn't list.  So an id that is appended again does nothing, before and after a compaction, and a part that is
appended while one runs is read beside it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aggstate.operators import quantiles as Q
from aggstate.operators import states as S

MERGES = {
    "sum": lambda c: F.sum(c).cast("bigint"),
    "any": F.any_value,
    "min": F.min,
    "max": F.max,
    "hll": lambda c: F.hll_union_agg(c, F.lit(True)),
    "theta": lambda c: F.theta_union_agg(c, F.lit(14)),
    "kll": F.kll_merge_agg_double,
}
#: Merges of binary states that no built-in aggregate knows: (rows, keys, column) to (keys, column).
STATE_MERGES = {
    "hll12": lambda df, keys, c: S.merged_states(df, keys, c, family="hll12", k=12),
    **{f"combined{k}": lambda df, keys, c, k=k: S.merged_states(df, keys, c, family="combined", k=k) for k in range(12, 21)},
    "digest": lambda df, keys, c: Q.merge_state(df, keys, c, Q.merge_digests),
    "classic": lambda df, keys, c: Q.merge_state(df, keys, c, Q.merge_classic),
}


def merged_rows(rows: DataFrame, keys: Sequence[str], merges: Mapping[str, str]) -> DataFrame:
    """One row for each value of keys (nulls are values), the other columns merged as merges says."""
    keys = list(keys)
    plain = [MERGES[how](c).alias(c) for c, how in merges.items() if how in MERGES]
    out = rows.groupBy(*keys).agg(*(plain or [F.count(F.lit(1)).alias("__rows")]))
    for c, how in merges.items():
        if how in STATE_MERGES:
            own = STATE_MERGES[how](rows, keys, c).toDF(*[f"__{k}" for k in keys], c)
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], F.lit(True))
            out = out.join(own, same, "left").drop(*[f"__{k}" for k in keys])
    return out.select(*keys, *merges)


class AggregatingTable:
    """``merges`` says how each column that is no key is merged: a name of MERGES or STATE_MERGES."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], merges: Mapping[str, str]) -> None:
        if unknown := set(merges.values()) - MERGES.keys() - STATE_MERGES.keys():
            raise ValueError(f"unknown merges {sorted(unknown)}")
        self.spark, self.folder, self.keys, self.merges = spark, folder.rstrip("/"), list(keys), dict(merges)
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _compactions(self) -> int:
        n = 0
        while self._exists(f"{self.folder}/done/{n + 1}"):
            n += 1
        return n

    def _held(self, n: int) -> set[str]:
        """The ids that compaction n holds."""
        return {r["id"] for r in self.spark.read.parquet(f"{self.folder}/ids/{n}").collect()} if n else set()

    def _parts(self) -> list[str]:
        """The ids of all complete parts."""
        place = f"{self.folder}/parts"
        if not self._exists(place):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(place))]
        return [x for x in names if self._exists(f"{place}/{x}/_SUCCESS")]

    def _ordered(self, df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions(*[F.col(k).asc_nulls_last() for k in self.keys])

    def append(self, df: DataFrame, part: str) -> None:
        name = quote(part, safe="")
        place = f"{self.folder}/parts/{name}"
        if not self._exists(f"{place}/_SUCCESS") and name not in self._held(self._compactions()):
            self._ordered(df.select(*self.keys, *self.merges)).write.mode("overwrite").parquet(place)

    def _rows(self, n: int, parts: Sequence[str]) -> DataFrame:
        places = [f"{self.folder}/parts/{p}" for p in parts] + ([f"{self.folder}/merged/{n}"] if n else [])
        if not places:
            raise ValueError("the table has no rows yet")
        return self.spark.read.parquet(*places).select(*self.keys, *self.merges)

    def parts(self) -> DataFrame:
        """All rows as they are stored."""
        n = self._compactions()
        return self._rows(n, sorted(set(self._parts()) - self._held(n)))

    def merged(self, keys: Sequence[str | Column] | None = None) -> DataFrame:
        """One row for each key, or for coarser keys."""
        return merged_rows(self.parts(), self.keys if keys is None else keys, self.merges)

    def compact(self) -> None:
        """Writes the merged rows of the parts that are there now as the next compaction; readers see it when it is complete."""
        n = self._compactions()
        held = self._held(n)
        fresh = sorted(set(self._parts()) - held)
        if not fresh:
            return
        self._ordered(merged_rows(self._rows(n, fresh), self.keys, self.merges)).write.mode("overwrite").parquet(f"{self.folder}/merged/{n + 1}")
        ids = self.spark.createDataFrame([(x,) for x in sorted(held.union(fresh))], "id string")
        ids.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/ids/{n + 1}")
        self._fs.mkdirs(self._path(f"{self.folder}/done"))
        self._fs.create(self._path(f"{self.folder}/done/{n + 1}")).close()

    def clean(self) -> None:
        """Deletes the parts that the newest compaction holds, and older compactions.  Their ids stay known."""
        n = self._compactions()
        for x in self._held(n).intersection(self._parts()):
            self._fs.delete(self._path(f"{self.folder}/parts/{x}"), True)
        for k in range(1, n):
            self._fs.delete(self._path(f"{self.folder}/merged/{k}"), True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder that the session names; a local one where none is named and all runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("a cluster must name its shared folder in spark.checkpoint.dir")
        folder = "file://" + tempfile.mkdtemp(prefix="aggstate-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(spark: SparkSession, df: DataFrame) -> DataFrame:
    """df written and read again: what holds random sketches, or bytes that the order of rows decides, must be computed once if it is read twice."""
    place = scratch(spark, "kept")
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)
