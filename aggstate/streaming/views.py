"""Streaming: incremental rollups into an aggregating table, and windowed sketches under a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aggstate.operators.table import AggregatingTable


def materialise(stream: DataFrame, table: AggregatingTable, state: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Each micro-batch is aggregated to states and appended under its batch id, so a replayed batch counts once."""

    def each(batch: DataFrame, batch_id: int) -> None:
        table.append(state(batch), f"batch-{batch_id}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(stream: DataFrame, *, time: str, late: str, window: str, dims: tuple[str, ...], user: str) -> DataFrame:
    """Events and distinct users by window; rows later than the watermark are dropped by Spark."""
    base = stream.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    rows = base.groupBy(F.window("__t", window), *dims).agg(F.count(F.lit(1)).alias("events"), F.theta_sketch_agg(user, F.lit(14)).alias("users"))
    return rows.select(F.col("window.start").alias("ts"), *dims, "events", F.theta_sketch_estimate("users").alias("users"))
