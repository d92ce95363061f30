"""Tables by name: creating, filling, replacing, and what the catalog knows about them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def create(spark: SparkSession, name: str, columns: str, *, replace: bool = False, partitioned_by: Sequence[str] = ()) -> None:
    """A Parquet table of these columns, if there is none; replace drops an older one first."""
    if replace:
        drop(spark, name)
    by = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by}")


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def fill(df: DataFrame, name: str, *, batch_rows: int | None = None) -> None:
    """Appends df's columns to a table by name; batch_rows: rows of a file at most (an insert's batch)."""
    columns = df.sparkSession.table(name).columns
    writer = df.select(*columns).write
    (writer.option("maxRecordsPerFile", batch_rows) if batch_rows else writer).insertInto(name)


def fill_from(spark: SparkSession, staging: str, name: str, query: str, **args) -> None:
    """Runs ``query`` over a staging table into another one, then drops the staging table."""
    fill(spark.sql(query, args=args or None), name)
    drop(spark, staging)


def columns(df: DataFrame) -> DataFrame:
    """(place, column, type) of df's columns."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "place int, column string, type string")


def known_functions(spark: SparkSession, names: Sequence[str]) -> dict[str, bool]:
    return {n: spark.catalog.functionExists(n) for n in names}


def parts(df: DataFrame) -> DataFrame:
    """(part, rows): the files behind df and how many of its rows each holds."""
    return df.groupBy(F.input_file_name().alias("part")).agg(F.count(F.lit(1)).alias("rows"))


def first_row(df: DataFrame) -> Row:
    """The first row; a query without rows raises."""
    row = df.first()
    if row is None:
        raise ValueError("the query has no rows")
    return row
