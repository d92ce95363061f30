"""Sources and sinks: JSON lines, TSV, idempotent day partitions, and embedded queries."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_rows(spark: SparkSession, path: str, schema: str | T.StructType, glob: str | None = None) -> DataFrame:
    """JSON objects, one a line (also gzipped); only the columns of schema are read."""
    reader = spark.read.schema(schema)
    return (reader.option("pathGlobFilter", glob) if glob else reader).json(path)


def json_arrays(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """JSON arrays, one a line, each file's first line a header; all values as strings."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("place")).filter("trim(value) != ''")
    first = lines.filter("at = 0").groupBy("file").agg(F.min("place").alias("place"))
    rows = lines.join(first, ["file", "place"], "left_anti").select(F.from_json("value", "array<string>").alias("a"))
    return rows.select(*[F.get("a", F.lit(i)).alias(n) for i, n in enumerate(names)])


def tsv_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    r"""Tab-separated fields with backslash escapes, \N for null."""
    fields = T._parse_datatype_string(schema).fields if hasattr(T, "_parse_datatype_string") else spark.createDataFrame([], schema).schema.fields
    parts = spark.read.text(path).select(F.split("value", "\t").alias("p"))

    def field(i: int) -> Column:
        # escapes are read from left to right: pieces between doubled backslashes hold none of them
        pieces = F.transform(F.split(F.col("p")[i], r"\\\\"), plain)
        return F.when(F.col("p")[i] != "\\N", F.array_join(pieces, "\\"))

    def plain(piece: Column) -> Column:
        for mark, value in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\\0", "\x00")):
            piece = F.replace(piece, F.lit(mark), F.lit(value))
        return piece

    return parts.select(*[field(i).cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


def write_tsv(rows: Column, df: DataFrame, path: str) -> None:
    df.select(rows.alias("value")).write.text(path)


def write_days(df: DataFrame, path: str, day: str = "day") -> None:
    """Replaces the days that df holds, and no other."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def extract_query(line: str) -> str:
    """The SQL of a request line: bare, a JSON string, a JSON object with ``query`` or one value, or the first field of a TSV line (unescaped)."""
    text = line.strip("\r\n")
    try:
        value = json.loads(text)
    except ValueError:
        field = text.split("\t")[0]
        for mark, plain in (("\\\\", "\0"), ("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\\'", "'"), ("\0", "\\")):
            field = field.replace(mark, plain)
        return field.strip()
    if isinstance(value, dict):
        return str(value["query"] if "query" in value else next(iter(value.values()), "")).strip()
    return value.strip() if isinstance(value, str) else text.strip()


def register_views(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def run_query(spark: SparkSession, line: str, **args) -> DataFrame:
    """The rows of a request's query; values are passed as parameters, never pasted into the text."""
    return spark.sql(extract_query(line), args=args or None)
