"""Queries for the relational operators, scalar functions, sources and tables; each with the same in DuckDB SQL."""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aggstate.functions import bytesx as B
from aggstate.sources import catalog, connect, remote


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def time_range(spark, sf_dir):
    """A range of time and a list of values, both pushed to the scan."""
    e = _table(spark, sf_dir, "events")
    chosen = e.filter((F.col("ts") >= F.lit("2024-01-03").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-17 12:00:00").cast("timestamp_ntz")) & F.col("event_type").isin("click", "view", "purchase"))
    return chosen.groupBy("event_type").agg(F.count("*").alias("events"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


def hash_chunks(spark, sf_dir):
    """Rows dealt to 26 chunks by key; every row is in one of them."""
    o = _table(spark, sf_dir, "orders").withColumn("chunk", F.pmod(F.xxhash64("o_orderkey"), F.lit(26)))
    sizes = o.groupBy("chunk").agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").cast("bigint").alias("chunks"), F.sum("n").cast("bigint").alias("orders"))


def scalar_subquery(spark, sf_dir):
    _table(spark, sf_dir, "lineitem").createOrReplaceTempView("aggstate_lineitem")
    return spark.sql("SELECT l_returnflag, count(*) AS n, (SELECT count(*) FROM aggstate_lineitem) AS total FROM aggstate_lineitem GROUP BY 1 ORDER BY 2 DESC, 1")


def collected(spark, sf_dir):
    """Values gathered by key, any value of a constant one, an array's matching elements counted, a struct's field, a map's default."""
    n = _table(spark, sf_dir, "nation")
    g = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_nationkey")).alias("keys"), F.any_value(F.col("n_regionkey") * 10).alias("ten"), F.min(F.struct("n_name", "n_nationkey")).alias("first"))
    m = F.map_from_arrays("keys", F.transform("keys", lambda k: k * 2))
    return g.select("n_regionkey", F.concat_ws(",", F.transform("keys", lambda k: k.cast("string"))).alias("keys"), "ten", F.size(F.filter("keys", lambda k: k % 2 == 0)).cast("bigint").alias("even"), F.col("first.n_name").alias("first_name"), F.coalesce(F.try_element_at(m, F.col("first.n_nationkey")), F.lit(0)).cast("bigint").alias("doubled"), F.coalesce(F.try_element_at(m, F.lit(-1)), F.lit(0)).cast("bigint").alias("missing"), F.coalesce(F.get("keys", F.lit(99)), F.lit(0)).cast("bigint").alias("beyond"))


def distinct_shapes(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select("o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("priority")).distinct()


def newest_order(spark, sf_dir):
    """The largest row by date, ties by key."""
    return _table(spark, sf_dir, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(1).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


def trial_errors(spark, sf_dir):
    """Mean and root mean square of estimation errors over trials (a thousandth of the customers' keys stands in for an error)."""
    c = _table(spark, sf_dir, "customer").select(F.pmod(F.col("c_custkey") * 7919, F.lit(2001)).alias("e"), F.pmod("c_custkey", F.lit(40)).alias("trial"))
    return c.groupBy("trial").agg(F.round(F.avg((F.col("e") - 1000) / 1000), 9).alias("mean"), F.round(F.sqrt(F.avg(F.pow((F.col("e") - 1000) / 1000, 2))), 9).alias("rmse"))


def generated_rows(spark, sf_dir):
    """Numbers, literal pairs as rows, and rows parsed from text lines."""
    pairs = spark.sql("SELECT col1 AS id, col2 AS factor FROM (SELECT inline(array(struct(1, 10), struct(2, 20), struct(3, 30))))")
    numbers = spark.range(1000).groupBy((F.col("id") % 3 + 1).cast("int").alias("id")).agg(F.sum("id").alias("total"))
    return numbers.join(pairs, "id").select("id", "total", (F.col("total") * F.col("factor")).alias("scaled"))


def time_functions(spark, sf_dir):
    """Times truncated, parsed from text in several forms, and as milliseconds and little-endian seconds."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("t"))
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("t", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    back = F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(text))
    return o.select("o_orderkey", F.date_format(F.date_trunc("MONTH", "t"), "yyyy-MM-dd").alias("month"), (back == F.col("t")).alias("parsed"), F.unix_millis("t").alias("millis"), (F.timestamp_millis(F.unix_millis("t")) == F.col("t")).alias("from_millis"), F.hex(B.rb_datetime(F.col("t"))).alias("seconds"))


def json_round_trip(spark, sf_dir):
    """Rows written as JSON lines and parsed again with a declared schema."""
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    line = F.to_json(F.struct("p_partkey", "p_brand", "p_size"))
    back = F.from_json(line, "p_partkey bigint, p_size int")
    return p.select("p_partkey", line.alias("line"), (back["p_size"] == F.col("p_size")).alias("same"))


def quoted_query(spark, sf_dir):
    """A query that comes as a JSON request, its value as a parameter: text with quotes stays text."""
    _table(spark, sf_dir, "documents").createOrReplaceTempView("aggstate_documents")
    line = json.dumps({"query": "SELECT count(*) AS n, count_if(lang = :lang) AS own, :odd AS odd FROM aggstate_documents"})
    return connect.run_query(spark, line, lang="en", odd="it's $1; -- \\")


def command_join(spark, sf_dir):
    """A table that a program answers (one query, one partition), joined with a stored one."""
    code = "import sys, json; n = int(sys.stdin.readline()); [print(json.dumps({'key': i, 'square': i * i})) for i in range(n)]"
    squares = remote.answered(spark, "10;;25", "key int, square bigint", command=f'{sys.executable} -c "{code}"')
    return _table(spark, sf_dir, "nation").join(squares, F.col("n_nationkey") == F.col("key")).groupBy("n_nationkey").agg(F.count("*").alias("times"), F.max("square").alias("square"))


def column_types(spark, sf_dir):
    return catalog.columns(_table(spark, sf_dir, "nation"))


def stored_parts(spark, sf_dir):
    """Files behind a table: how many rows they hold in all."""
    return catalog.parts(_table(spark, sf_dir, "lineitem")).agg((F.count("*") > 0).alias("some"), F.sum("rows").cast("bigint").alias("rows"))


_QUERY = (time_range, hash_chunks, scalar_subquery, collected, distinct_shapes, newest_order, trial_errors, generated_rows, time_functions, json_round_trip, quoted_query, command_join, column_types, stored_parts)
QUERIES = {q.__name__: q for q in _QUERY}
ORACLE = {
    "time_range": "SELECT event_type, count(*) AS events, min(event_id) AS first_id, max(event_id) AS last_id FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-17 12:00:00' AND event_type IN ('click', 'view', 'purchase') GROUP BY ALL",
    "hash_chunks": "SELECT CAST(26 AS BIGINT) AS chunks, count(*) AS orders FROM orders",
    "scalar_subquery": "SELECT l_returnflag, count(*) AS n, (SELECT count(*) FROM lineitem) AS total FROM lineitem GROUP BY 1",
    "collected": "SELECT n_regionkey, string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY n_nationkey) AS keys, any_value(n_regionkey * 10) AS ten, CAST(count_if(n_nationkey % 2 = 0) AS BIGINT) AS even, min(n_name) AS first_name, CAST(arg_min(n_nationkey, n_name) * 2 AS BIGINT) AS doubled, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS beyond FROM nation GROUP BY ALL",
    "distinct_shapes": "SELECT DISTINCT o_orderstatus, substr(o_orderpriority, 1, 1) AS priority FROM orders",
    "newest_order": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1",
    "trial_errors": "SELECT c_custkey % 40 AS trial, round(avg(((c_custkey * 7919) % 2001 - 1000) / 1000), 9) AS mean, round(sqrt(avg(pow(((c_custkey * 7919) % 2001 - 1000) / 1000, 2))), 9) AS rmse FROM customer GROUP BY ALL",
    "generated_rows": "SELECT n.id, total, total * factor AS scaled FROM (SELECT CAST(i % 3 + 1 AS INT) AS id, CAST(sum(i) AS BIGINT) AS total FROM range(1000) t(i) GROUP BY ALL) n JOIN (VALUES (1, 10), (2, 20), (3, 30)) p(id, factor) ON n.id = p.id",
    "time_functions": "SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, true AS parsed, epoch_ms(o_orderdate) AS millis, true AS from_millis, (SELECT string_agg(printf('%02X', (CAST(epoch(o_orderdate) AS BIGINT) >> (8 * k)) & 255), '' ORDER BY k) FROM range(4) t(k)) AS seconds FROM orders",
    "json_round_trip": """SELECT p_partkey, '{"p_partkey":' || p_partkey || ',"p_brand":"' || p_brand || '","p_size":' || p_size || '}' AS line, true AS same FROM part""",
    "quoted_query": "SELECT count(*) AS n, CAST(count_if(lang = 'en') AS BIGINT) AS own, 'it''s $1; -- \\' AS odd FROM documents",
    "command_join": "SELECT n_nationkey, CAST(CASE WHEN n_nationkey < 10 THEN 2 ELSE 1 END AS BIGINT) AS times, CAST(n_nationkey * n_nationkey AS BIGINT) AS square FROM nation WHERE n_nationkey < 25",
    "column_types": "SELECT CAST(column_index - 1 AS INT) AS place, column_name AS \"column\", CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' ELSE lower(data_type) END AS type FROM duckdb_columns() WHERE table_name = 'nation'",
    "stored_parts": "SELECT true AS some, count(*) AS rows FROM lineitem",
}
