"""Data sources for queries that something else answers: a program fed by standard input, or an HTTP endpoint; and a row-binary sink.

``register(spark)`` makes them known; then ``spark.read.format("aggstate_command")`` and ``("aggstate_http")`` give tables that can be
joined like any other.  Both answer with JSON, one object or array a line, and read only the columns of the given schema.  Each
``;;``-separated query is a partition of its own.  With ``onError`` = ``row``, a query that fails gives one row whose ``error``
column says why; otherwise the job fails.
"""

from __future__ import annotations

import json
import os
import shlex
import subprocess
import urllib.request
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SEPARATOR = ";;"


def _cast(value, kind: str):
    if value is None or kind == "string":
        return value if value is None or isinstance(value, str) else json.dumps(value)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return int(value)
    if kind in ("float", "double"):
        return float(value)
    return value if kind != "boolean" or isinstance(value, bool) else str(value).lower() in ("true", "1")


def rows_of(lines: Iterator[str], schema: StructType, header: bool) -> Iterator[tuple]:
    """Rows of NDJSON: objects by name, arrays by place, or by the names of a header line."""
    names = None
    for line in lines:
        if not line.strip():
            continue
        value = json.loads(line)
        if isinstance(value, list):
            if header and names is None:
                names = value
                continue
            value = dict(zip(names or [f.name for f in schema], value, strict=False))
        yield tuple(_cast(value.get(f.name), f.dataType.simpleString()) for f in schema)


class _Query(InputPartition):
    def __init__(self, query: str) -> None:
        self.query = query


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.options = schema, {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[InputPartition]:
        return [_Query(q.strip()) for q in self.options["query"].split(SEPARATOR)]

    def lines(self, query: str) -> Iterator[str]:
        raise NotImplementedError

    def read(self, partition: _Query) -> Iterator[tuple]:
        try:
            yield from rows_of(self.lines(partition.query), self.schema, self.options.get("header", "false").lower() == "true")
        except Exception as error:
            if self.options.get("onerror") != "row":
                raise
            yield tuple(f"{type(error).__name__}: {error}" if f.name == "error" else None for f in self.schema)


class _CommandReader(_Reader):
    def lines(self, query: str) -> Iterator[str]:
        done = subprocess.run(shlex.split(self.options["command"]), input=query + "\n", capture_output=True, text=True, timeout=float(self.options.get("timeout", 600)), check=False)
        if done.returncode:
            raise RuntimeError(f"the command ended with {done.returncode}: {done.stderr[-500:]}")
        return iter(done.stdout.splitlines())


class _HttpReader(_Reader):
    def lines(self, query: str) -> Iterator[str]:
        url, named = self.options["url"], self.options.get("named", "false").lower() == "true"
        body = None if named else json.dumps({"query": query, "resultFormat": self.options.get("resultformat", "objectLines")}).encode()
        request = urllib.request.Request(f"{url.rstrip('/')}/{query}" if named else url, data=body, headers={"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=float(self.options.get("timeout", 600))) as answer:  # other statuses than 200 raise
            for line in answer:
                yield line.decode()


class CommandRows(DataSource):
    """Options: command, query, header, onError, timeout."""

    @classmethod
    def name(cls) -> str:
        return "aggstate_command"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _CommandReader(schema, dict(self.options))


class HttpRows(DataSource):
    """Options: url, query, named (the query is a name below the URL), resultFormat, header, onError, timeout."""

    @classmethod
    def name(cls) -> str:
        return "aggstate_http"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _HttpReader(schema, dict(self.options))


class _Written(WriterCommitMessage):
    def __init__(self, own: str | None, rows: int) -> None:
        self.own, self.rows = own, rows


class _RowBinaryWriter(DataSourceWriter):
    """One file for each partition; they appear under their names when all of them are written."""

    def __init__(self, folder: str, overwrite: bool) -> None:
        self.folder, self.overwrite = folder.removeprefix("file://"), overwrite

    def write(self, iterator) -> WriterCommitMessage:
        os.makedirs(self.folder, exist_ok=True)
        own, rows = f"{self.folder}/.{uuid.uuid4().hex}", 0
        with open(own, "wb") as f:
            for (data,) in iterator:
                f.write(bytes(data))
                rows += 1
        return _Written(own, rows)

    def commit(self, messages) -> None:
        if self.overwrite:
            for name in os.listdir(self.folder):
                if name.endswith(".rowbinary"):
                    os.remove(f"{self.folder}/{name}")
        for m in messages:
            if m.rows:
                os.replace(m.own, f"{self.folder}/part-{os.path.basename(m.own)[1:]}.rowbinary")
            else:
                os.remove(m.own)

    def abort(self, messages) -> None:
        for m in messages:
            if m is not None and os.path.exists(m.own):
                os.remove(m.own)


class RowBinary(DataSource):
    """Writes one binary column, whose values stand one after the other; option path: a folder that all workers can open."""

    @classmethod
    def name(cls) -> str:
        return "aggstate_rowbinary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if [f.dataType.simpleString() for f in schema] != ["binary"]:
            raise ValueError("one binary column is written")
        return _RowBinaryWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    for source in (CommandRows, HttpRows, RowBinary):
        spark.dataSource.register(source)


def answered(spark: SparkSession, query: str, schema: str, **options: str) -> DataFrame:
    """The rows of a query (several: parted by ``;;``) that a command or a URL answers."""
    register(spark)
    kind = "aggstate_command" if "command" in options else "aggstate_http"
    return spark.read.format(kind).schema(schema).options(query=query, **options).load()
