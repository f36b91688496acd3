"""Database tables: JDBC, and SQLite files through a Python data source.

No JDBC driver for SQLite ships with Spark, so SQLite files are read and
written by a small ``DataSource``. Reading splits a file into rowid ranges, one
task each. SQLite allows one writer per file; writing therefore gives every
task a file of its own and lists the files of successful tasks in a manifest,
which is what readers follow.
"""

from __future__ import annotations

import json
import os
import shutil
import sqlite3
import sys
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

MANIFEST = "_manifest.json"
BATCH = 10_000


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Table scan over the user's driver, split on a numeric column if given."""
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url, table, column=column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions,
        properties=properties,
    )


def count_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    """The count runs in the database; one row comes back."""
    return spark.read.jdbc(url, f"(SELECT COUNT(*) AS n FROM {table}) counted", properties=properties)


def _files(path: str) -> list[str]:
    if not os.path.isdir(path):
        return [path]
    with open(os.path.join(path, MANIFEST)) as f:
        return [os.path.join(path, name) for name in json.load(f)["files"]]


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _spark_type(declared: str):
    kind = declared.upper()
    return LongType() if "INT" in kind else DoubleType() if kind in ("REAL", "FLOAT", "DOUBLE") else StringType()


def _fit(value, kind):
    """SQLite columns hold any type; what does not fit the column is NULL."""
    if value is None:
        return None
    if isinstance(kind, StringType):
        return value if isinstance(value, str) else str(value)
    if isinstance(value, (int, float)):
        return int(value) if isinstance(kind, LongType) else float(value)
    return None


@dataclass
class RowidRange(InputPartition):
    path: str
    low: int
    high: int


class SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema = schema
        self.path, self.table = options["path"], options["table"]
        self.splits = int(options.get("numPartitions", 8))
        self.counting = options.get("count", "false") == "true"

    def partitions(self):
        out = []
        for path in _files(self.path):
            with _open(path) as con:
                low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {_quote(self.table)}").fetchone()
            if low is None:
                continue
            step = max(BATCH, -(-(high - low + 1) // self.splits))
            out += [RowidRange(path, a, min(a + step - 1, high)) for a in range(low, high + 1, step)]
        return out

    def read(self, part: RowidRange) -> Iterator[tuple]:
        table, span = _quote(self.table), (part.low, part.high)
        con = _open(part.path)
        try:
            if self.counting:
                yield con.execute(f"SELECT COUNT(*) FROM {table} WHERE rowid BETWEEN ? AND ?", span).fetchone()
                return
            names = ", ".join(_quote(f.name) for f in self.schema)
            kinds = [f.dataType for f in self.schema]
            for row in con.execute(f"SELECT {names} FROM {table} WHERE rowid BETWEEN ? AND ?", span):
                yield tuple(_fit(v, k) for v, k in zip(row, kinds))
        finally:
            con.close()


@dataclass
class ShardWritten(WriterCommitMessage):
    name: str


class SqliteWriter(DataSourceWriter):
    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.schema, self.overwrite = schema, overwrite
        self.path, self.table = options["path"], options["table"]

    def write(self, iterator) -> ShardWritten:
        """One shard per task: built on the worker's disk, then copied over."""
        kinds = {"bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "boolean": "INTEGER", "double": "REAL", "float": "REAL"}
        columns = ", ".join(f"{_quote(f.name)} {kinds.get(f.dataType.simpleString(), 'TEXT')}" for f in self.schema)
        marks = ", ".join("?" * len(self.schema))
        name = f"part-{uuid.uuid4().hex}.db"
        with tempfile.TemporaryDirectory() as local:
            file = os.path.join(local, name)
            con = sqlite3.connect(file)
            con.execute(f"CREATE TABLE {_quote(self.table)} ({columns})")
            con.executemany(f"INSERT INTO {_quote(self.table)} VALUES ({marks})", (tuple(row) for row in iterator))
            con.commit()
            con.close()
            os.makedirs(self.path, exist_ok=True)
            shutil.copyfile(file, os.path.join(self.path, name))
        return ShardWritten(name)

    def commit(self, messages) -> None:
        manifest = os.path.join(self.path, MANIFEST)
        files = [m.name for m in messages if m is not None]
        if not self.overwrite and os.path.exists(manifest):
            files = [os.path.basename(f) for f in _files(self.path)] + files
        os.makedirs(self.path, exist_ok=True)
        draft = f"{manifest}.{uuid.uuid4().hex}"
        with open(draft, "w") as f:
            json.dump({"files": files}, f)
        os.replace(draft, manifest)

    def abort(self, messages) -> None:
        """Shards of a failed job are in no manifest, so nobody reads them."""


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        if self.options.get("count", "false") == "true":
            return StructType([StructField("n", LongType())])
        with _open(_files(self.options["path"])[0]) as con:
            listed = con.execute(f"PRAGMA table_info({_quote(self.options['table'])})").fetchall()
        return StructType([StructField(c[1], _spark_type(c[2])) for c in listed])

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> SqliteWriter:
        return SqliteWriter(schema, dict(self.options), overwrite)


def _register(spark: SparkSession) -> None:
    """Make the source known; its classes travel inside the job, so executors
    need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SqliteSource)


def read_sqlite(spark: SparkSession, path: str, table: str, partitions: int = 8) -> DataFrame:
    """A table of one SQLite file, or of a folder written by ``write_sqlite``."""
    _register(spark)
    return spark.read.format("sqlite").options(path=path, table=table, numPartitions=partitions).load()


def count_sqlite(spark: SparkSession, path: str, table: str, partitions: int = 8) -> DataFrame:
    """Row count: each task asks SQLite to count its range."""
    _register(spark)
    counts = spark.read.format("sqlite").options(path=path, table=table, numPartitions=partitions, count="true").load()
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def write_sqlite(df: DataFrame, path: str, table: str) -> None:
    """Replace the table in a folder of SQLite shards on a shared file system."""
    _register(df.sparkSession)
    df.write.format("sqlite").mode("overwrite").options(path=path, table=table).save()
