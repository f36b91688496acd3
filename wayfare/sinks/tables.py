"""Table and file writers.

Row counts come from an ``Observation`` taken while writing, so nothing is
scanned a second time. New data is always written whole before anything that is
there is touched: a job that fails leaves the old table as it was. One writer per
table at a time is assumed; several need a table format with its own commits.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, remove_path, rename_path, shuffles_freed


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def _writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    """Parquet is compressed by zstd: half the bytes of Spark's default where columns hold digests."""
    writer = df.write.format(fmt)
    return writer.option("compression", "zstd") if fmt == "parquet" else writer


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> int:
    """Replace a catalogue table, schema included; returns the rows written.

    The data goes to a table of its own name, which then takes the old one's place.
    """
    spark = df.sparkSession
    counted, seen = _counted(df)
    staged = f"{name}_{uuid.uuid4().hex}"
    writer = _writer(counted, fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_freed(spark):
        writer.saveAsTable(staged)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    return seen.get["n"]


def overwrite_path(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> int:
    """Replace a folder; returns the rows written.

    The data goes to a folder beside it, which then takes its place. Between the two
    renames there is no folder of that name; where renaming is no single step (object
    stores), give a catalogue table of a format that commits by itself.
    """
    spark = df.sparkSession
    counted, seen = _counted(df)
    staged, old = f"{path}_new_{uuid.uuid4().hex}", f"{path}_old_{uuid.uuid4().hex}"
    writer = _writer(counted, fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_freed(spark):
        writer.save(staged)
    if path_exists(spark, path):
        rename_path(spark, path, old)
    rename_path(spark, staged, path)
    remove_path(spark, old)
    return seen.get["n"]


def stamped(df: DataFrame, moment: Column | None = None) -> DataFrame:
    return df.withColumn("_gold_updated_at", F.current_timestamp() if moment is None else moment)


def replace_snapshot(df: DataFrame, path: str, key: str = "snapshot_date", fmt: str = "parquet") -> int:
    """Append a snapshot so that a re-run replaces its own date only.

    A plain append would duplicate the rows when the job is repeated.
    """
    counted, seen = _counted(df)
    writer = _writer(counted, fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with shuffles_freed(df.sparkSession):
        writer.partitionBy(key).save(path)
    return seen.get["n"]


def append_path(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    counted, seen = _counted(df)
    _writer(counted, fmt).mode("append").save(path)
    return seen.get["n"]


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV part files with header; quotes inside a field are doubled, white space around it stays.

    ``compression`` is one of Spark's (``gzip``, say): files whose records may span lines are read
    whole anyway, so nothing is lost by it.
    """
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"').option("compression", compression)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_connector(df: DataFrame, fmt: str, table: str, mode: str = "overwrite", **options: str) -> None:
    """Write through any connector on the user's class path, by format name."""
    df.write.format(fmt).options(**options).option("dbtable", table).mode(mode).save()


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "overwrite") -> None:
    """Parallel write to a database table over the user's JDBC driver."""
    df.write.jdbc(url, table, mode=mode, properties=properties)


def replace_parts(df: DataFrame, path: str, parts: tuple[str, ...], fmt: str = "parquet") -> None:
    """Replace the partitions of a folder that ``df`` has rows of; all others stay as they are.

    Spark writes them beside the table and moves them at the end of the job, so ``df`` may
    read the table itself, and a job that fails before leaves it as it was.
    """
    writer = _writer(df, fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with shuffles_freed(df.sparkSession):
        writer.partitionBy(*parts).save(path)


def merge_into(incoming: DataFrame, table: str, keys: tuple[str, ...]) -> None:
    """MERGE by the table's own format, for catalogues whose tables have row-level operations.

    ``incoming`` must have one row per key. Such a table commits by itself.
    """
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(f"new.{key}") == F.col(f"{table}.{key}"))
    incoming.alias("new").mergeInto(table, same).whenMatched().updateAll().whenNotMatched().insertAll().merge()


@dataclass(frozen=True)
class Store:
    """Named tables, in a folder (``root``) or in the session's catalogue."""

    spark: SparkSession
    root: str | None = None
    fmt: str = "parquet"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        if self.root is None:
            return self.spark.table(name)
        if not self.exists(name):
            raise ValueError(f"no table {name} in {self.root}")
        return self.spark.read.format(self.fmt).load(self.path(name))

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name) if self.root is None else path_exists(self.spark, self.path(name))

    def write(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> int:
        if self.root is None:
            return overwrite_table(df, name, self.fmt, partition_by)
        return overwrite_path(df, self.path(name), self.fmt, partition_by)
