"""Named tables, connector reads and namespaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, root: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A catalogue table, or the folder ``root/name`` when a root is given."""
    return spark.table(name) if root is None else spark.read.format(fmt).load(f"{root}/{name}")


def read_connector(spark: SparkSession, fmt: str, table: str, schema: str | None = None, **options: str) -> DataFrame:
    """Read through any connector on the user's class path, by format name."""
    reader = spark.read.format(fmt).options(**options).option("dbtable", table)
    if schema:
        reader = reader.option("schema", schema)
    return reader.load()


def use_namespace(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database if needed and make it current."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
    spark.catalog.setCurrentDatabase(database)
