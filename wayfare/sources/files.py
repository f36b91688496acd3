"""Delimited files and folder listings.

A quoted field may hold line feeds, so records are read whole: then a file is one
task, and large extracts should come in many files. ``one_line=True`` is for files known to
have no such field; these are split like any text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import NULL_TOKENS, null_token
from .spec import TableSpec


def read_text_columns(spark: SparkSession, path: str, one_line: bool = False) -> DataFrame:
    """Every column as text, empty fields as '' (no missing values)."""
    return spark.read.csv(path, header=True, escape='"', multiLine=not one_line).fillna("")


def read_csv(
    spark: SparkSession, path: str, spec: TableSpec, tokens: tuple[str, ...] = NULL_TOKENS, one_line: bool = False
) -> DataFrame:
    """CSV scan: missing-value tokens to NULL, then the types of ``spec``.

    The scan reads only the columns the plan uses.
    """
    raw = spark.read.csv(path, header=True, escape='"', multiLine=not one_line)
    return spec.coerce(raw.select([null_token(F.col(f"`{c}`"), tokens).alias(c) for c in raw.columns]))


def read_typed_csv(spark: SparkSession, path: str, schema: str, one_line: bool = False, corrupt: str | None = None) -> DataFrame:
    """CSV whose columns already have a declared schema; bad fields are NULL.

    ``corrupt`` names a column for the text of records that don't fit the schema, NULL for the others.
    """
    if corrupt is None:
        return spark.read.csv(path, header=True, escape='"', schema=schema, multiLine=not one_line)
    return spark.read.csv(
        path, header=True, escape='"', schema=f"{schema}, {corrupt} string", multiLine=not one_line, columnNameOfCorruptRecord=corrupt
    )


def count_rows(df: DataFrame, column: str) -> DataFrame:
    """Row count that reads a single column of the source."""
    return df.select(F.col(f"`{column}`")).agg(F.count(F.lit(1)).alias("n"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a folder with their size in MB; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        "path",
        (F.col("length") / F.lit(1024.0 * 1024.0)).alias("size_mb"),
        "modificationTime",
    )


def audit(df: DataFrame, source: str | None = None, moment=None) -> DataFrame:
    """Add when and from where rows came; ``source`` NULL means the file path."""
    origin = F.lit(source) if source is not None else F.col("_metadata.file_path")
    return df.withColumns(
        {"_ingested_at": F.current_timestamp() if moment is None else moment, "_source_file": origin}
    )
