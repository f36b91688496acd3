"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    It cuts the lineage, outlives lost executors, and gives the planner the
    real size, so that only tables measured as small are broadcast.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def blank_trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


#: Bits of a bitmap of ids: 8 MB, whatever the number of ids.
BITMAP_BITS = 1 << 26


def bitmaps(ids: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """(bucket, bitmap) of the hashes of the column ``id``: at most ``bits`` / 8 bytes in all."""
    place = F.pmod(F.xxhash64("id"), F.lit(bits)) + 1
    placed = ids.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("at"))
    return placed.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bitmap"))


def perhaps_in(df: DataFrame, id: Column, maps: DataFrame, name: str, bits: int = BITMAP_BITS) -> DataFrame:
    """``df`` with a boolean ``name``: false only where the id is surely not among those of ``maps``.

    ``maps`` is broadcast, as its size is bounded. It saves shuffling the rows that
    an exact join by id would not touch; the caller makes that join on the others.
    """
    place = F.pmod(F.xxhash64(id), F.lit(bits)) + 1
    bucket, bitmap = fresh(df, "its_bucket"), fresh(df, "its_bitmap")
    small = F.broadcast(maps.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap)))
    joined = df.join(small, F.bitmap_bucket_number(place) == F.col(bucket), "left")
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1) == 1
    return joined.withColumn(name, F.coalesce(held, F.lit(False))).drop(bucket, bitmap)


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per context, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "_wayfare_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="wayfare-")) / "wayfare_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._wayfare_shipped = True
