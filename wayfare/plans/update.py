"""Upserts of stored tables: audit columns, merge, write back, counts.

The table is a folder, partitioned by columns of the key or not at all. Only the
partitions that incoming rows are in are read and written; Spark prunes the others
at the scan. Incoming rows are staged once, since they are read twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.content import moved
from ..operators.changes import BOOKING_KEY, GUEST_KEY, merge
from ..session import path_exists, scratch_path, shuffles_freed
from ..sinks.tables import overwrite_path, replace_parts
from ..sources.files import audit

ACTIONS = ("kept", "updated", "inserted")
# merged rows of one partition are written by tasks of about this many
PART_ROWS = 250_000
BOOKING_PARTS = ("arrival_date_year", "arrival_date_month")


def stored_table(incoming: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """The stored table with the columns and types of ``incoming`` (partition columns are only names in a folder)."""
    return incoming.sparkSession.read.format(fmt).schema(incoming.schema).load(path).select(*incoming.columns)


def touched(stored: DataFrame, incoming: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of the partitions that ``incoming`` has rows of; a NULL is a partition too.

    The driver gets one row per such partition, fewer than the table's listing holds, as only
    a filter by values prunes the scan (a join does so if its other side is itself filtered).
    """
    here = incoming.select(*parts).distinct().collect()
    wanted = F.lit(False)
    for part in here:
        same = F.lit(True)
        for p in parts:
            same = same & (F.col(p).isNull() if part[p] is None else F.col(p) == F.lit(part[p]))
        wanted = wanted | same
    return stored.filter(wanted)


def load(path: str, rows: DataFrame, parts: Sequence[str] = (), fmt: str = "parquet") -> int:
    """The first load: all rows as they are, copies of a key too; returns how many."""
    dealt = moved(rows, parts, lambda packed: packed.hint("rebalance", *parts)) if parts else rows
    return overwrite_path(dealt, path, fmt, tuple(parts))


def update(
    path: str, incoming: DataFrame, keys: Sequence[str], order: Sequence[str], parts: Sequence[str] = (),
    fmt: str = "parquet", drop: Column | None = None, spread: int = 1,
) -> dict[str, int]:
    """Merge ``incoming`` into the table at ``path`` (see ``changes.merge``); returns rows per action.

    ``kept`` counts the rows that were read and stayed as they are. ``drop`` marks stored
    rows to be left out. Without a table, ``incoming`` becomes one. The merge is the same when
    it is repeated, but for rows without a key.
    """
    if not set(parts) <= set(keys):
        raise ValueError("parts must be columns of the key")
    spark = incoming.sparkSession
    staged = scratch_path(spark, "incoming")
    with shuffles_freed(spark):
        incoming.write.option("compression", "zstd").parquet(staged)
    new = spark.read.schema(incoming.schema).parquet(staged)
    old = new.limit(0)
    if path_exists(spark, path):
        old = stored_table(new, path, fmt)
        old = touched(old, new, parts) if parts else old
        old = old if drop is None else old.filter(~drop)
    seen = Observation(f"update-{uuid.uuid4().hex}")
    buckets = 1
    if parts:
        held = new.select(*parts).unionByName(old.select(*parts)).groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))
        buckets = -(-(held.agg(F.max("n")).first()[0] or 1) // PART_ROWS)
    merged = merge(old, new, keys, order, spread, parts, buckets).observe(seen, *[F.count_if(F.col("_action") == a).alias(a) for a in ACTIONS]).drop("_action")
    if parts:
        # few files per partition, as the merge has dealt the rows by it
        replace_parts(merged, path, tuple(parts), fmt)
    else:
        overwrite_path(merged, path, fmt)
    return {a: seen.get[a] for a in ACTIONS}


def update_bookings(
    path: str, bookings: DataFrame, order: Sequence[str] = ("reservation_status_date",), origin: str | None = "bookings",
    moment: Column | None = None, parts: Sequence[str] = BOOKING_PARTS, spread: int = 1,
) -> dict[str, int]:
    """New or changed bookings into the bronze table, partitioned by the month of arrival."""
    return update(path, audit(bookings, origin, moment), BOOKING_KEY, order, parts, spread=spread)


def update_guests(
    path: str, guests: DataFrame, order: Sequence[str] = ("total_stays",), origin: str | None = "guests", moment: Column | None = None
) -> dict[str, int]:
    """New or changed guests into the bronze table, which is no larger than its guests and written as a whole."""
    return update(path, audit(guests, origin, moment), GUEST_KEY, order)
