"""Detecting new source data, and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.content import content_key, moved

# Keys that identify a row to the upserts. A guest's id has 32 bits of the e-mail's
# hash, which two guests can share: it is a label, and the e-mail is the key.
BOOKING_KEY = ("email", "arrival_date_year", "arrival_date_month", "arrival_date_day_of_month")
GUEST_KEY = ("email",)


def count_gap(name: str, source: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Rows in the source and in the stored table, and the difference.

    Two aggregates, tagged and added up: no join and no action here. Without a
    stored table its columns are NULL.
    """
    sides = [source.agg(F.count(F.lit(1)).alias("in_source")).withColumn("in_bronze", F.lit(None).cast("bigint"))]
    if stored is not None:
        counted = stored.agg(F.count(F.lit(1)).alias("in_bronze"))
        sides.append(counted.select(F.lit(None).cast("bigint").alias("in_source"), "in_bronze"))
    both = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    return both.agg(F.sum("in_source").alias("in_source"), F.sum("in_bronze").alias("in_bronze")).select(
        F.lit(name).alias("source"), "in_source", "in_bronze", (F.col("in_source") - F.col("in_bronze")).alias("new_rows")
    )


def content_gap(name: str, source: DataFrame, stored: DataFrame) -> DataFrame:
    """Counts of both sides, and rows only in one of them, with multiplicity.

    Equal counts hide edited rows; this does not. Each row is counted on its side
    under the fingerprint of its whole content, with partial sums before the shuffle, so
    copies of one row do not pile up in a task, and no row travels. Each side is read once.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    # the types that the two sides have in common, as a union gives them: equal values must hash alike
    rows = source.withColumns({"_here": one, "_there": none}).unionByName(
        stored.select(*[F.col(f"`{c}`") for c in source.columns]).withColumns({"_here": none, "_there": one})
    )
    key = content_key(rows, source.columns)
    both = rows.select(*[k.alias(f"_k{i}") for i, k in enumerate(key)], "_here", "_there")
    net = both.groupBy(*[f"_k{i}" for i in range(len(key))]).agg(F.sum("_here").alias("_here"), F.sum("_there").alias("_there"))
    more, less = F.greatest(F.col("_here") - F.col("_there"), none), F.greatest(F.col("_there") - F.col("_here"), none)
    return net.agg(
        *[F.coalesce(F.sum(c), none).alias(n) for n, c in (("in_source", F.col("_here")), ("in_bronze", F.col("_there")))],
        *[F.coalesce(F.sum(c), none).alias(n) for n, c in (("only_in_source", more), ("only_in_bronze", less))],
    ).select(
        F.lit(name).alias("source"), "in_source", "in_bronze", (F.col("in_source") - F.col("in_bronze")).alias("new_rows"),
        "only_in_source", "only_in_bronze",
    )


def detect(sources: dict[str, DataFrame], stored: dict[str, DataFrame]) -> DataFrame:
    """One row per source: counts, new rows, and rows that differ.

    A source with no stored counterpart is counted on its side only.
    """
    unknown = F.lit(None).cast("bigint")
    out = None
    for name, source in sources.items():
        if name in stored:
            part = content_gap(name, source, stored[name])
        else:
            part = count_gap(name, source, None).withColumns({"only_in_source": unknown, "only_in_bronze": unknown})
        out = part if out is None else out.unionByName(part)
    return out


def has_keys(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition


def merge(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str], spread: int = 1,
    parts: Sequence[str] = (), buckets: int = 1,
) -> DataFrame:
    """MERGE: matched rows take all incoming values, the others are inserted. ``_action`` says kept, updated or inserted.

    * Several incoming rows of one key: the greatest by ``order``, then by all other columns, counts.
    * A key that occurs several times in ``existing`` has each row updated.
    * A NULL in the key matches nothing, so such rows are inserted as they are,
      again on every run.

    Both tables are read once and go, tagged, through one exchange on the key. There each
    row sees the greatest incoming row of its key, which comes first, and whether a stored one exists.
    The exchange is stated, as a window's own would take the rows after what the window
    needs is added to them, and rows go through it as texts. With ``parts``, columns of the key, it deals the rows of a part over
    at most ``buckets`` tasks, so that the merged rows can be written by part as they come. Rows
    without a key are dealt by their content and the task that read them. A window holds
    the rows of one key and spills them to disk if need be; where a key may have a large
    part of the stored rows, ``spread`` deals these over as many groups, to each of
    which the incoming rows are copied, and a second exchange of the groups' unmatched rows
    alone decides what is inserted.
    """
    columns = existing.columns
    values = [*order, *[c for c in columns if c not in keys and c not in order]]
    known, zero = has_keys(keys), F.lit(0).cast("bigint")
    dealt = F.xxhash64(F.spark_partition_id(), *columns)
    old, new = existing.select(*columns, F.lit(False).alias("_new")), incoming.select(*columns, F.lit(True).alias("_new"))
    if spread > 1:
        old = old.withColumn("_group", F.when(known, F.pmod(F.xxhash64(*columns), F.lit(spread).cast("bigint"))).otherwise(dealt))
        groups = F.sequence(zero, F.lit(spread - 1).cast("bigint"))
        new = new.withColumn("_group", F.explode(F.when(known, groups).otherwise(F.array(dealt))))
    else:
        old, new = (df.withColumn("_group", F.when(known, zero).otherwise(dealt)) for df in (old, new))
    rows, place = old.unionByName(new), [*parts, *[k for k in keys if k not in parts], "_group"]
    if parts:
        rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*place), F.lit(buckets).cast("bigint")))
        dealt_by, place = [*parts, "_bucket"], [*place, "_bucket"]
    else:
        dealt_by = place
    rows = moved(rows, dealt_by, lambda packed: packed.repartition(*dealt_by))
    by = Window.partitionBy(*place).orderBy(F.desc("_new"), *[F.desc(v) for v in values])
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = rows.select(
        "*",
        *[F.first(v).over(whole).alias(f"_first_{k}") for k, v in enumerate(values)],
        (F.first("_new").over(whole) & known).alias("_taken"),
        F.bool_or(~F.col("_new")).over(whole).alias("_stored"),
        F.row_number().over(by).alias("_nth"),
    )
    first = F.col("_new") & known & (F.col("_nth") == 1)
    if spread > 1:
        again = seen.filter(first).withColumn("_stored", F.bool_or("_stored").over(Window.partitionBy(*keys)))
        seen = seen.filter(~first).unionByName(again.filter(F.col("_group") == 0))
    action = (
        F.when(~F.col("_new"), F.when(F.col("_taken"), "updated").otherwise("kept"))
        .when(~known, "inserted")
        .when(first & ~F.col("_stored"), "inserted")
    )
    firsts = {v: F.col(f"_first_{k}") for k, v in enumerate(values)}
    merged = [F.when(F.col("_taken"), firsts[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in columns]
    return seen.select(*merged, action.alias("_action")).filter(F.col("_action").isNotNull())


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str], spread: int = 1) -> DataFrame:
    """The merged table, without the actions."""
    return merge(existing, incoming, keys, order, spread).drop("_action")


def upsert_bookings(existing: DataFrame, incoming: DataFrame, order: Sequence[str] = ("reservation_status_date",)) -> DataFrame:
    return upsert(existing, incoming, BOOKING_KEY, order)


def upsert_guests(existing: DataFrame, incoming: DataFrame, order: Sequence[str] = ("total_stays",)) -> DataFrame:
    return upsert(existing, incoming, GUEST_KEY, order)
