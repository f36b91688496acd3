"""Curated bookings and feedback: the tables behind the SQL reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.coerce import to_flag, to_whole
from ..functions.content import NULL, SEPARATOR, as_text, from_text, kept_apart
from ..functions.dates import date_from_parts, month_number, to_day
from ..functions.numeric import finite, round_half_up
from .hotel import total_nights

# Numeric columns cast, month used for an unknown name, column
# order of the curated table, the four feedback scores.
INT_COLUMNS = (
    "lead_time", "adults", "babies", "stays_in_weekend_nights", "stays_in_week_nights", "booking_changes",
    "days_in_waiting_list", "previous_cancellations", "total_of_special_requests",
)
FLAG_COLUMNS = ("is_canceled", "is_repeated_guest")
UNKNOWN_MONTH = 1
COLUMNS = (
    "hotel", "is_canceled", "lead_time", "arrival_date", "total_nights", "adults", "children", "babies",
    "meal_plan", "country", "market_segment", "distribution_channel", "is_repeated_guest",
    "previous_cancellations", "reserved_room_type", "assigned_room_type", "room_upgrade", "booking_changes",
    "deposit_type", "days_in_waiting_list", "customer_type", "adr", "special_requests",
    "reservation_status", "reservation_status_date", "is_premium_meal", "revenue_bucket",
)
SCORES = ("checkin_satisfaction", "room_satisfaction", "food_satisfaction", "value_for_money")
# copies of one booking are numbered in blocks of this many
KEY_BLOCK = 1_000_000


def cast_columns(df: DataFrame) -> dict[str, Column]:
    casts = {c: to_whole(df, c) for c in INT_COLUMNS}
    casts |= {c: to_flag(df, c) for c in FLAG_COLUMNS}
    return casts | {
        "children": F.coalesce(to_whole(df, "children"), F.lit(0)),
        # double, not float: 32 bits lose cents above 131,072
        "adr": finite(F.col("adr").try_cast("double")),
    }


def shaped(raw: DataFrame) -> DataFrame:
    """Typed, derived and renamed bookings, those that ``fits`` leaves out too."""
    month = month_number("arrival_date_month", unknown=UNKNOWN_MONTH)
    day, year = to_whole(raw, "arrival_date_day_of_month"), to_whole(raw, "arrival_date_year")
    typed = raw.withColumns(cast_columns(raw))
    derived = typed.withColumns(
        {
            "arrival_date": date_from_parts(year, month, day),
            "total_nights": total_nights(),
            "room_upgrade": F.col("reserved_room_type") != F.col("assigned_room_type"),
            "is_premium_meal": F.col("meal").isin(*labels.PREMIUM_MEALS),
            "revenue_bucket": labels.revenue_bucket(),
            "reservation_status_date": to_day(raw, "reservation_status_date"),
        }
    ).withColumnsRenamed({"meal": "meal_plan", "total_of_special_requests": "special_requests"})
    return derived.select(*COLUMNS)


def fits() -> Column:
    """Whether a shaped row is one of the curated bookings."""
    return F.col("adr").isNotNull() & F.col("arrival_date").isNotNull() & has_quality()


def bookings(raw: DataFrame) -> DataFrame:
    """Typed, derived, renamed and filtered bookings, without the key.

    The reports never read the key, and leaving it out keeps this plan free of
    a shuffle; ``with_booking_id`` adds it to the stored table.
    """
    return quality(complete(shaped(raw)))


def complete(df: DataFrame) -> DataFrame:
    """Rows with a rate and an arrival date."""
    return df.dropna(subset=["adr", "arrival_date"])


def has_quality() -> Column:
    return (F.col("adr") >= 0) & (F.col("total_nights") > 0)


def quality(df: DataFrame) -> DataFrame:
    return df.filter(has_quality())


def content_hash(df: DataFrame) -> Column:
    """128 bits over all columns: no collisions to expect at 10**12 rows."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL)) for c in df.columns]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def with_booking_id(df: DataFrame) -> DataFrame:
    """Prefix a key that depends on the row's content only.

    ``monotonically_increasing_id`` changes when files are split differently.
    Here equal rows are first combined and counted (so a row copied a billion
    times travels once per task; rows travel as text), then re-emitted with copy numbers 1..n. Numbers
    beyond one block are cut into blocks that are dealt over the cluster before
    they are spelled out, so that the copies of one row leave from many tasks;
    all other rows stay where they are.
    """
    one, block = F.lit(1).cast("bigint"), F.lit(KEY_BLOCK).cast("bigint")
    rows = as_text(df, "_row")
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    few = counted.filter(F.col("_n") <= KEY_BLOCK).withColumn("_copy", F.explode(F.sequence(one, F.col("_n"))))
    blocks = counted.filter(F.col("_n") > KEY_BLOCK).withColumn("_start", F.explode(F.sequence(one, F.col("_n"), block)))
    end = F.least(F.col("_n"), F.col("_start") + (KEY_BLOCK - 1))
    many = blocks.repartition(*rows.columns, "_start").withColumn("_copy", F.explode(F.sequence(F.col("_start"), end)))
    # columns named anew: a union keeps the names of its first branch down to the scan, and with
    # names of their own the branches would not share the exchange
    named = [F.col(f"`{c}`").alias(c) for c in rows.columns]
    numbered = few.select(*named, "_copy").unionByName(many.select(*named, "_copy"))
    # the text is the one that ``content_hash`` takes, unless some columns are not in it
    content = content_hash(df) if kept_apart(df) else F.md5("_row")
    key = F.concat(F.lit("BK"), content, F.lit("-"), F.col("_copy").cast("string"))
    return from_text(numbered, "_row", df.schema).select(key.alias("booking_id"), *[F.col(f"`{c}`") for c in df.columns])


def with_quick_id(df: DataFrame) -> DataFrame:
    """Unique within one run, no shuffle, but not the same on the next run."""
    key = F.concat(F.lit("BK"), F.monotonically_increasing_id().cast("string"))
    return df.select(key.alias("booking_id"), *df.columns)


def feedback(raw: DataFrame) -> DataFrame:
    """Typed feedback with NPS category and the mean of the four scores."""
    typed = raw.withColumns(
        {c: to_whole(raw, c) for c in ("nps_score", *SCORES)} | {"stay_date": to_day(raw, "stay_date")}
    )
    score = F.lit(0)
    for c in SCORES:
        score = score + F.col(c)
    return typed.withColumns(
        {"nps_category": labels.nps_category(), "avg_satisfaction": round_half_up(score / F.lit(4.0), 2)}
    ).drop(*SCORES, "_ingested_at")
