"""Hotel bookings: cleaning, derived columns, the silver table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.dates import date_from_parts, month_number, to_day
from ..functions.numeric import round_half_up
from .lookups import GUEST_COLUMNS, attach_guests, attach_packages

# Defaults for missing fields, and the price cap.
MISSING = {"children": 0.0, "country": "Unknown", "agent": 0.0, "company": 0.0}
MEAL_ALIAS = {"Undefined": "SC"}
ADR_MIN, ADR_MAX = 0.0, 1000.0

AUDIT = ("_ingested_at", "_source_file")
PERSONAL = ("name", "phone-number", "credit_card")


def clamp(c: str, low: float, high: float) -> Column:
    """Bring into [low, high] and leave NULL alone (least/greatest would not)."""
    x = F.col(c)
    return F.when(x < low, F.lit(low)).when(x > high, F.lit(high)).otherwise(x)


def fill_missing(df: DataFrame) -> DataFrame:
    return df.fillna({c: v for c, v in MISSING.items() if c in df.columns})


def total_nights() -> Column:
    return F.col("stays_in_weekend_nights") + F.col("stays_in_week_nights")


def is_day_use(nights: Column | None = None) -> Column:
    return F.coalesce((total_nights() if nights is None else nights) == 0, F.lit(False))


def clean(bookings: DataFrame) -> DataFrame:
    nights = total_nights()
    return (
        fill_missing(bookings)
        .replace(MEAL_ALIAS, subset=["meal"])
        .withColumns(
            {
                "adr": clamp("adr", ADR_MIN, ADR_MAX),
                "children": F.col("children").cast("int"),
                "arrival_date": date_from_parts(
                    "arrival_date_year", month_number("arrival_date_month"), "arrival_date_day_of_month"
                ),
                "reservation_status_date": to_day(bookings, "reservation_status_date"),
                "total_nights": nights,
                "is_day_use": is_day_use(nights),
            }
        )
        .drop(*AUDIT)
    )


def with_guests(bookings: DataFrame, guests: DataFrame, whole: bool = False) -> DataFrame:
    """Cleaned bookings with their guest's columns. With ``whole`` (see ``lookups.attach``) they are cleaned
    after the join, as cleaning adds columns and leaves the e-mail as it is."""
    if not whole:
        return attach_guests(clean(bookings), guests)
    joined = attach_guests(bookings.drop(*AUDIT), guests, whole)
    columns = ["email", *[c for c in clean(bookings).columns if c != "email"], *GUEST_COLUMNS.values()]
    return clean(joined).select(*[F.col(f"`{c}`") for c in columns])


def total_revenue() -> Column:
    return round_half_up(F.col("adr") * F.col("total_nights"), 2)


def premium_flags() -> dict[str, Column]:
    meal = F.col("meal").isin(*labels.PREMIUM_MEALS)
    room = F.col("reserved_room_type").isin(*labels.PREMIUM_ROOMS)
    return {"is_premium_meal": meal, "is_premium_room": room, "is_premium_booking": meal | room}


def package_columns() -> dict[str, Column]:
    listed = F.col("p_is_premium")
    return {
        "is_catalogue_premium": F.when(listed == 1, True).when(listed == 0, False),
        "price_gap_per_night": round_half_up(F.col("p_base_price") - F.col("adr"), 2),
    }


def booking_columns() -> dict[str, Column]:
    return {
        "was_upgraded": F.col("reserved_room_type") != F.col("assigned_room_type"),
        "lead_time_bucket": labels.lead_time_bucket(),
    }


def guest_columns() -> dict[str, Column]:
    """NULL tier: the upsell flag stays unknown for a standard booking."""
    premium = premium_flags()["is_premium_booking"]
    return {
        "is_upsell_opportunity": ~premium & F.col("g_loyalty_tier").isin(*labels.UPPER_TIERS),
        "guest_value_segment": labels.guest_value_segment(),
    }


def silver(
    bookings: DataFrame, guests: DataFrame, packages: DataFrame, keep_personal: bool = False, moment: Column | None = None,
    whole: bool = False,
) -> DataFrame:
    """Cleaned bookings with guest, package and derived columns.

    Names, phone and card numbers stay in bronze unless asked for.
    ``moment`` adds the processing time column. ``whole`` says that the table is stored or
    given back with all its columns (see ``lookups.attach``).
    """
    if whole and not keep_personal:
        bookings = bookings.drop(*PERSONAL)
    wide = attach_packages(with_guests(bookings, guests, whole), packages)
    wide = wide.withColumns(
        {"total_revenue": total_revenue()}
        | premium_flags()
        | package_columns()
        | booking_columns()
        | guest_columns()
    )
    if not keep_personal:
        wide = wide.drop(*PERSONAL)
    return wide if moment is None else wide.withColumn("_silver_processed_at", moment)


def completed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_canceled") == 0)
