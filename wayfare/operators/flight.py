"""Flights: cleaning, derived columns, the silver table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.dates import to_moment
from ..functions.numeric import round_half_up
from .hotel import AUDIT, clamp
from .lookups import attach_passengers, attach_routes

# Defaults for missing fields, delay cap, score and day limits.
MISSING = {"Frequent_Flyer_Status": "Non-Member", "Delay_Minutes": 0.0, "Bags_Checked": 0}
DELAY_MIN, DELAY_MAX = 0.0, 300.0
SATISFIED, HIGHLY_SATISFIED, DISSATISFIED_BELOW = 7.0, 8.0, 5.0
LAST_MINUTE_DAYS = 7


def departure_columns() -> dict[str, Column]:
    moment = to_moment("Departure_Time")
    return {
        "departure_ts": moment,
        "departure_date": F.to_date(moment),
        "departure_hour": F.hour(moment),
        "departure_month": F.month(moment),
        "departure_year": F.year(moment),
    }


def clean(flights: DataFrame) -> DataFrame:
    return (
        flights.fillna(MISSING)
        .withColumns({"Delay_Minutes": clamp("Delay_Minutes", DELAY_MIN, DELAY_MAX)} | departure_columns())
        .drop(*AUDIT, "Departure_Time")
    )


def satisfaction_columns() -> dict[str, Column]:
    score = F.col("Flight_Satisfaction_Score")
    return {
        "is_satisfied": score >= SATISFIED,
        "is_highly_satisfied": score >= HIGHLY_SATISFIED,
        "is_dissatisfied": score < DISSATISFIED_BELOW,
        "satisfaction_band": labels.satisfaction_band(),
    }


def journey_columns() -> dict[str, Column]:
    return {
        "is_delayed": F.col("Delay_Minutes") > 0,
        "delay_bucket": labels.delay_bucket(),
        "booking_bucket": labels.booking_bucket(),
        "is_last_minute": F.col("Booking_Days_In_Advance") <= LAST_MINUTE_DAYS,
        "is_no_show": F.col("No_Show") == 1,
        "is_premium_class": F.col("Seat_Class").isin(*labels.PREMIUM_CLASSES),
        "time_of_day": labels.time_of_day(),
    }


def lookup_columns() -> dict[str, Column]:
    return {
        "is_loyal_passenger": F.col("p_frequent_flyer_status").isin(*labels.UPPER_TIERS),
        "price_vs_route_avg": round_half_up(F.col("Price_USD") - F.col("r_avg_price_usd"), 2),
    }


def silver(flights: DataFrame, passengers: DataFrame, routes: DataFrame, moment: Column | None = None) -> DataFrame:
    wide = attach_routes(attach_passengers(clean(flights), passengers), routes)
    wide = wide.withColumns(satisfaction_columns() | journey_columns() | lookup_columns())
    return wide if moment is None else wide.withColumn("_silver_processed_at", moment)


def flag_counts(silver_flights: DataFrame) -> DataFrame:
    """All flag totals of the table in one pass."""
    flags = (
        "is_satisfied", "is_dissatisfied", "is_no_show", "is_delayed", "is_premium_class", "is_last_minute",
    )
    return silver_flights.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(f)).alias(f"n_{f[3:]}") for f in flags]
    )
