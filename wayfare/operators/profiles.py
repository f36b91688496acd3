"""Profiles derived from history: guests, passengers, routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.dates import joined_date, to_day
from ..functions.numeric import exact_mean, exact_sum, mean, round_half_up

# Fixed value: status of travellers without a frequent flyer programme.
NO_STATUS = "Non-Member"


def first_known(c: str, order: Sequence[str]) -> Column:
    """The value that comes first by ``order`` among the non-NULL ones.

    Spark rows have no file order, so the order is stated; the value itself
    ends the tuple, which makes it total.
    """
    entry = F.struct(*[F.col(o) for o in order], F.col(c).alias("_value"))
    return F.min(F.when(F.col(c).isNotNull(), entry))["_value"]


def most_common(c: str) -> Column:
    """Most frequent non-NULL value, the smallest one among ties."""
    return F.mode(c, deterministic=True)


def guests(bookings: DataFrame, order: Sequence[str] = ("reservation_status_date",)) -> DataFrame:
    """One row per e-mail. A single partial + final aggregation, so a hot guest
    reaches its final task as one partial row per input task."""
    known = bookings.filter(F.col("email").isNotNull())
    if "phone-number" not in known.columns:
        known = known.withColumn("phone-number", F.lit(None).cast("string"))
    nights = F.col("stays_in_weekend_nights") + F.col("stays_in_week_nights")
    profile = known.groupBy("email").agg(
        first_known("name", order).alias("name"),
        first_known("country", order).alias("country"),
        first_known("phone-number", order).alias("phone"),
        F.count_if(F.col("is_canceled") == 0).alias("total_stays"),
        F.sum("is_canceled").alias("total_cancellations"),
        exact_sum(F.col("adr") * nights).alias("lifetime_spend"),
        mean("adr").alias("avg_adr"),
        most_common("meal").alias("preferred_meal"),
        most_common("reserved_room_type").alias("preferred_room"),
        F.sum("total_of_special_requests").alias("total_special_requests"),
        F.min(to_day(known, "reservation_status_date")).alias("first_booking"),
    )
    return profile.select(
        labels.guest_id().alias("guest_id"),
        "name",
        "email",
        "phone",
        "country",
        labels.loyalty_tier().alias("loyalty_tier"),
        "total_stays",
        "total_cancellations",
        "lifetime_spend",
        "avg_adr",
        "preferred_meal",
        "preferred_room",
        "total_special_requests",
        joined_date("first_booking", "email").cast("string").alias("joined_date"),
    )


def passengers(flights: DataFrame, order: Sequence[str] = ("Departure_Time", "Flight_ID")) -> DataFrame:
    profile = (
        flights.filter(F.col("Passenger_ID").isNotNull())
        .groupBy("Passenger_ID")
        .agg(
            first_known("Age", order).alias("age"),
            first_known("Gender", order).alias("gender"),
            first_known("Income_Level", order).alias("income_level"),
            F.coalesce(first_known("Frequent_Flyer_Status", order), F.lit(NO_STATUS)).alias("frequent_flyer_status"),
            F.count("Flight_ID").alias("total_flights"),
            F.sum("No_Show").alias("total_no_shows"),
            mean("Flight_Satisfaction_Score").alias("avg_satisfaction"),
            mean("Price_USD").alias("avg_price_paid"),
            round_half_up(exact_sum("Delay_Minutes"), 1).alias("total_delay_minutes"),
            most_common("Seat_Class").alias("preferred_class"),
            most_common("Check_in_Method").alias("preferred_checkin"),
            most_common("Travel_Purpose").alias("primary_travel_purpose"),
            most_common("Airline").alias("preferred_airline"),
        )
    )
    no_show = round_half_up(F.try_divide("total_no_shows", "total_flights"), 3)
    return profile.select(
        "Passenger_ID", "age", "gender", "income_level", "frequent_flyer_status",
        labels.satisfaction_segment().alias("satisfaction_segment"),
        "total_flights", "total_no_shows",
        no_show.alias("no_show_rate"),
        "avg_satisfaction", "avg_price_paid", "total_delay_minutes",
        "preferred_class", "preferred_checkin", "primary_travel_purpose", "preferred_airline",
    )


def routes(flights: DataFrame) -> DataFrame:
    """One row per departure, arrival and airline; all means to 3 places."""
    keys = ("Departure_Airport", "Arrival_Airport", "Airline")
    known = flights.dropna(subset=list(keys))

    def average(c: str) -> Column:
        return round_half_up(exact_mean(c), 3)

    def status_share(status: str) -> Column:
        hits = F.count_if(F.col("Flight_Status") == status)
        return round_half_up(hits.cast("double") / F.count(F.lit(1)), 3)

    profile = known.groupBy(*keys).agg(
        F.count("Flight_ID").alias("total_flights"),
        average("Flight_Satisfaction_Score").alias("avg_satisfaction"),
        average("Delay_Minutes").alias("avg_delay_minutes"),
        average("No_Show").alias("no_show_rate"),
        status_share("Cancelled").alias("pct_cancelled"),
        status_share("Delayed").alias("pct_delayed"),
        status_share("On-time").alias("pct_on_time"),
        average("Price_USD").alias("avg_price_usd"),
        average("Flight_Duration_Minutes").alias("avg_duration_minutes"),
        average("Distance_Miles").alias("avg_distance_miles"),
        average("Weather_Impact").alias("weather_impact_rate"),
    )
    return profile.select(
        labels.route_id().alias("route_id"), *profile.columns, labels.route_tier().alias("performance_tier")
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
    )


def example_per_group(df: DataFrame, group: str, metric: str, tie: str, columns: Sequence[str], n: int = 4) -> DataFrame:
    """For each group its row with the greatest metric (ties: smallest key).

    ``min_by`` over partial minima, not a ranked window: a group of any size
    costs one candidate row per task.
    """
    row = F.struct(*columns)
    best = F.min_by(row, F.struct((-F.col(metric)).alias("_metric"), F.col(tie).alias("_tie")))
    picked = df.filter(F.col(metric).isNotNull()).groupBy(group).agg(best.alias("_row")).select("_row.*")
    return picked.orderBy(F.desc(metric), tie).limit(n)


def packages_summary(packages: DataFrame) -> DataFrame:
    """Packages and their bookings, premium and standard, in one row."""
    premium, standard = F.col("is_premium") == 1, F.col("is_premium") == 0
    return packages.agg(
        F.count_if(premium).alias("premium_packages"),
        F.count_if(standard).alias("standard_packages"),
        F.sum(F.when(premium, F.col("bookings"))).alias("premium_package_bookings"),
        F.sum(F.when(standard, F.col("bookings"))).alias("standard_package_bookings"),
    )


def preview(df: DataFrame, columns: Sequence[str], n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows of an order: each task keeps its own first ``n``."""
    return df.select(*columns).orderBy(*order).limit(n)


def by_price(packages: DataFrame) -> DataFrame:
    return packages.orderBy("hotel_type", "base_price")
