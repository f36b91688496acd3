"""Flight KPI tables over the silver flights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.numeric import mean, ratio_pct, round_half_up, rows, tally
from .kpi import Kpi
from .kpi_hotel import sort_columns, summarise

# Smallest route reported, and the friction weights.
MIN_ROUTE_FLIGHTS = 5
FRICTION_WEIGHT, SCORE_SCALE = 50, 10

# -- measures shared by the tables ------------------------------------------


def passengers() -> Column:
    return rows().alias("passengers")


def score() -> Column:
    return mean("Flight_Satisfaction_Score").alias("avg_satisfaction")


def no_show_rate() -> Column:
    return mean("No_Show", 3).alias("no_show_rate")


def delay_minutes() -> Column:
    return mean("Delay_Minutes").alias("avg_delay_minutes")


def delay() -> Column:
    return mean("Delay_Minutes").alias("avg_delay")


def price() -> Column:
    return mean("Price_USD").alias("avg_price")


def days_ahead() -> Column:
    return mean("Booking_Days_In_Advance", 1).alias("avg_booking_days")


def satisfied() -> Column:
    return tally("is_satisfied").alias("satisfied_count")


def dissatisfied() -> Column:
    return tally("is_dissatisfied").alias("dissatisfied_count")


def no_shows() -> Column:
    return tally("is_no_show").alias("no_shows")


def satisfaction_rate(whole: str) -> Column:
    return ratio_pct("satisfied_count", whole)


def dissatisfaction_rate(whole: str) -> Column:
    return ratio_pct("dissatisfied_count", whole)


def friction() -> Column:
    discontent = (F.lit(1) - F.col("avg_satisfaction") / F.lit(SCORE_SCALE)) * FRICTION_WEIGHT
    return round_half_up(discontent + F.col("no_show_rate") * FRICTION_WEIGHT, 2)


def kpis(min_flights: int = MIN_ROUTE_FLIGHTS) -> dict[str, Kpi]:
    """The six tables."""
    return {
        "satisfaction_by_segment": Kpi(
            ["p_frequent_flyer_status", "Seat_Class", "p_income_level", "Travel_Purpose", "Gender"],
            [
                passengers(),
                score(),
                no_show_rate(),
                delay(),
                satisfied(),
                tally("is_highly_satisfied").alias("highly_satisfied_count"),
                dissatisfied(),
                mean("Price_USD").alias("avg_price_paid"),
            ],
            lambda: {
                "satisfaction_rate_pct": satisfaction_rate("passengers"),
                "dissatisfaction_rate_pct": dissatisfaction_rate("passengers"),
            },
        ),
        "satisfaction_by_route": Kpi(
            ["r_route_id", "Departure_Airport", "Arrival_Airport", "Airline", "r_performance_tier"],
            [
                rows().alias("total_flights"),
                score(),
                delay_minutes(),
                no_show_rate(),
                mean("Weather_Impact", 3).alias("weather_impact_rate"),
                satisfied(),
                dissatisfied(),
                price(),
                F.count_if(F.col("Flight_Status") == "Cancelled").alias("cancelled_flights"),
            ],
            lambda: {
                "satisfaction_rate_pct": satisfaction_rate("total_flights"),
                "cancellation_rate_pct": ratio_pct("cancelled_flights", "total_flights"),
            },
            having=lambda: F.col("total_flights") >= min_flights,
        ),
        "noshow_by_booking_pattern": Kpi(
            ["booking_bucket", "Travel_Purpose", "p_frequent_flyer_status"],
            [
                passengers(),
                no_shows(),
                no_show_rate(),
                score(),
                days_ahead(),
                price(),
                tally("is_last_minute").alias("last_minute_bookings"),
            ],
            lambda: {"no_show_pct": ratio_pct("no_shows", "passengers")},
        ),
        "friction_by_checkin": Kpi(
            ["Check_in_Method", "Seat_Class", "p_frequent_flyer_status"],
            [passengers(), no_show_rate(), score(), delay(), days_ahead(), no_shows(), satisfied(), dissatisfied()],
            lambda: {
                "satisfaction_rate_pct": satisfaction_rate("passengers"),
                "no_show_pct": ratio_pct("no_shows", "passengers"),
            },
        ),
        "delay_impact": Kpi(
            ["delay_bucket", "Flight_Status", "Weather_Impact", "Airline"],
            [rows().alias("flights"), score(), delay_minutes(), no_show_rate(), satisfied(), dissatisfied(), price()],
            lambda: {
                "satisfaction_rate_pct": satisfaction_rate("flights"),
                "dissatisfaction_rate_pct": dissatisfaction_rate("flights"),
            },
        ),
        "traveler_profile": Kpi(
            ["p_frequent_flyer_status", "Seat_Class", "Check_in_Method", "Travel_Purpose", "booking_bucket", "time_of_day"],
            [
                passengers(),
                score(),
                no_show_rate(),
                delay(),
                price(),
                days_ahead(),
                satisfied(),
                tally("is_no_show").alias("no_show_count"),
                tally("is_last_minute").alias("last_minute_count"),
                tally("is_premium_class").alias("premium_class_count"),
            ],
            lambda: {
                "satisfaction_rate_pct": satisfaction_rate("passengers"),
                "no_show_pct": ratio_pct("no_show_count", "passengers"),
                "friction_score": friction(),
            },
        ),
    }


def satisfaction_by_segment(flown: DataFrame) -> DataFrame:
    return kpis()["satisfaction_by_segment"].build(flown)


def satisfaction_by_route(flown: DataFrame, min_flights: int = MIN_ROUTE_FLIGHTS) -> DataFrame:
    return kpis(min_flights)["satisfaction_by_route"].build(flown)


def noshow_by_booking_pattern(flown: DataFrame) -> DataFrame:
    return kpis()["noshow_by_booking_pattern"].build(flown)


def friction_by_checkin(flown: DataFrame) -> DataFrame:
    return kpis()["friction_by_checkin"].build(flown)


def delay_impact(flown: DataFrame) -> DataFrame:
    return kpis()["delay_impact"].build(flown)


def traveler_profile(flown: DataFrame) -> DataFrame:
    return kpis()["traveler_profile"].build(flown)


TABLES = {
    "satisfaction_by_segment": satisfaction_by_segment,
    "satisfaction_by_route": satisfaction_by_route,
    "noshow_by_booking_pattern": noshow_by_booking_pattern,
    "friction_by_checkin": friction_by_checkin,
    "delay_impact": delay_impact,
    "traveler_profile": traveler_profile,
}
# reading order of each table; "-" is descending
ORDER = {
    "satisfaction_by_segment": ("-avg_satisfaction",),
    "satisfaction_by_route": ("-avg_satisfaction",),
    "noshow_by_booking_pattern": ("-no_show_rate",),
    "friction_by_checkin": ("-no_show_rate",),
    "traveler_profile": ("-friction_score",),
}


def by(name: str, table: DataFrame) -> DataFrame:
    if name == "delay_impact":
        return table.orderBy(labels.ordinal("delay_bucket", labels.label_order(labels.DELAY)), "Airline")
    return table.orderBy(*sort_columns(ORDER[name]))


def headline(flown: DataFrame) -> DataFrame:
    return flown.agg(
        rows().alias("total_passengers"),
        mean("Flight_Satisfaction_Score").alias("overall_avg_satisfaction"),
        mean("No_Show", 3).alias("overall_no_show_rate"),
        mean("Delay_Minutes").alias("overall_avg_delay"),
        satisfied(),
        dissatisfied(),
        tally("is_no_show").alias("total_no_shows"),
    )


def checkin_preview(friction: DataFrame) -> DataFrame:
    """Per check-in method from the friction table: means of the group means."""
    return (
        friction.groupBy("Check_in_Method")
        .agg(
            F.sum("passengers").alias("total"),
            mean("no_show_rate", 3, scale=3).alias("avg_no_show_rate"),
            mean("avg_satisfaction").alias("avg_satisfaction"),
        )
        .orderBy(F.desc("avg_no_show_rate"))
    )


def delay_preview(delays: DataFrame) -> DataFrame:
    return (
        delays.groupBy("delay_bucket")
        .agg(
            F.sum("flights").alias("total_flights"),
            mean("avg_satisfaction").alias("avg_satisfaction"),
            mean("no_show_rate", 3, scale=3).alias("avg_no_show_rate"),
        )
        .orderBy(F.desc("avg_satisfaction"))
    )


def band_counts(flown: DataFrame) -> DataFrame:
    return flown.groupBy("satisfaction_band").agg(rows().alias("n")).orderBy(F.desc("n"))


def noshow_by_bucket(flown: DataFrame) -> DataFrame:
    return summarise(flown, ["booking_bucket"], [passengers(), no_show_rate(), score()]).orderBy(F.desc("no_show_rate"))


def satisfaction_by_class(flown: DataFrame) -> DataFrame:
    return summarise(flown, ["Seat_Class"], [passengers(), score(), no_show_rate()]).orderBy(F.desc("avg_satisfaction"))
