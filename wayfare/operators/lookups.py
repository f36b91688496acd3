"""Lookup projections and the LEFT joins that attach them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.content import as_text, from_text

# ---------------------------------------------------------------------------
# Which lookup columns are attached, and under what prefix.
# ---------------------------------------------------------------------------
GUEST_COLUMNS = {
    "guest_id": "guest_id",
    "loyalty_tier": "g_loyalty_tier",
    "lifetime_spend": "g_lifetime_spend",
    "total_stays": "g_total_stays",
    "total_cancellations": "g_total_cancellations",
    "preferred_meal": "g_preferred_meal",
    "preferred_room": "g_preferred_room",
    "total_special_requests": "g_total_special_requests",
    "joined_date": "g_joined_date",
}
PACKAGE_COLUMNS = {
    "package_id": "p_package_id",
    "package_name": "p_package_name",
    "base_price": "p_base_price",
    "includes_spa": "p_includes_spa",
    "includes_transfer": "p_includes_transfer",
    "is_premium": "p_is_premium",
}
PASSENGER_COLUMNS = {
    "frequent_flyer_status": "p_frequent_flyer_status",
    "satisfaction_segment": "p_satisfaction_segment",
    "avg_satisfaction": "p_avg_satisfaction",
    "total_flights": "p_total_flights",
    "no_show_rate": "p_no_show_rate",
    "preferred_class": "p_preferred_class",
    "preferred_checkin": "p_preferred_checkin",
    "primary_travel_purpose": "p_primary_travel_purpose",
    "income_level": "p_income_level",
    "total_delay_minutes": "p_total_delay_minutes",
}
ROUTE_COLUMNS = {
    "route_id": "r_route_id",
    "avg_satisfaction": "r_avg_satisfaction",
    "avg_delay_minutes": "r_avg_delay_minutes",
    "no_show_rate": "r_no_show_rate",
    "pct_on_time": "r_pct_on_time",
    "pct_cancelled": "r_pct_cancelled",
    "weather_impact_rate": "r_weather_impact_rate",
    "performance_tier": "r_performance_tier",
    "avg_price_usd": "r_avg_price_usd",
}
# ---------------------------------------------------------------------------

ROUTE_KEYS = ("Departure_Airport", "Arrival_Airport", "Airline")


def project(df: DataFrame, keys: Sequence[str], columns: dict[str, str]) -> DataFrame:
    return df.select(*keys, *[F.col(source).alias(name) for source, name in columns.items()])


def guest_lookup(guests: DataFrame) -> DataFrame:
    return project(guests, ["email"], GUEST_COLUMNS)


def package_lookup(packages: DataFrame) -> DataFrame:
    return project(packages, ["meal_type", "room_type", "hotel_type"], PACKAGE_COLUMNS)


def passenger_lookup(passengers: DataFrame) -> DataFrame:
    return project(passengers, ["Passenger_ID"], PASSENGER_COLUMNS)


def route_lookup(routes: DataFrame) -> DataFrame:
    return project(routes, ROUTE_KEYS, ROUTE_COLUMNS)


def attach(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], spread_by: Sequence[str], whole: bool = False) -> DataFrame:
    """LEFT equi-join that stays balanced when many rows have no key.

    A NULL key matches nothing, yet a plain shuffle join sends all such rows to
    one task. They are dealt by a hash of the ``spread_by`` columns (stable when
    a task is re-run), through a second join column that is 0 on every row with a
    key. On the lookup side that zero is
    computed: the optimizer would turn a literal into a filter and shuffle by
    the key alone. Because the column is part of the join key, both inputs are
    shuffled for this join, the shape in which AQE can split a hot key. Nothing
    is broadcast by hint: AQE does so when the measured lookup is small.

    ``whole`` says that all columns are wanted: those that are no keys then travel as one text a row,
    less than half the bytes. Otherwise only columns that are read later travel, and a lookup none of
    whose columns is read is not joined at all.
    """
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    left = facts.withColumn("_group", F.when(no_key, F.xxhash64(*spread_by)).otherwise(F.lit(0).cast("bigint")))
    right = lookup.withColumn("_group", F.pmod(F.xxhash64(*keys), F.lit(1).cast("bigint")))
    if not whole or set(facts.columns) & set(lookup.columns) - set(keys):
        return left.join(right, [*keys, "_group"], "left").drop("_group")
    on = [*keys, "_group"]
    joined = as_text(left, "_facts", on, exact=True).join(as_text(right, "_lookup", on, exact=True), on, "left")
    rows = from_text(from_text(joined, "_lookup", lookup.schema, on), "_facts", facts.schema, on)
    values = [c for c in [*facts.columns, *lookup.columns] if c not in keys]
    return rows.select(*[F.col(f"`{c}`") for c in [*keys, *values]])


def attach_guests(bookings: DataFrame, guests: DataFrame, whole: bool = False) -> DataFrame:
    """Bookings with their guest's columns; one guest row per e-mail. ``whole`` as in ``attach``."""
    return attach(bookings, guest_lookup(guests), ["email"], ["lead_time", "adr", "reserved_room_type"], whole)


def attach_packages(bookings: DataFrame, packages: DataFrame) -> DataFrame:
    """Bookings with the package sold for their meal, room and hotel.

    The catalogue (17 inline rows, or a small table) is broadcast because the
    optimizer knows its size; nothing is hinted.
    """
    offer = package_lookup(packages)
    same = (
        (bookings["meal"] == offer["meal_type"])
        & (bookings["reserved_room_type"] == offer["room_type"])
        & (bookings["hotel"] == offer["hotel_type"])
    )
    return bookings.join(offer, same, "left").drop("meal_type", "room_type", "hotel_type")


def attach_passengers(flights: DataFrame, passengers: DataFrame) -> DataFrame:
    return attach(flights, passenger_lookup(passengers), ["Passenger_ID"], ["Flight_ID"])


def attach_routes(flights: DataFrame, routes: DataFrame) -> DataFrame:
    return attach(flights, route_lookup(routes), ROUTE_KEYS, ["Flight_ID"])


def match_rate(joined: DataFrame, lookup_column: str, name: str) -> DataFrame:
    """Rows, matched rows and matched % of a LEFT join, in one pass."""
    return joined.agg(F.count(F.lit(1)).alias("total_rows"), F.count(lookup_column).alias("matched")).select(
        F.lit(name).alias("lookup"),
        "total_rows",
        "matched",
        F.try_divide(F.lit(100.0) * F.col("matched"), F.col("total_rows")).alias("matched_pct"),
    )
