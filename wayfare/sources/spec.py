"""Declared column types of each source, compiled to one ``select``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import to_float, to_int, to_text


@dataclass(frozen=True)
class TableSpec:
    name: str
    ints: tuple[str, ...]
    floats: tuple[str, ...]
    texts: tuple[str, ...]
    required: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        return self.ints + self.floats + self.texts

    def coerce(self, df: DataFrame) -> DataFrame:
        """Typed copy of ``df`` in its own column order; other columns pass.

        A missing column is an error for a ``required`` spec and is skipped
        otherwise.
        """
        missing = [c for c in self.columns if c not in df.columns]
        if self.required and missing:
            raise ValueError(f"{self.name}: missing columns {missing}")
        rule = {
            **dict.fromkeys(self.ints, to_int),
            **dict.fromkeys(self.floats, to_float),
            **dict.fromkeys(self.texts, to_text),
        }
        return df.select(
            [rule[c](F.col(f"`{c}`")).alias(c) if c in rule else F.col(f"`{c}`") for c in df.columns]
        )


# ---------------------------------------------------------------------------
# Column names and types of the sources.
# ---------------------------------------------------------------------------
BOOKINGS = TableSpec(
    "bookings",
    ints=(
        "is_canceled", "lead_time", "arrival_date_year", "arrival_date_week_number",
        "arrival_date_day_of_month", "stays_in_weekend_nights", "stays_in_week_nights", "adults",
        "babies", "is_repeated_guest", "previous_cancellations", "previous_bookings_not_canceled",
        "booking_changes", "days_in_waiting_list", "required_car_parking_spaces",
        "total_of_special_requests",
    ),
    floats=("children", "agent", "company", "adr"),
    texts=(
        "hotel", "arrival_date_month", "meal", "country", "market_segment", "distribution_channel",
        "reserved_room_type", "assigned_room_type", "deposit_type", "customer_type",
        "reservation_status", "reservation_status_date", "name", "email", "phone-number", "credit_card",
    ),
    required=True,
)
GUESTS = TableSpec(
    "guests",
    ints=("total_stays", "total_cancellations", "total_special_requests"),
    floats=("lifetime_spend", "avg_adr"),
    texts=(
        "guest_id", "name", "email", "phone", "country", "loyalty_tier", "preferred_meal",
        "preferred_room", "joined_date",
    ),
    required=True,
)
PACKAGES = TableSpec(
    "packages",
    ints=("includes_spa", "includes_transfer", "is_premium"),
    floats=("base_price",),
    texts=("package_id", "package_name", "meal_type", "room_type", "hotel_type"),
    required=True,
)
FLIGHTS = TableSpec(
    "flights",
    ints=("Flight_Duration_Minutes", "Distance_Miles", "Age", "Bags_Checked", "No_Show", "Weather_Impact"),
    floats=("Price_USD", "Flight_Satisfaction_Score", "Delay_Minutes", "Booking_Days_In_Advance"),
    texts=(
        "Passenger_ID", "Flight_ID", "Airline", "Departure_Airport", "Arrival_Airport", "Departure_Time",
        "Flight_Status", "Gender", "Income_Level", "Travel_Purpose", "Seat_Class",
        "Frequent_Flyer_Status", "Check_in_Method", "Seat_Selected",
    ),
)
PASSENGERS = TableSpec(
    "passengers",
    ints=("age", "total_flights", "total_no_shows"),
    floats=("no_show_rate", "avg_satisfaction", "avg_price_paid", "total_delay_minutes"),
    texts=(
        "Passenger_ID", "gender", "income_level", "frequent_flyer_status", "satisfaction_segment",
        "preferred_class", "preferred_checkin", "primary_travel_purpose", "preferred_airline",
    ),
)
ROUTES = TableSpec(
    "routes",
    ints=("total_flights",),
    floats=(
        "avg_satisfaction", "avg_delay_minutes", "no_show_rate", "pct_cancelled", "pct_delayed",
        "pct_on_time", "avg_price_usd", "avg_duration_minutes", "avg_distance_miles",
        "weather_impact_rate",
    ),
    texts=("route_id", "Departure_Airport", "Arrival_Airport", "Airline", "performance_tier"),
)
PROFILE_SCHEMA = (
    "guest_id string, country string, loyalty_tier string, total_stays int, total_spend_eur double, "
    "avg_lead_time_days int, preferred_segment string, enrolled_date string, email_opt_in string"
)
FEEDBACK_SCHEMA = (
    "feedback_id string, guest_id string, hotel_type string, package_name string, stay_date string, "
    "nps_score int, checkin_satisfaction int, room_satisfaction int, food_satisfaction int, "
    "value_for_money int, would_return string, booking_channel string"
)
# ---------------------------------------------------------------------------
