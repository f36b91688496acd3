"""KPI tables, their previews and headlines."""

from __future__ import annotations

from verification.ctes import CTES, isum, mean, pct, rnd, tally, total
from wayfare.operators import kpi_flight, kpi_hotel

from .common import Registry

R = Registry()
QUERIES, SQL = R.queries, R.sql

_MONTH = "arrival_date_year, arrival_date_month, CAST(month(arrival_date) AS INT) AS arrival_month_num"
_BOOK = f"count(*) AS total_bookings, {tally('is_premium_booking')} AS premium_bookings"
_ADR, _NIGHTS = f"{mean('adr')} AS avg_adr", f"{mean('total_nights')} AS avg_nights"
_REV = f"{total('total_revenue')} AS total_revenue"
_PREM_REV = f"{total('CASE WHEN is_premium_booking THEN total_revenue ELSE 0 END')} AS premium_revenue"
_LIST, _GAP = f"{mean('p_base_price')} AS avg_catalogue_price", f"{mean('price_gap_per_night')} AS avg_price_gap"
_PER = f"{rnd('(total_revenue/total_bookings)')} AS revenue_per_booking"
_RATE = f"{pct('premium_bookings', 'total_bookings')} AS premium_rate_pct"

CTES["gold_package"] = f"""
SELECT {_MONTH}, meal, is_premium_meal, hotel, count(*) AS bookings, {_ADR}, {_NIGHTS}, {_REV}, {_LIST}, {_GAP}
FROM stays GROUP BY ALL"""
CTES["gold_conversion"] = f"""
SELECT *, {pct('premium_bookings', 'total_bookings')} AS premium_conversion_pct,
  {pct('premium_revenue', 'total_revenue')} AS premium_revenue_pct
FROM (SELECT {_MONTH}, hotel, {_BOOK}, {tally('is_premium_meal')} AS premium_meal_bookings,
  {tally('is_premium_room')} AS premium_room_bookings, {_REV}, {_PREM_REV}, {_ADR} FROM stays GROUP BY ALL)"""
CTES["gold_loyalty"] = f"""
SELECT *, {_RATE}, {_PER} FROM (SELECT g_loyalty_tier, hotel, {_BOOK}, {_ADR}, {_NIGHTS}, {_REV},
  {mean('g_lifetime_spend')} AS avg_lifetime_spend, {tally('is_upsell_opportunity')} AS upsell_opportunities
  FROM stays GROUP BY ALL)"""
CTES["gold_segment"] = f"""
SELECT *, {_RATE}, {_PER} FROM (SELECT market_segment, hotel, {_BOOK}, {_ADR}, {_NIGHTS}, {_REV},
  {mean('total_of_special_requests')} AS avg_special_requests
  FROM stays WHERE market_segment <> 'Undefined' GROUP BY ALL)"""
CTES["gold_upsell"] = f"""
SELECT *, {rnd('(standard_bookings * CAST(0.3 AS DOUBLE) * avg_price_gap * avg_nights)')} AS estimated_uplift_30pct
FROM (SELECT g_loyalty_tier, hotel, meal, guest_value_segment, count(*) AS standard_bookings,
  {mean('adr')} AS avg_current_adr, {_LIST}, {total('total_revenue')} AS current_revenue, {_GAP}, {_NIGHTS}
  FROM stays WHERE NOT is_premium_booking GROUP BY ALL)"""
CTES["gold_room"] = f"""
SELECT *, {pct('upgrades_received', 'total_bookings')} AS upgrade_rate_pct, {_PER}
FROM (SELECT reserved_room_type, is_premium_room, hotel, count(*) AS total_bookings, {_ADR}, {_NIGHTS}, {_REV},
  {tally('was_upgraded')} AS upgrades_received, {_LIST} FROM stays GROUP BY ALL)"""

_SCORE = f"{mean('Flight_Satisfaction_Score')} AS avg_satisfaction"
_NOSHOW = f"{mean('No_Show', 3)} AS no_show_rate"
_DELAY = f"{mean('Delay_Minutes')} AS avg_delay"
_DELAYM = f"{mean('Delay_Minutes')} AS avg_delay_minutes"
_PRICE = f"{mean('Price_USD')} AS avg_price"
_DAYS = f"{mean('Booking_Days_In_Advance', 1)} AS avg_booking_days"
_SAT = f"{tally('is_satisfied')} AS satisfied_count"
_DIS = f"{tally('is_dissatisfied')} AS dissatisfied_count"
_NS = f"{tally('is_no_show')} AS no_shows"
_PAX = "count(*) AS passengers"


def _pct(part: str, whole: str, name: str) -> str:
    return f"{pct(part, whole)} AS {name}"


CTES["air_segment"] = f"""
SELECT *, {_pct('satisfied_count', 'passengers', 'satisfaction_rate_pct')},
  {_pct('dissatisfied_count', 'passengers', 'dissatisfaction_rate_pct')}
FROM (SELECT p_frequent_flyer_status, Seat_Class, p_income_level, Travel_Purpose, Gender, {_PAX}, {_SCORE}, {_NOSHOW},
  {_DELAY}, {_SAT}, {tally('is_highly_satisfied')} AS highly_satisfied_count, {_DIS},
  {mean('Price_USD')} AS avg_price_paid FROM flown GROUP BY ALL)"""
CTES["air_route"] = f"""
SELECT *, {_pct('satisfied_count', 'total_flights', 'satisfaction_rate_pct')},
  {_pct('cancelled_flights', 'total_flights', 'cancellation_rate_pct')}
FROM (SELECT r_route_id, Departure_Airport, Arrival_Airport, Airline, r_performance_tier, count(*) AS total_flights,
  {_SCORE}, {_DELAYM}, {_NOSHOW}, {mean('Weather_Impact', 3)} AS weather_impact_rate, {_SAT}, {_DIS}, {_PRICE},
  count(*) FILTER (WHERE Flight_Status = 'Cancelled') AS cancelled_flights FROM flown GROUP BY ALL)
WHERE total_flights >= 5"""
CTES["air_noshow"] = f"""
SELECT *, {_pct('no_shows', 'passengers', 'no_show_pct')}
FROM (SELECT booking_bucket, Travel_Purpose, p_frequent_flyer_status, {_PAX}, {_NS}, {_NOSHOW}, {_SCORE}, {_DAYS},
  {_PRICE}, {tally('is_last_minute')} AS last_minute_bookings FROM flown GROUP BY ALL)"""
CTES["air_checkin"] = f"""
SELECT *, {_pct('satisfied_count', 'passengers', 'satisfaction_rate_pct')}, {_pct('no_shows', 'passengers', 'no_show_pct')}
FROM (SELECT Check_in_Method, Seat_Class, p_frequent_flyer_status, {_PAX}, {_NOSHOW}, {_SCORE}, {_DELAY}, {_DAYS},
  {_NS}, {_SAT}, {_DIS} FROM flown GROUP BY ALL)"""
CTES["air_delay"] = f"""
SELECT *, {_pct('satisfied_count', 'flights', 'satisfaction_rate_pct')},
  {_pct('dissatisfied_count', 'flights', 'dissatisfaction_rate_pct')}
FROM (SELECT delay_bucket, Flight_Status, Weather_Impact, Airline, count(*) AS flights, {_SCORE}, {_DELAYM}, {_NOSHOW},
  {_SAT}, {_DIS}, {_PRICE} FROM flown GROUP BY ALL)"""
CTES["air_profile"] = f"""
SELECT *, {_pct('satisfied_count', 'passengers', 'satisfaction_rate_pct')},
  {_pct('no_show_count', 'passengers', 'no_show_pct')},
  {rnd('((1 - avg_satisfaction / 10) * 50 + no_show_rate * 50)')} AS friction_score
FROM (SELECT p_frequent_flyer_status, Seat_Class, Check_in_Method, Travel_Purpose, booking_bucket, time_of_day, {_PAX},
  {_SCORE}, {_NOSHOW}, {_DELAY}, {_PRICE}, {_DAYS}, {_SAT}, {tally('is_no_show')} AS no_show_count,
  {tally('is_last_minute')} AS last_minute_count, {tally('is_premium_class')} AS premium_class_count
  FROM flown GROUP BY ALL)"""

HOTEL = {
    "revenue_by_package": "gold_package", "premium_conversion": "gold_conversion",
    "revenue_by_loyalty": "gold_loyalty", "revenue_by_segment": "gold_segment",
    "upsell_opportunity": "gold_upsell", "revenue_by_room": "gold_room",
}
FLIGHT = {
    "satisfaction_by_segment": "air_segment", "satisfaction_by_route": "air_route",
    "noshow_by_booking_pattern": "air_noshow", "friction_by_checkin": "air_checkin",
    "delay_impact": "air_delay", "traveler_profile": "air_profile",
}
for _name, _cte in HOTEL.items():
    R.add(
        f"g_{_name}",
        lambda t, n=_name: kpi_hotel.by(n, kpi_hotel.TABLES[n](t.stays)),
        f"SELECT * FROM {_cte}",
    )
R.add(
    "g_headline_hotel",
    lambda t: kpi_hotel.headline(t.stays),
    f"SELECT {_BOOK}, {_REV}, {_PREM_REV} FROM stays",
)
R.add(
    "g_silver_by_meal",
    lambda t: kpi_hotel.by_meal(t.stays),
    f"SELECT meal, count(*) AS bookings, {_ADR}, {_REV} FROM stays GROUP BY meal",
)
R.add(
    "g_silver_by_tier",
    lambda t: kpi_hotel.by_tier(t.stays),
    f"SELECT g_loyalty_tier, count(*) AS bookings, {_ADR}, {_REV}, {tally('is_premium_booking')} AS premium "
    "FROM stays GROUP BY g_loyalty_tier",
)
R.add(
    "g_table_summary",
    lambda t: kpi_hotel.table_summary(
        {"bookings": t.bookings, "guests": t.guests, "packages": t.packages}
        | {n: kpi_hotel.TABLES[n](t.stays) for n in HOTEL}
    ),
    "SELECT 'bookings' AS table_name, count(*) AS rows, 30 AS cols FROM bookings "
    "UNION ALL SELECT 'guests', count(*), 14 FROM guests UNION ALL SELECT 'packages', count(*), 9 FROM packages "
    "UNION ALL SELECT 'revenue_by_package', count(*), 12 FROM gold_package "
    "UNION ALL SELECT 'premium_conversion', count(*), 13 FROM gold_conversion "
    "UNION ALL SELECT 'revenue_by_loyalty', count(*), 11 FROM gold_loyalty "
    "UNION ALL SELECT 'revenue_by_segment', count(*), 10 FROM gold_segment "
    "UNION ALL SELECT 'upsell_opportunity', count(*), 11 FROM gold_upsell "
    "UNION ALL SELECT 'revenue_by_room', count(*), 11 FROM gold_room",
)
for _name, _cte in FLIGHT.items():
    R.add(
        f"f_{_name}",
        lambda t, n=_name: kpi_flight.by(n, kpi_flight.TABLES[n](t.flown)),
        f"SELECT * FROM {_cte}",
    )
R.add(
    "f_headline",
    lambda t: kpi_flight.headline(t.flown),
    f"SELECT count(*) AS total_passengers, {mean('Flight_Satisfaction_Score')} AS overall_avg_satisfaction, "
    f"{mean('No_Show', 3)} AS overall_no_show_rate, {mean('Delay_Minutes')} AS overall_avg_delay, {_SAT}, {_DIS}, "
    f"{tally('is_no_show')} AS total_no_shows FROM flown",
)
R.add(
    "f_checkin_preview",
    lambda t: kpi_flight.checkin_preview(kpi_flight.friction_by_checkin(t.flown)),
    f"SELECT Check_in_Method, {isum('passengers')} AS total, {mean('no_show_rate', 3)} AS avg_no_show_rate, "
    f"{mean('avg_satisfaction')} AS avg_satisfaction FROM air_checkin GROUP BY Check_in_Method",
)
R.add(
    "f_delay_preview",
    lambda t: kpi_flight.delay_preview(kpi_flight.delay_impact(t.flown)),
    f"SELECT delay_bucket, {isum('flights')} AS total_flights, {mean('avg_satisfaction')} AS avg_satisfaction, "
    f"{mean('no_show_rate', 3)} AS avg_no_show_rate FROM air_delay GROUP BY delay_bucket",
)
CTES["bands"] = "SELECT satisfaction_band, count(*) AS n FROM flown GROUP BY satisfaction_band"
R.add("f_band_counts", lambda t: kpi_flight.band_counts(t.flown), "SELECT * FROM bands")
R.add(
    "f_noshow_by_bucket",
    lambda t: kpi_flight.noshow_by_bucket(t.flown),
    f"SELECT booking_bucket, {_PAX}, {_NOSHOW}, {_SCORE} FROM flown GROUP BY booking_bucket",
)
R.add(
    "f_sat_by_class",
    lambda t: kpi_flight.satisfaction_by_class(t.flown),
    f"SELECT Seat_Class, {_PAX}, {_SCORE}, {_NOSHOW} FROM flown GROUP BY Seat_Class",
)
