"""SQL twins of the base tables, as named CTEs that are chained on demand."""

from __future__ import annotations

import re

from wayfare.sources import catalogues
from wayfare.sources.fixtures import VIEWS


def rnd(x: str, n: int = 2) -> str:
    # half away from zero of the number as it is written, as Spark rounds
    return f"(CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE) + 0.0E0)"


def total(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(24,6))) AS DOUBLE)"


def avg(x: str) -> str:
    return f"({total(x)}/nullif(count({x}),0))"


def mean(x: str, n: int = 2) -> str:
    return rnd(avg(x), n)


def tally(flag: str) -> str:
    return f"CAST(sum(CAST({flag} AS INT)) AS BIGINT)"


def isum(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def pct(part: str, whole: str, n: int = 2) -> str:
    return rnd(f"(CAST({part} AS DOUBLE)/nullif({whole},0)*100)", n)


def share(part: str, whole: str, n: int = 1) -> str:
    return rnd(f"(100.0E0*{part}/nullif({whole},0))", n)


def pct_where(cond: str, n: int = 1) -> str:
    return share(f"count(*) FILTER (WHERE {cond})", "count(*)", n)


def share_where(cond: str, n: int = 4) -> str:
    return rnd(f"(CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE)/count(*))", n)


def values(rows: tuple, schema: str) -> str:
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{v}E0" if isinstance(v, float) else str(v)

    fields = [f.split() for f in schema.split(", ")]
    kinds = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INT"}
    body = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)
    cols = ", ".join(f"CAST({n} AS {kinds[t]}) AS {n}" for n, t in fields)
    return f"SELECT {cols} FROM (VALUES {body}) t({', '.join(n for n, _ in fields)})"


MONTH_NUMBER = (
    "CASE arrival_date_month WHEN 'January' THEN 1 WHEN 'February' THEN 2 WHEN 'March' THEN 3 WHEN 'April' THEN 4 "
    "WHEN 'May' THEN 5 WHEN 'June' THEN 6 WHEN 'July' THEN 7 WHEN 'August' THEN 8 WHEN 'September' THEN 9 "
    "WHEN 'October' THEN 10 WHEN 'November' THEN 11 WHEN 'December' THEN 12 END"
)
ARRIVAL_DATE = (
    f"TRY_CAST(arrival_date_year || '-' || lpad(CAST({MONTH_NUMBER} AS VARCHAR), 2, '0') || '-' || "
    "lpad(CAST(arrival_date_day_of_month AS VARCHAR), 2, '0') AS DATE)"
)
LEAD_BUCKET = (
    "CASE WHEN lead_time < 7 THEN '< 1 week' WHEN lead_time < 30 THEN '1-4 weeks' WHEN lead_time < 90 THEN "
    "'1-3 months' WHEN lead_time < 180 THEN '3-6 months' ELSE '6+ months' END"
)
GUEST_VALUE = (
    "CASE g_loyalty_tier WHEN 'Platinum' THEN 'High Value' WHEN 'Gold' THEN 'Mid-High Value' "
    "WHEN 'Silver' THEN 'Mid Value' ELSE 'Standard' END"
)
LOYALTY = (
    "CASE WHEN lifetime_spend >= 1500 OR total_stays >= 4 THEN 'Platinum' WHEN lifetime_spend >= 700 OR "
    "total_stays >= 3 THEN 'Gold' WHEN lifetime_spend >= 300 OR total_stays >= 2 OR total_special_requests >= 3 "
    "THEN 'Silver' ELSE 'Bronze' END"
)
SAT_BAND = (
    "CASE WHEN Flight_Satisfaction_Score >= 8 THEN 'Highly Satisfied' WHEN Flight_Satisfaction_Score >= 7 THEN "
    "'Satisfied' WHEN Flight_Satisfaction_Score >= 5 THEN 'Neutral' ELSE 'Dissatisfied' END"
)
DELAY_BUCKET = (
    "CASE WHEN Delay_Minutes = 0 THEN 'No Delay' WHEN Delay_Minutes <= 15 THEN '< 15 min' WHEN Delay_Minutes <= 30 "
    "THEN '15-30 min' WHEN Delay_Minutes <= 60 THEN '30-60 min' ELSE '> 60 min' END"
)
BOOKING_BUCKET = (
    "CASE WHEN Booking_Days_In_Advance <= 7 THEN '< 1 week' WHEN Booking_Days_In_Advance <= 30 THEN '1-4 weeks' "
    "WHEN Booking_Days_In_Advance <= 60 THEN '1-2 months' WHEN Booking_Days_In_Advance <= 90 THEN '2-3 months' "
    "ELSE '3+ months' END"
)
TIME_OF_DAY = (
    "CASE WHEN departure_hour < 6 THEN 'Night (0-6)' WHEN departure_hour < 12 THEN 'Morning (6-12)' "
    "WHEN departure_hour < 18 THEN 'Afternoon (12-18)' ELSE 'Evening (18-24)' END"
)
SAT_SEGMENT = (
    "CASE WHEN avg_satisfaction >= 8 THEN 'Highly Satisfied' WHEN avg_satisfaction >= 6.5 THEN 'Satisfied' "
    "WHEN avg_satisfaction >= 5 THEN 'Neutral' ELSE 'Dissatisfied' END"
)
ROUTE_TIER = (
    "CASE WHEN avg_satisfaction >= 7.2E0 AND pct_on_time >= 0.85E0 THEN 'High Performing' WHEN avg_satisfaction >= "
    "6.5E0 AND pct_on_time >= 0.75E0 THEN 'Average' ELSE 'Needs Improvement' END"
)
NPS = "CASE WHEN nps_score >= 9 THEN 'Promoter' WHEN nps_score >= 7 THEN 'Passive' ELSE 'Detractor' END"
REVENUE_BUCKET = "CASE WHEN adr < 80 THEN 'Low' WHEN adr < 150 THEN 'Mid' ELSE 'Premium' END"


def mode_cte(source: str, key: str, value: str) -> str:
    return (
        f"SELECT {key}, {value} AS top FROM (SELECT {key}, {value}, row_number() OVER (PARTITION BY {key} ORDER BY "
        f"count(*) DESC, {value}) AS rn FROM {source} WHERE {value} IS NOT NULL AND {key} IS NOT NULL "
        f"GROUP BY {key}, {value}) WHERE rn = 1"
    )


def first_cte(source: str, key: str, value: str, order: str) -> str:
    return (
        f"SELECT {key}, {value} AS first_value FROM (SELECT {key}, {value}, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {order}, {value}) AS rn FROM {source} WHERE {value} IS NOT NULL AND {key} IS NOT NULL) WHERE rn = 1"
    )


CTES: dict[str, str] = dict(VIEWS)
CTES["packages"] = values(catalogues.PACKAGES, catalogues.PACKAGES_SCHEMA)
CTES["margins"] = values(catalogues.MARGINS, catalogues.MARGINS_SCHEMA)

CTES["guest_name"] = first_cte("bookings", "email", "name", "reservation_status_date")
CTES["guest_country"] = first_cte("bookings", "email", "country", "reservation_status_date")
CTES["guest_meal"] = mode_cte("bookings", "email", "meal")
CTES["guest_room"] = mode_cte("bookings", "email", "reserved_room_type")
CTES["guest_sums"] = f"""
SELECT email, count(*) FILTER (WHERE is_canceled = 0) AS total_stays,
  {isum('is_canceled')} AS total_cancellations,
  {total('adr * (stays_in_weekend_nights + stays_in_week_nights)')} AS lifetime_spend,
  {mean('adr')} AS avg_adr, {isum('total_of_special_requests')} AS total_special_requests,
  min(reservation_status_date) AS first_booking
FROM bookings WHERE email IS NOT NULL GROUP BY email"""
CTES["guests"] = f"""
SELECT 'G-' || upper(substr(md5(s.email), 1, 8)) AS guest_id, n.first_value AS name, s.email,
  CAST(NULL AS VARCHAR) AS phone, c.first_value AS country, {LOYALTY} AS loyalty_tier,
  total_stays, total_cancellations, lifetime_spend, avg_adr, m.top AS preferred_meal, r.top AS preferred_room,
  total_special_requests,
  CAST(first_booking - CAST(30 + CAST('0x' || substr(md5(s.email), 1, 4) AS INT) % 336 AS INT) AS VARCHAR) AS joined_date
FROM guest_sums s LEFT JOIN guest_name n ON s.email = n.email LEFT JOIN guest_country c ON s.email = c.email
LEFT JOIN guest_meal m ON s.email = m.email LEFT JOIN guest_room r ON s.email = r.email"""

CTES["hotel_clean"] = f"""
SELECT src_key, hotel, is_canceled, lead_time, arrival_date_year, arrival_date_month, arrival_date_day_of_month,
  stays_in_weekend_nights, stays_in_week_nights, adults, CAST(coalesce(children, 0) AS INT) AS children, babies,
  CASE WHEN meal = 'Undefined' THEN 'SC' ELSE meal END AS meal, coalesce(country, 'Unknown') AS country,
  market_segment, distribution_channel, is_repeated_guest, previous_cancellations, booking_changes,
  reserved_room_type, assigned_room_type, deposit_type, days_in_waiting_list, customer_type,
  CASE WHEN adr < 0 THEN 0.0E0 WHEN adr > 1000 THEN 1000.0E0 ELSE adr END AS adr,
  total_of_special_requests, reservation_status, reservation_status_date, name, email,
  {ARRIVAL_DATE} AS arrival_date,
  stays_in_weekend_nights + stays_in_week_nights AS total_nights,
  coalesce(stays_in_weekend_nights + stays_in_week_nights = 0, false) AS is_day_use
FROM bookings"""
CTES["guest_join"] = """
SELECT b.*, g.guest_id, g.loyalty_tier AS g_loyalty_tier, g.lifetime_spend AS g_lifetime_spend,
  g.total_stays AS g_total_stays, g.total_cancellations AS g_total_cancellations,
  g.preferred_meal AS g_preferred_meal, g.preferred_room AS g_preferred_room,
  g.total_special_requests AS g_total_special_requests, g.joined_date AS g_joined_date
FROM hotel_clean b LEFT JOIN guests g ON b.email = g.email"""
CTES["package_join"] = """
SELECT b.*, p.package_id AS p_package_id, p.package_name AS p_package_name, p.base_price AS p_base_price,
  p.includes_spa AS p_includes_spa, p.includes_transfer AS p_includes_transfer, p.is_premium AS p_is_premium
FROM hotel_clean b LEFT JOIN packages p
  ON b.meal = p.meal_type AND b.reserved_room_type = p.room_type AND b.hotel = p.hotel_type"""
CTES["silver"] = f"""
SELECT * EXCLUDE (name), {rnd('(adr * total_nights)')} AS total_revenue,
  meal IN ('HB', 'FB') AS is_premium_meal, reserved_room_type IN ('F', 'G', 'H') AS is_premium_room,
  (meal IN ('HB', 'FB') OR reserved_room_type IN ('F', 'G', 'H')) AS is_premium_booking,
  CASE p_is_premium WHEN 1 THEN true WHEN 0 THEN false END AS is_catalogue_premium,
  {rnd('(p_base_price - adr)')} AS price_gap_per_night,
  reserved_room_type <> assigned_room_type AS was_upgraded, {LEAD_BUCKET} AS lead_time_bucket,
  (NOT (meal IN ('HB', 'FB') OR reserved_room_type IN ('F', 'G', 'H')) AND g_loyalty_tier IN ('Gold', 'Platinum'))
    AS is_upsell_opportunity,
  {GUEST_VALUE} AS guest_value_segment
FROM (SELECT j.*, p.package_id AS p_package_id, p.package_name AS p_package_name, p.base_price AS p_base_price,
  p.includes_spa AS p_includes_spa, p.includes_transfer AS p_includes_transfer, p.is_premium AS p_is_premium
  FROM guest_join j LEFT JOIN packages p
  ON j.meal = p.meal_type AND j.reserved_room_type = p.room_type AND j.hotel = p.hotel_type)"""
CTES["stays"] = "SELECT * FROM silver WHERE is_canceled = 0"

_ORDER = "Departure_Time, Flight_ID"
for _name, _col in (("age", "Age"), ("gender", "Gender"), ("income", "Income_Level"), ("status", "Frequent_Flyer_Status")):
    CTES[f"pax_{_name}"] = first_cte("flights", "Passenger_ID", _col, _ORDER)
for _name, _col in (("class", "Seat_Class"), ("checkin", "Check_in_Method"), ("purpose", "Travel_Purpose"), ("airline", "Airline")):
    CTES[f"pax_{_name}"] = mode_cte("flights", "Passenger_ID", _col)
CTES["pax_sums"] = f"""
SELECT Passenger_ID, count(Flight_ID) AS total_flights, {isum('No_Show')} AS total_no_shows,
  {mean('Flight_Satisfaction_Score')} AS avg_satisfaction, {mean('Price_USD')} AS avg_price_paid,
  {rnd(total('Delay_Minutes'), 1)} AS total_delay_minutes
FROM flights WHERE Passenger_ID IS NOT NULL GROUP BY Passenger_ID"""
CTES["passengers"] = f"""
SELECT s.Passenger_ID, a.first_value AS age, g.first_value AS gender, i.first_value AS income_level,
  coalesce(f.first_value, 'Non-Member') AS frequent_flyer_status, {SAT_SEGMENT} AS satisfaction_segment,
  total_flights, total_no_shows, {rnd('(CAST(total_no_shows AS DOUBLE)/total_flights)', 3)} AS no_show_rate,
  avg_satisfaction, avg_price_paid, total_delay_minutes, c.top AS preferred_class, k.top AS preferred_checkin,
  p.top AS primary_travel_purpose, l.top AS preferred_airline
FROM pax_sums s LEFT JOIN pax_age a ON s.Passenger_ID = a.Passenger_ID
LEFT JOIN pax_gender g ON s.Passenger_ID = g.Passenger_ID LEFT JOIN pax_income i ON s.Passenger_ID = i.Passenger_ID
LEFT JOIN pax_status f ON s.Passenger_ID = f.Passenger_ID LEFT JOIN pax_class c ON s.Passenger_ID = c.Passenger_ID
LEFT JOIN pax_checkin k ON s.Passenger_ID = k.Passenger_ID LEFT JOIN pax_purpose p ON s.Passenger_ID = p.Passenger_ID
LEFT JOIN pax_airline l ON s.Passenger_ID = l.Passenger_ID"""


def _share3(status: str) -> str:
    return rnd(f"(CAST(count(*) FILTER (WHERE Flight_Status = '{status}') AS DOUBLE)/count(*))", 3)


CTES["route_sums"] = f"""
SELECT Departure_Airport, Arrival_Airport, Airline, count(Flight_ID) AS total_flights,
  {mean('Flight_Satisfaction_Score', 3)} AS avg_satisfaction, {mean('Delay_Minutes', 3)} AS avg_delay_minutes,
  {mean('No_Show', 3)} AS no_show_rate, {_share3('Cancelled')} AS pct_cancelled, {_share3('Delayed')} AS pct_delayed,
  {_share3('On-time')} AS pct_on_time, {mean('Price_USD', 3)} AS avg_price_usd,
  {mean('Flight_Duration_Minutes', 3)} AS avg_duration_minutes, {mean('Distance_Miles', 3)} AS avg_distance_miles,
  {mean('Weather_Impact', 3)} AS weather_impact_rate
FROM flights WHERE Departure_Airport IS NOT NULL AND Arrival_Airport IS NOT NULL AND Airline IS NOT NULL
GROUP BY Departure_Airport, Arrival_Airport, Airline"""
CTES["routes"] = f"""
SELECT Departure_Airport || '-' || Arrival_Airport || '-' || replace(Airline, ' ', '_') AS route_id, *,
  {ROUTE_TIER} AS performance_tier FROM route_sums"""
CTES["flight_clean"] = """
SELECT * EXCLUDE (Departure_Time, Frequent_Flyer_Status, Bags_Checked, Delay_Minutes),
  coalesce(Frequent_Flyer_Status, 'Non-Member') AS Frequent_Flyer_Status, coalesce(Bags_Checked, 0) AS Bags_Checked,
  CASE WHEN coalesce(Delay_Minutes, 0) < 0 THEN 0.0E0 WHEN coalesce(Delay_Minutes, 0) > 300 THEN 300.0E0
    ELSE coalesce(Delay_Minutes, 0.0E0) END AS Delay_Minutes,
  CAST(Departure_Time AS TIMESTAMP) AS departure_ts, CAST(CAST(Departure_Time AS TIMESTAMP) AS DATE) AS departure_date,
  CAST(hour(CAST(Departure_Time AS TIMESTAMP)) AS INT) AS departure_hour,
  CAST(month(CAST(Departure_Time AS TIMESTAMP)) AS INT) AS departure_month,
  CAST(year(CAST(Departure_Time AS TIMESTAMP)) AS INT) AS departure_year
FROM flights"""
CTES["pax_join"] = """
SELECT b.*, p.frequent_flyer_status AS p_frequent_flyer_status, p.satisfaction_segment AS p_satisfaction_segment,
  p.avg_satisfaction AS p_avg_satisfaction, p.total_flights AS p_total_flights, p.no_show_rate AS p_no_show_rate,
  p.preferred_class AS p_preferred_class, p.preferred_checkin AS p_preferred_checkin,
  p.primary_travel_purpose AS p_primary_travel_purpose, p.income_level AS p_income_level,
  p.total_delay_minutes AS p_total_delay_minutes
FROM flight_clean b LEFT JOIN passengers p ON b.Passenger_ID = p.Passenger_ID"""
_R = """, r.route_id AS r_route_id, r.avg_satisfaction AS r_avg_satisfaction, r.avg_delay_minutes AS r_avg_delay_minutes,
  r.no_show_rate AS r_no_show_rate, r.pct_on_time AS r_pct_on_time, r.pct_cancelled AS r_pct_cancelled,
  r.weather_impact_rate AS r_weather_impact_rate, r.performance_tier AS r_performance_tier,
  r.avg_price_usd AS r_avg_price_usd"""
_ON = "ON b.Departure_Airport = r.Departure_Airport AND b.Arrival_Airport = r.Arrival_Airport AND b.Airline = r.Airline"
CTES["route_join"] = f"SELECT b.*{_R} FROM flight_clean b LEFT JOIN routes r {_ON}"
CTES["flown"] = f"""
SELECT *, Flight_Satisfaction_Score >= 7 AS is_satisfied, Flight_Satisfaction_Score >= 8 AS is_highly_satisfied,
  Flight_Satisfaction_Score < 5 AS is_dissatisfied, {SAT_BAND} AS satisfaction_band,
  Delay_Minutes > 0 AS is_delayed, {DELAY_BUCKET} AS delay_bucket, {BOOKING_BUCKET} AS booking_bucket,
  Booking_Days_In_Advance <= 7 AS is_last_minute, No_Show = 1 AS is_no_show,
  Seat_Class IN ('Business', 'First') AS is_premium_class, {TIME_OF_DAY} AS time_of_day,
  p_frequent_flyer_status IN ('Gold', 'Platinum') AS is_loyal_passenger,
  {rnd('(Price_USD - r_avg_price_usd)')} AS price_vs_route_avg
FROM (SELECT b.*{_R} FROM pax_join b LEFT JOIN routes r {_ON})"""

CTES["curated"] = f"""
SELECT hotel, is_canceled = 1 AS is_canceled, lead_time, {ARRIVAL_DATE} AS arrival_date,
  stays_in_weekend_nights + stays_in_week_nights AS total_nights, adults, CAST(coalesce(children, 0) AS INT) AS children,
  babies, meal AS meal_plan, country, market_segment, distribution_channel, is_repeated_guest = 1 AS is_repeated_guest,
  previous_cancellations, reserved_room_type, assigned_room_type,
  reserved_room_type <> assigned_room_type AS room_upgrade, booking_changes, deposit_type, days_in_waiting_list,
  customer_type, adr, total_of_special_requests AS special_requests, reservation_status, reservation_status_date,
  meal IN ('HB', 'FB') AS is_premium_meal, {REVENUE_BUCKET} AS revenue_bucket
FROM bookings
WHERE adr >= 0 AND {ARRIVAL_DATE} IS NOT NULL AND stays_in_weekend_nights + stays_in_week_nights > 0"""
CTES["kept"] = "SELECT * FROM curated WHERE NOT is_canceled"
CTES["voices"] = f"""
SELECT feedback_id, guest_key, hotel_type, package_name, stay_date, nps_score, would_return, booking_channel,
  {NPS} AS nps_category,
  {rnd('(CAST(checkin_satisfaction + room_satisfaction + food_satisfaction + value_for_money AS DOUBLE)/4)')}
    AS avg_satisfaction
FROM feedback"""


def with_ctes(body: str) -> str:
    """``body`` preceded by every CTE it needs, in dependency order."""
    body = body.strip()
    wanted: set[str] = set()

    def walk(text: str) -> None:
        for name in set(re.findall(r"(?:FROM|JOIN|from|join)\s+(\w+)", text)) & CTES.keys():
            if name not in wanted:
                wanted.add(name)
                walk(CTES[name])

    walk(body)
    chain = [f"{name} AS ({CTES[name].strip()})" for name in CTES if name in wanted]
    if not chain:
        return body
    return "WITH " + ",\n".join(chain) + "\n" + body
