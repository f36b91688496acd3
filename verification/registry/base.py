"""Coercion, cleaning, predicates, derived columns, joins, profiles, sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from verification.ctes import (
    ARRIVAL_DATE, BOOKING_BUCKET, CTES, DELAY_BUCKET, LEAD_BUCKET, MONTH_NUMBER, NPS, REVENUE_BUCKET, TIME_OF_DAY,
    rnd, total,
)
from wayfare.functions import coerce, dates, labels
from wayfare.functions.numeric import round_half_up, rows
from wayfare.operators import (
    curated, flight, hotel, kpi_flight, kpi_hotel, lookups, page, profiles, quality, reports, rollups,
)
from wayfare.sources import catalogues
from wayfare.sources.spec import FLIGHTS

from .common import Registry

R = Registry()
QUERIES, SQL = R.queries, R.sql


def as_text(df):
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


# -- coercion -----------------------------------------------------------------

R.add(
    "cst_int",
    lambda t: as_text(t.bookings).select(
        F.col("src_key"), *[coerce.to_int(c).alias(c) for c in ("lead_time", "children", "adr", "country")]
    ),
    "SELECT CAST(src_key AS VARCHAR) AS src_key, CAST(lead_time AS BIGINT) AS lead_time, CAST(children AS BIGINT) AS "
    "children, CASE WHEN adr = floor(adr) THEN CAST(adr AS BIGINT) END AS adr, CAST(NULL AS BIGINT) AS country FROM bookings",
)
R.add(
    "cst_float",
    lambda t: as_text(t.bookings).select(
        "src_key", coerce.to_float("adr").alias("adr"), coerce.to_float("children").alias("children"),
        coerce.to_float("meal").alias("meal"),
    ),
    "SELECT CAST(src_key AS VARCHAR) AS src_key, adr, children, CAST(NULL AS DOUBLE) AS meal FROM bookings",
)
R.add(
    "cst_str",
    lambda t: t.bookings.select(
        "src_key",
        coerce.to_text("lead_time").alias("lead_time"),
        coerce.to_text("country").alias("country"),
        coerce.to_text(F.when(F.col("meal") == "BB", "nan").otherwise(F.col("meal"))).alias("meal"),
    ),
    "SELECT src_key, CAST(lead_time AS VARCHAR) AS lead_time, country, nullif(meal, 'BB') AS meal FROM bookings",
)
_FLIGHT_INTS = (
    "CAST(Flight_Duration_Minutes AS BIGINT) AS Flight_Duration_Minutes, CAST(Distance_Miles AS BIGINT) AS "
    "Distance_Miles, CAST(Age AS BIGINT) AS Age, CAST(Bags_Checked AS BIGINT) AS Bags_Checked, CAST(No_Show AS BIGINT) "
    "AS No_Show, CAST(Weather_Impact AS BIGINT) AS Weather_Impact"
)
CTES["flights_typed"] = f"SELECT * REPLACE ({_FLIGHT_INTS}) FROM flights"
R.add("cst_spec", lambda t: FLIGHTS.coerce(as_text(t.flights)), "SELECT * FROM flights_typed")
R.add(
    "cst_curated",
    lambda t: as_text(t.bookings).select(
        "src_key", *[c.alias(n) for n, c in curated.cast_columns(as_text(t.bookings)).items()]
    ),
    "SELECT CAST(src_key AS VARCHAR) AS src_key, lead_time, adults, babies, stays_in_weekend_nights, "
    "stays_in_week_nights, booking_changes, days_in_waiting_list, previous_cancellations, total_of_special_requests, "
    "is_canceled = 1 AS is_canceled, is_repeated_guest = 1 AS is_repeated_guest, "
    "CAST(coalesce(children, 0) AS INT) AS children, adr FROM bookings",
)
R.add("cst_feedback", lambda t: curated.feedback(as_text(t.feedback)).select(
    "feedback_id", "nps_score", "stay_date"),
    "SELECT CAST(feedback_id AS VARCHAR) AS feedback_id, nps_score, stay_date FROM feedback")

# -- cleaning -----------------------------------------------------------------

R.add(
    "cln_fillna_hotel",
    lambda t: hotel.fill_missing(
        t.bookings.withColumns({"agent": F.lit(None).cast("double"), "company": F.lit(None).cast("double")})
    ).select("src_key", "children", "country", "agent", "company"),
    "SELECT src_key, coalesce(children, 0) AS children, coalesce(country, 'Unknown') AS country, 0.0E0 AS agent, "
    "0.0E0 AS company FROM bookings",
)
R.add(
    "cln_fillna_flight",
    lambda t: t.flights.fillna(flight.MISSING).select(
        "Flight_ID", "Frequent_Flyer_Status", "Delay_Minutes", "Bags_Checked"
    ),
    "SELECT Flight_ID, coalesce(Frequent_Flyer_Status, 'Non-Member') AS Frequent_Flyer_Status, "
    "coalesce(Delay_Minutes, 0) AS Delay_Minutes, coalesce(Bags_Checked, 0) AS Bags_Checked FROM flights",
)
R.add(
    "cln_coalesce_children",
    lambda t: t.bookings.select("src_key", curated.cast_columns(t.bookings)["children"].alias("children")),
    "SELECT src_key, CAST(coalesce(children, 0) AS INT) AS children FROM bookings",
)
R.add(
    "cln_fill_ff_status",
    lambda t: t.passengers.select("Passenger_ID", "frequent_flyer_status"),
    "SELECT Passenger_ID, coalesce(max(Frequent_Flyer_Status), 'Non-Member') AS frequent_flyer_status "
    "FROM flights GROUP BY Passenger_ID",
)


def _clean(*columns):
    return lambda t: t.hotel_clean.select("src_key", *columns)


def _clean_air(*columns):
    return lambda t: t.flight_clean.select("Flight_ID", *columns)


R.add("cln_remap_meal", _clean("meal"), "SELECT src_key, replace(meal, 'Undefined', 'SC') AS meal FROM bookings")
R.add(
    "cln_clamp_adr",
    _clean("adr"),
    "SELECT src_key, CASE WHEN adr < 0 THEN 0 WHEN adr > 1000 THEN 1000 ELSE adr END AS adr FROM bookings",
)
R.add(
    "cln_clamp_delay",
    _clean_air("Delay_Minutes"),
    "SELECT Flight_ID, least(greatest(coalesce(Delay_Minutes, 0), 0), 300) AS Delay_Minutes FROM flights",
)
R.add("cln_cast_children", _clean("children"), "SELECT src_key, children FROM hotel_clean")
R.add(
    "cln_month_map",
    lambda t: t.bookings.select("src_key", dates.month_number("arrival_date_month").alias("month_num")),
    f"SELECT src_key, {MONTH_NUMBER} AS month_num FROM bookings",
)
R.add(
    "cln_month_udf",
    lambda t: t.bookings.select(
        "src_key", dates.month_number("arrival_date_month", curated.UNKNOWN_MONTH).alias("known"),
        dates.month_number("meal", curated.UNKNOWN_MONTH).alias("unknown"),
    ),
    f"SELECT src_key, coalesce({MONTH_NUMBER}, 1) AS known, 1 AS unknown FROM bookings",
)
R.add(
    "cln_month_case",
    lambda t: reports.seasonal(t.curated).select("arrival_date_month", "month_num").distinct(),
    "SELECT DISTINCT monthname(arrival_date) AS arrival_date_month, CAST(month(arrival_date) AS INT) AS month_num FROM kept",
)
R.add("cln_arrival_date", _clean("arrival_date"), f"SELECT src_key, {ARRIVAL_DATE} AS arrival_date FROM bookings")
R.add(
    "cln_arrival_date_padded",
    lambda t: as_text(t.bookings).select(
        "src_key",
        dates.date_from_parts(
            F.lpad("arrival_date_year", 4, "0"), dates.month_number("arrival_date_month", 1),
            F.lpad("arrival_date_day_of_month", 2, "0"),
        ).alias("arrival_date"),
    ),
    f"SELECT CAST(src_key AS VARCHAR) AS src_key, {ARRIVAL_DATE} AS arrival_date FROM bookings",
)
R.add("cln_status_date", _clean("reservation_status_date"), "SELECT src_key, reservation_status_date FROM bookings")
R.add(
    "cln_departure_parts",
    _clean_air("departure_ts", "departure_date", "departure_hour", "departure_month", "departure_year"),
    "SELECT Flight_ID, departure_ts, departure_date, departure_hour, departure_month, departure_year FROM flight_clean",
)
R.add("cln_drop_audit", lambda t: hotel.clean(
    t.bookings.withColumns({"_ingested_at": F.current_timestamp(), "_source_file": F.lit("x")})),
    "SELECT * FROM hotel_clean")
R.add("cln_curated_select", lambda t: t.curated, "SELECT * FROM curated")
R.add(
    "cln_dropna",
    lambda t: curated.complete(t.hotel_clean).agg(rows().alias("n")),
    "SELECT count(*) AS n FROM hotel_clean WHERE adr IS NOT NULL AND arrival_date IS NOT NULL",
)
_HASHED = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in curated.COLUMNS)
CTES["curated_keyed"] = f"""
SELECT 'BK' || md5(concat_ws(chr(31), {_HASHED})) || '-' || row_number() OVER (PARTITION BY
  {', '.join(curated.COLUMNS)}) AS booking_id, * FROM curated"""
R.add("cln_surrogate_key", lambda t: curated.with_booking_id(t.curated), "SELECT * FROM curated_keyed")
R.add("jn_curated_bookings", lambda t: curated.with_booking_id(t.curated), "SELECT * FROM curated_keyed")
R.add("jn_curated_feedback", lambda t: t.voices, "SELECT * FROM voices")

# -- predicates ---------------------------------------------------------------

_COUNT = "SELECT hotel, count(*) AS n FROM {} GROUP BY hotel"


def _per_hotel(build):
    return lambda t: build(t).groupBy("hotel").agg(rows().alias("n"))


R.add("flt_completed", _per_hotel(lambda t: hotel.completed(t.bookings)), _COUNT.format("bookings WHERE is_canceled = 0"))
R.add(
    "flt_quality",
    _per_hotel(lambda t: curated.quality(t.bookings.withColumn("total_nights", hotel.total_nights()))),
    _COUNT.format("bookings WHERE adr >= 0 AND stays_in_weekend_nights + stays_in_week_nights > 0"),
)
R.add(
    "flt_segment_defined",
    _per_hotel(lambda t: kpi_hotel.defined_segment(t.bookings)),
    _COUNT.format("bookings WHERE market_segment <> 'Undefined'"),
)
R.add(
    "flt_standard",
    _per_hotel(lambda t: kpi_hotel.standard_only(t.silver)),
    _COUNT.format("silver WHERE NOT is_premium_booking"),
)
R.add(
    "flt_having_min_flights",
    lambda t: kpi_flight.satisfaction_by_route(t.flown, min_flights=8).select("r_route_id", "total_flights"),
    "SELECT r_route_id, total_flights FROM air_route WHERE total_flights >= 8",
)
R.add(
    "flt_not_complementary",
    lambda t: rollups.segment_adr(kpi_hotel.revenue_by_segment(t.stays)).select("market_segment", "total_revenue"),
    f"SELECT market_segment, {total('total_revenue')} AS total_revenue FROM gold_segment "
    "WHERE market_segment <> 'Complementary' GROUP BY 1",
)
R.add(
    "flt_flag",
    lambda t: flight.flag_counts(t.flown),
    "SELECT count(*) AS total_rows, "
    + ", ".join(
        f"count(*) FILTER (WHERE is_{n}) AS n_{n}"
        for n in ("satisfied", "dissatisfied", "no_show", "delayed", "premium_class", "last_minute")
    )
    + " FROM flown",
)
_GUEST_KEYS = ("guest_id", "name", "email", "country", "preferred_meal", "preferred_room")
R.add(
    "flt_null_keys",
    lambda t: quality.run_checks("guests", t.guests, [quality.null_count(c) for c in _GUEST_KEYS]).select("check", "observed"),
    " UNION ALL ".join(
        f"SELECT 'null_keys:{c}' AS \"check\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) AS observed FROM guests" for c in _GUEST_KEYS
    ),
)
R.add(
    "flt_in_set",
    lambda t: quality.unexpected_values(t.bookings, "meal", labels.PREMIUM_MEALS),
    "SELECT meal AS value, count(*) AS n FROM bookings WHERE meal IS NULL OR meal NOT IN ('HB', 'FB') GROUP BY 1",
)
R.add(
    "flt_between",
    lambda t: quality.run_checks("feedback", t.feedback, [quality.in_range(c, 2, 4) for c in quality.SCORES]).select("check", "observed"),
    " UNION ALL ".join(
        f"SELECT 'range:{c}' AS \"check\", CAST(count(*) FILTER (WHERE {c} IS NULL OR {c} NOT BETWEEN 2 AND 4) AS DOUBLE) AS observed "
        "FROM feedback" for c in quality.SCORES
    ),
)
R.add(
    "flt_contains",
    lambda t: t.feedback.filter(quality.standard_package()).groupBy("package_name").agg(rows().alias("n")),
    "SELECT package_name, count(*) AS n FROM feedback WHERE package_name LIKE '%Standard%' GROUP BY 1",
)

# -- derived columns: hotel ---------------------------------------------------


def _drv(name, columns, sql=None):
    """Derived column(s) of the silver table, next to the row's own key."""
    R.add(f"drv_{name}", lambda t: t.silver.select("src_key", *columns), sql or f"SELECT src_key, {', '.join(columns)} FROM silver")


_drv("total_nights", ["total_nights"],
     "SELECT src_key, stays_in_weekend_nights + stays_in_week_nights AS total_nights FROM bookings")
_drv("day_use", ["is_day_use"],
     "SELECT src_key, stays_in_weekend_nights + stays_in_week_nights = 0 AS is_day_use FROM bookings")
_drv("total_revenue", ["total_revenue"])
_drv("premium_meal", ["is_premium_meal"], "SELECT src_key, meal IN ('HB', 'FB') AS is_premium_meal FROM bookings")
_drv("premium_room", ["is_premium_room"],
     "SELECT src_key, reserved_room_type IN ('F', 'G', 'H') AS is_premium_room FROM bookings")
_drv("premium_booking", ["is_premium_booking"])
_drv("catalogue_premium", ["is_catalogue_premium"])
_drv("price_gap", ["price_gap_per_night"])
_drv("upgraded", ["was_upgraded"],
     "SELECT src_key, reserved_room_type <> assigned_room_type AS was_upgraded FROM bookings")
_drv("upsell", ["is_upsell_opportunity"])
_drv("lead_bucket", ["lead_time_bucket"], f"SELECT src_key, {LEAD_BUCKET} AS lead_time_bucket FROM bookings")
_drv("guest_segment", ["guest_value_segment"])
_LEAD_SQL = (
    "CASE WHEN lead_time BETWEEN 0 AND 7 THEN '0–7 days' WHEN lead_time BETWEEN 8 AND 30 THEN '8–30 days' "
    "WHEN lead_time BETWEEN 31 AND 90 THEN '31–90 days' WHEN lead_time BETWEEN 91 AND 180 THEN '91–180 days' "
    "ELSE '180+ days' END"
)
R.add(
    "drv_lead_bucket_sql",
    lambda t: t.bookings.select("src_key", labels.lead_days_bucket().alias("lead_time_bucket")),
    f"SELECT src_key, {_LEAD_SQL} AS lead_time_bucket FROM bookings",
)
R.add(
    "drv_wait_bucket",
    lambda t: t.bookings.select("src_key", labels.wait_bucket().alias("wait_bucket")),
    "SELECT src_key, CASE WHEN days_in_waiting_list = 0 THEN 'No wait' WHEN days_in_waiting_list BETWEEN 1 AND 7 THEN "
    "'1–7 days wait' ELSE '8+ days wait' END AS wait_bucket FROM bookings",
)
R.add(
    "drv_revenue_bucket",
    lambda t: t.bookings.select("src_key", labels.revenue_bucket().alias("revenue_bucket")),
    f"SELECT src_key, {REVENUE_BUCKET} AS revenue_bucket FROM bookings",
)
R.add("drv_loyalty_tier", lambda t: t.guests.select("email", "loyalty_tier"), "SELECT email, loyalty_tier FROM guests")
R.add("drv_guest_id", lambda t: t.guests.select("email", "guest_id"),
      "SELECT DISTINCT email, 'G-' || upper(left(md5(email), 8)) AS guest_id FROM bookings WHERE email IS NOT NULL")
R.add("drv_joined_date", lambda t: t.guests.select("email", "joined_date"), "SELECT email, joined_date FROM guests")

# -- derived columns: flight, feedback ----------------------------------------


def _air(name, columns, sql=None):
    R.add(f"drv_{name}", lambda t: t.flown.select("Flight_ID", *columns), sql or f"SELECT Flight_ID, {', '.join(columns)} FROM flown")


_air("sat_flags", ["is_satisfied", "is_highly_satisfied", "is_dissatisfied"])
_air("sat_band", ["satisfaction_band"])
_air("is_delayed", ["is_delayed"])
_air("delay_bucket", ["delay_bucket"], f"SELECT Flight_ID, {DELAY_BUCKET} AS delay_bucket FROM flight_clean")
_air("booking_bucket", ["booking_bucket"], f"SELECT Flight_ID, {BOOKING_BUCKET} AS booking_bucket FROM flights")
_air("last_minute", ["is_last_minute"])
_air("no_show", ["is_no_show"], "SELECT Flight_ID, No_Show = 1 AS is_no_show FROM flights")
_air("premium_class", ["is_premium_class"])
_air("loyal", ["is_loyal_passenger"])
_air("time_of_day", ["time_of_day"], f"SELECT Flight_ID, {TIME_OF_DAY} AS time_of_day FROM flight_clean")
_air("price_vs_route", ["price_vs_route_avg"])
R.add("drv_sat_segment", lambda t: t.passengers.select("Passenger_ID", "satisfaction_segment"),
      "SELECT Passenger_ID, satisfaction_segment FROM passengers")
R.add("drv_route_tier", lambda t: t.routes.select("route_id", "performance_tier"),
      "SELECT route_id, performance_tier FROM routes")
R.add("drv_route_id", lambda t: t.flights.select("Flight_ID", labels.route_id().alias("route_id")),
      "SELECT Flight_ID, Departure_Airport || '-' || Arrival_Airport || '-' || replace(Airline, ' ', '_') AS route_id FROM flights")
R.add("drv_nps_category", lambda t: t.voices.select("feedback_id", "nps_category"),
      f"SELECT feedback_id, {NPS} AS nps_category FROM feedback")
R.add("drv_avg_satisfaction", lambda t: t.voices.select("feedback_id", "avg_satisfaction"),
      "SELECT feedback_id, avg_satisfaction FROM voices")
R.add(
    "drv_year_month",
    lambda t: t.hotel_clean.select("src_key", dates.year_month("arrival_date_year", F.month("arrival_date")).alias("year_month")),
    "SELECT src_key, strftime(arrival_date, '%Y-%m') AS year_month FROM hotel_clean",
)
R.add(
    "drv_order_key",
    lambda t: t.guests.select("email", labels.ordinal("loyalty_tier", labels.TIER_ORDER).alias("tier_order")),
    "SELECT email, CASE loyalty_tier WHEN 'Platinum' THEN 0 WHEN 'Gold' THEN 1 WHEN 'Silver' THEN 2 ELSE 3 END AS tier_order FROM guests",
)

R.add(
    "drv_opportunity_label",
    lambda t: page.segment_table(t.curated).select("market_segment", "opportunity"),
    "SELECT market_segment, CASE WHEN premium_pct >= 22 THEN 'High' WHEN premium_pct >= 15 THEN 'Medium' "
    "WHEN premium_pct >= 10 THEN 'Low' ELSE 'None' END AS opportunity FROM funnel",
)
# -- joins --------------------------------------------------------------------

R.add("jn_lookup_guests", lambda t: lookups.guest_lookup(t.guests),
      "SELECT email, guest_id, loyalty_tier AS g_loyalty_tier, lifetime_spend AS g_lifetime_spend, total_stays AS "
      "g_total_stays, total_cancellations AS g_total_cancellations, preferred_meal AS g_preferred_meal, preferred_room "
      "AS g_preferred_room, total_special_requests AS g_total_special_requests, joined_date AS g_joined_date FROM guests")
_LIST = (
    "p.package_id AS p_package_id, p.package_name AS p_package_name, p.base_price AS p_base_price, p.includes_spa AS "
    "p_includes_spa, p.includes_transfer AS p_includes_transfer, p.is_premium AS p_is_premium"
)
R.add(
    "jn_lookup_packages",
    lambda t: lookups.package_lookup(t.packages).join(
        t.bookings.groupBy(F.col("meal").alias("meal_type"), F.col("reserved_room_type").alias("room_type"),
                           F.col("hotel").alias("hotel_type")).agg(rows().alias("bookings")),
        ["meal_type", "room_type", "hotel_type"], "left"),
    f"SELECT p.meal_type, p.room_type, p.hotel_type, {_LIST}, b.bookings FROM packages p LEFT JOIN (SELECT meal, "
    "reserved_room_type, hotel, count(*) AS bookings FROM bookings GROUP BY 1, 2, 3) b ON p.meal_type = b.meal AND "
    "p.room_type = b.reserved_room_type AND p.hotel_type = b.hotel",
)
R.add("jn_lookup_passengers", lambda t: lookups.passenger_lookup(t.passengers),
      "SELECT Passenger_ID, frequent_flyer_status AS p_frequent_flyer_status, satisfaction_segment AS "
      "p_satisfaction_segment, avg_satisfaction AS p_avg_satisfaction, total_flights AS p_total_flights, no_show_rate AS "
      "p_no_show_rate, preferred_class AS p_preferred_class, preferred_checkin AS p_preferred_checkin, "
      "primary_travel_purpose AS p_primary_travel_purpose, income_level AS p_income_level, total_delay_minutes AS "
      "p_total_delay_minutes FROM passengers")
R.add("jn_lookup_routes", lambda t: lookups.route_lookup(t.routes),
      "SELECT Departure_Airport, Arrival_Airport, Airline, route_id AS r_route_id, avg_satisfaction AS "
      "r_avg_satisfaction, avg_delay_minutes AS r_avg_delay_minutes, no_show_rate AS r_no_show_rate, pct_on_time AS "
      "r_pct_on_time, pct_cancelled AS r_pct_cancelled, weather_impact_rate AS r_weather_impact_rate, performance_tier "
      "AS r_performance_tier, avg_price_usd AS r_avg_price_usd FROM routes")
R.add("jn_guests", lambda t: hotel.with_guests(t.stored_bookings, profiles.guests(t.stored_bookings), whole=True),
      "SELECT * FROM guest_join")
R.add("jn_packages", lambda t: lookups.attach_packages(t.hotel_clean, t.packages), "SELECT * FROM package_join")
R.add("jn_passengers", lambda t: lookups.attach_passengers(t.flight_clean, t.passengers), "SELECT * FROM pax_join")
R.add("jn_routes", lambda t: lookups.attach_routes(t.flight_clean, t.routes), "SELECT * FROM route_join")
R.add(
    "jn_match_rate",
    lambda t: lookups.match_rate(
        lookups.attach_passengers(t.flight_clean, t.passengers), "p_frequent_flyer_status", "passengers"
    ).unionByName(lookups.match_rate(lookups.attach_routes(t.flight_clean, t.routes), "r_route_id", "routes"))
    .unionByName(lookups.match_rate(lookups.attach_packages(t.hotel_clean, t.packages), "p_package_id", "packages")),
    "SELECT *, 100.0E0 * matched / total_rows AS matched_pct FROM (SELECT 'passengers' AS lookup, count(*) AS total_rows, "
    "count(p_frequent_flyer_status) AS matched FROM pax_join UNION ALL SELECT 'routes', count(*), count(r_route_id) "
    "FROM route_join UNION ALL SELECT 'packages', count(*), count(p_package_id) FROM package_join)",
)
R.add("jn_silver_bookings", lambda t: hotel.silver(t.stored_bookings, profiles.guests(t.stored_bookings), t.packages, whole=True),
      "SELECT * FROM silver")
R.add("jn_silver_flights", lambda t: t.flown, "SELECT * FROM flown")

# -- profiles -----------------------------------------------------------------

R.add("p_guests", lambda t: t.guests, "SELECT * FROM guests")
R.add("p_passengers", lambda t: t.passengers, "SELECT * FROM passengers")
R.add("p_routes", lambda t: t.routes, "SELECT * FROM routes")


def _booked_packages(t):
    """Catalogue rows with the number of bookings each one matches."""
    p = t.packages
    booked = t.hotel_clean.groupBy("meal", "reserved_room_type", "hotel").agg(rows().alias("bookings"))
    same = (
        (p["meal_type"] == booked["meal"]) & (p["room_type"] == booked["reserved_room_type"])
        & (p["hotel_type"] == booked["hotel"])
    )
    return p.join(booked, same, "left").select(p["*"], F.coalesce("bookings", F.lit(0)).alias("bookings"))


CTES["booked_packages"] = """
SELECT p.*, coalesce(b.bookings, 0) AS bookings FROM packages p LEFT JOIN (SELECT meal, reserved_room_type, hotel,
  count(*) AS bookings FROM hotel_clean GROUP BY 1, 2, 3) b
ON p.meal_type = b.meal AND p.room_type = b.reserved_room_type AND p.hotel_type = b.hotel"""
R.add("src_static_packages", _booked_packages, "SELECT * FROM booked_packages")
R.add(
    "src_static_catalog",
    lambda t: catalogues.margin_catalogue(t.spark).join(
        t.feedback.groupBy("package_name").agg(rows().alias("responses")), "package_name", "left"
    ).select("*"),
    "SELECT m.package_name, m.* EXCLUDE (package_name), f.responses FROM margins m LEFT JOIN (SELECT package_name, "
    "count(*) AS responses FROM feedback GROUP BY 1) f ON m.package_name = f.package_name",
)
R.add(
    "p_packages_summary",
    lambda t: profiles.packages_summary(_booked_packages(t)),
    "SELECT count(*) FILTER (WHERE is_premium = 1) AS premium_packages, count(*) FILTER (WHERE is_premium = 0) AS "
    "standard_packages, CAST(sum(bookings) FILTER (WHERE is_premium = 1) AS BIGINT) AS premium_package_bookings, "
    "CAST(sum(bookings) FILTER (WHERE is_premium = 0) AS BIGINT) AS standard_package_bookings FROM booked_packages",
)
for _name, _table, _column in (
    ("tier", "guests", "loyalty_tier"), ("segment", "passengers", "satisfaction_segment"),
    ("status", "passengers", "frequent_flyer_status"), ("performance", "routes", "performance_tier"),
):
    R.add(
        f"p_value_counts_{_name}",
        lambda t, table=_table, c=_column: profiles.distribution(getattr(t, table), c),
        f"SELECT {_column}, count(*) AS n FROM {_table} WHERE {_column} IS NOT NULL GROUP BY 1",
    )
R.add(
    "p_table_counts",
    lambda t: kpi_hotel.table_summary({n: getattr(t, n) for n in ("guests", "packages", "passengers", "routes")})
    .select("table_name", "rows"),
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in ("guests", "packages", "passengers", "routes")
    ),
)
_GUEST = ("guest_id", "name", "country", "loyalty_tier", "total_stays", "lifetime_spend", "preferred_meal", "preferred_room")
_PAX = (
    "Passenger_ID", "age", "gender", "frequent_flyer_status", "satisfaction_segment", "avg_satisfaction",
    "total_flights", "preferred_class", "no_show_rate",
)


def _example_sql(table, columns, group, metric, key):
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {metric} DESC, "
        f"{key}) AS rn FROM {table} WHERE {metric} IS NOT NULL) WHERE rn = 1 ORDER BY {metric} DESC, {key} LIMIT 4"
    )


R.add(
    "p_sample_per_group",
    lambda t: profiles.example_per_group(t.guests, "loyalty_tier", "lifetime_spend", "guest_id", _GUEST),
    _example_sql("guests", _GUEST, "loyalty_tier", "lifetime_spend", "guest_id"),
)
R.add(
    "p_sample_per_group_flight",
    lambda t: profiles.example_per_group(t.passengers, "satisfaction_segment", "avg_satisfaction", "Passenger_ID", _PAX),
    _example_sql("passengers", _PAX, "satisfaction_segment", "avg_satisfaction", "Passenger_ID"),
)

# -- sort and limit -----------------------------------------------------------

R.add(
    "s_order_by",
    lambda t: kpi_hotel.by("revenue_by_room", kpi_hotel.revenue_by_room(t.stays)).select("reserved_room_type", "hotel", "avg_adr"),
    "SELECT reserved_room_type, hotel, avg_adr FROM gold_room ORDER BY avg_adr DESC",
)
R.add(
    "s_custom_order",
    lambda t: t.bookings.groupBy("hotel", labels.lead_days_bucket().alias("lead_time_bucket")).agg(rows().alias("n"))
    .orderBy("hotel", labels.ordinal("lead_time_bucket", labels.label_order(labels.LEAD_DAYS))),
    f"SELECT hotel, {_LEAD_SQL} AS lead_time_bucket, count(*) AS n FROM bookings GROUP BY 1, 2",
)
_SHOWN = ("src_key", "hotel", "meal", "reserved_room_type", "adr", "is_canceled", "email")
R.add(
    "s_limit_preview",
    lambda t: profiles.preview(t.hotel_clean, _SHOWN, 3, "src_key", "adr", "meal", "reserved_room_type", "email", "hotel", "is_canceled"),
    "SELECT src_key, hotel, meal, reserved_room_type, adr, is_canceled, email FROM hotel_clean ORDER BY src_key, adr, "
    "meal, reserved_room_type, email NULLS FIRST, hotel, is_canceled LIMIT 3",
)
_RATED = ("route_id", "avg_satisfaction", "avg_delay_minutes", "no_show_rate", "pct_on_time", "performance_tier")
R.add(
    "s_topk",
    lambda t: profiles.preview(t.routes, _RATED, 5, F.desc("avg_satisfaction"), "route_id"),
    "SELECT route_id, avg_satisfaction, avg_delay_minutes, no_show_rate, pct_on_time, performance_tier FROM routes "
    "ORDER BY avg_satisfaction DESC, route_id LIMIT 5",
)
R.add(
    "s_sorted_catalogue",
    lambda t: profiles.by_price(_booked_packages(t)),
    "SELECT * FROM booked_packages ORDER BY hotel_type, base_price",
)
