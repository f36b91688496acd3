"""Dashboard roll-ups (d_*) and report page data (h_*)."""

from __future__ import annotations

from verification.ctes import avg, isum, mean, pct, pct_where, rnd, share, total
from wayfare.operators import kpi_flight, kpi_hotel, page, rollups

from .common import Registry

R = Registry()
QUERIES, SQL = R.queries, R.sql

_YM = "arrival_date_year || '-' || lpad(CAST(arrival_month_num AS VARCHAR), 2, '0') AS year_month"
_TIER = "CASE g_loyalty_tier WHEN 'Platinum' THEN 0 WHEN 'Gold' THEN 1 WHEN 'Silver' THEN 2 WHEN 'Bronze' THEN 3 END"
_REV = f"{total('total_revenue')} AS total_revenue"


def _gold(name):
    return lambda t: kpi_hotel.TABLES[name](t.stays)


def _air(name):
    return lambda t: kpi_flight.TABLES[name](t.flown)


R.add(
    "d_monthly_meal_revenue",
    lambda t: rollups.monthly_meal_revenue(_gold("revenue_by_package")(t)),
    f"SELECT {_YM}, meal, {_REV} FROM gold_package GROUP BY ALL",
)
_CONV = (
    f"{isum('total_bookings')} AS total_bookings, {isum('premium_bookings')} AS premium_bookings, {_REV}, "
    f"{total('premium_revenue')} AS premium_revenue"
)
R.add(
    "d_monthly_conversion",
    lambda t: rollups.monthly_conversion(_gold("premium_conversion")(t)),
    f"SELECT *, {pct('premium_bookings', 'total_bookings', 1)} AS premium_conversion_pct, "
    f"{pct('premium_revenue', 'total_revenue', 1)} AS premium_revenue_pct "
    f"FROM (SELECT {_YM}, {_CONV} FROM gold_conversion GROUP BY ALL)",
)


def _loyalty_sql(adr: str) -> str:
    return (
        f"SELECT *, {pct('premium_bookings', 'total_bookings', 1)} AS premium_rate_pct, {_TIER} AS tier_order "
        f"FROM (SELECT g_loyalty_tier, {isum('total_bookings')} AS total_bookings, {isum('premium_bookings')} AS "
        f"premium_bookings, {_REV}, {adr} AS avg_adr FROM gold_loyalty WHERE g_loyalty_tier IS NOT NULL GROUP BY 1)"
    )


R.add("d_loyalty", lambda t: rollups.loyalty(_gold("revenue_by_loyalty")(t)), _loyalty_sql(avg("avg_adr")))
R.add(
    "d_loyalty_weighted",
    lambda t: rollups.loyalty(_gold("revenue_by_loyalty")(t), weighted=True),
    _loyalty_sql(f"{total('avg_adr * total_bookings')}/sum(total_bookings)"),
)
R.add(
    "d_segment_adr",
    lambda t: rollups.segment_adr(_gold("revenue_by_segment")(t)),
    f"SELECT s.*, {rnd('m.m')} AS overall_avg_adr FROM (SELECT market_segment, {avg('avg_adr')} AS avg_adr, {_REV} "
        f"FROM gold_segment WHERE market_segment <> 'Complementary' GROUP BY 1) s, (SELECT {avg('avg_adr')} AS m "
        f"FROM (SELECT {avg('avg_adr')} AS avg_adr FROM gold_segment WHERE market_segment <> 'Complementary' "
        "GROUP BY market_segment)) m",
)
R.add(
    "d_room",
    lambda t: rollups.room(_gold("revenue_by_room")(t)),
    f"SELECT reserved_room_type, is_premium_room, {avg('avg_adr')} AS avg_adr, {_REV} FROM gold_room GROUP BY 1, 2",
)
R.add(
    "d_upsell",
    lambda t: rollups.upsell(_gold("upsell_opportunity")(t)),
    f"SELECT *, {_TIER} AS tier_order FROM (SELECT g_loyalty_tier, {isum('standard_bookings')} AS standard_bookings, "
    f"coalesce({total('estimated_uplift_30pct')}, 0) AS estimated_uplift FROM gold_upsell "
    "WHERE g_loyalty_tier IS NOT NULL GROUP BY 1)",
)
R.add(
    "d_kpi_hotel",
    lambda t: rollups.kpi_hotel_from(t.stays),
    f"SELECT c.*, {pct('premium_revenue', 'total_revenue')} AS premium_revenue_pct, "
    f"{pct('premium_bookings', 'total_bookings')} AS premium_conversion_pct, u.upsell_targets "
    f"FROM (SELECT {_CONV} FROM gold_conversion) c, (SELECT {isum('standard_bookings')} AS upsell_targets "
    "FROM gold_upsell WHERE g_loyalty_tier IS NOT NULL) u",
)
R.add(
    "d_kpi_flight",
    lambda t: rollups.kpi_flight_from(t.flown),
    f"SELECT s.*, n.* FROM (SELECT {isum('passengers')} AS total_passengers, "
    f"{rnd('(' + total('avg_satisfaction * passengers') + '/sum(passengers))', 4)} AS avg_satisfaction, "
    f"{isum('satisfied_count')} AS satisfied_count, {isum('dissatisfied_count')} AS dissatisfied_count "
    f"FROM air_segment) s, (SELECT {isum('no_shows')} AS total_no_shows, "
    "CAST(sum(no_shows) AS DOUBLE)/sum(passengers) AS overall_no_show FROM air_noshow) n",
)
R.add(
    "d_flight_tier",
    lambda t: rollups.flight_tier(_air("satisfaction_by_segment")(t)),
    f"SELECT *, {pct('satisfied_count', 'passengers', 1)} AS satisfaction_rate_pct, CASE p_frequent_flyer_status "
    "WHEN 'Platinum' THEN 0 WHEN 'Gold' THEN 1 WHEN 'Silver' THEN 2 WHEN 'Non-Member' THEN 3 END AS \"order\" "
    f"FROM (SELECT p_frequent_flyer_status, {isum('passengers')} AS passengers, {avg('avg_satisfaction')} AS "
    f"avg_satisfaction, {avg('no_show_rate')} AS no_show_rate, {isum('satisfied_count')} AS satisfied_count, "
    f"{isum('dissatisfied_count')} AS dissatisfied_count FROM air_segment "
    "WHERE p_frequent_flyer_status IS NOT NULL GROUP BY 1)",
)
R.add(
    "d_band",
    lambda t: rollups.band_share(kpi_flight.band_counts(t.flown)),
    f"SELECT satisfaction_band, n, {share('n', 'CAST(sum(n) OVER () AS BIGINT)', 2)} AS share_pct, "
    "CASE satisfaction_band WHEN 'Highly Satisfied' THEN 0 WHEN 'Satisfied' THEN 1 WHEN 'Neutral' THEN 2 ELSE 3 END "
    'AS "order" FROM bands',
)
R.add(
    "d_noshow_bucket",
    lambda t: rollups.noshow_bucket(_air("noshow_by_booking_pattern")(t)),
    f"SELECT *, {pct('no_shows', 'passengers')} AS no_show_rate, CASE booking_bucket WHEN '< 1 week' THEN 0 "
    "WHEN '1-4 weeks' THEN 1 WHEN '1-2 months' THEN 2 WHEN '2-3 months' THEN 3 ELSE 4 END AS \"order\" "
    f"FROM (SELECT booking_bucket, {isum('passengers')} AS passengers, {isum('no_shows')} AS no_shows, "
    f"{avg('avg_satisfaction')} AS avg_satisfaction FROM air_noshow GROUP BY 1)",
)
R.add(
    "d_checkin",
    lambda t: rollups.checkin(_air("friction_by_checkin")(t)),
    f"SELECT *, {pct('no_shows', 'passengers')} AS no_show_rate, {pct('satisfied_count', 'passengers')} AS "
    f"satisfaction_rate FROM (SELECT Check_in_Method, {isum('passengers')} AS passengers, {isum('no_shows')} AS "
    f"no_shows, {avg('avg_satisfaction')} AS avg_satisfaction, {isum('satisfied_count')} AS satisfied_count "
    "FROM air_checkin WHERE Check_in_Method IS NOT NULL GROUP BY 1)",
)
R.add(
    "d_delay",
    lambda t: rollups.delay(_air("delay_impact")(t)),
    f"SELECT delay_bucket, {isum('flights')} AS flights, {avg('avg_satisfaction')} AS avg_satisfaction, "
    f"{avg('no_show_rate')} AS no_show_rate, {isum('dissatisfied_count')} AS dissatisfied_count, CASE delay_bucket "
    "WHEN 'No Delay' THEN 0 WHEN '< 15 min' THEN 1 WHEN '15-30 min' THEN 2 WHEN '30-60 min' THEN 3 ELSE 4 END AS "
    '"order" FROM air_delay GROUP BY delay_bucket',
)
R.add(
    "d_class",
    lambda t: rollups.seat_class(_air("satisfaction_by_segment")(t)),
    f"SELECT Seat_Class, {isum('passengers')} AS passengers, {avg('avg_satisfaction')} AS avg_satisfaction, "
    f"{avg('no_show_rate')} AS no_show_rate, {avg('avg_price_paid')} AS avg_price_paid FROM air_segment "
    "WHERE Seat_Class IS NOT NULL GROUP BY 1",
)
R.add(
    "d_top_routes",
    lambda t: rollups.top_routes(_air("satisfaction_by_route")(t)),
    "SELECT * FROM air_route ORDER BY avg_satisfaction DESC NULLS LAST, r_route_id LIMIT 8",
)
R.add(
    "d_bottom_routes",
    lambda t: rollups.bottom_routes(_air("satisfaction_by_route")(t)),
    "SELECT * FROM air_route ORDER BY avg_satisfaction NULLS LAST, r_route_id LIMIT 8",
)
R.add(
    "d_threshold_color",
    lambda t: rollups.segment_adr(_gold("revenue_by_segment")(t)).select(
        "market_segment", rollups.adr_colour().alias("adr_colour")
    ),
    "SELECT market_segment, CASE WHEN a >= 110 THEN 'premium' WHEN a >= 80 THEN 'revenue' ELSE 'standard' END AS "
    f"adr_colour FROM (SELECT market_segment, {avg('avg_adr')} AS a FROM gold_segment "
    "WHERE market_segment <> 'Complementary' GROUP BY 1)",
)
R.add(
    "d_threshold_color_noshow",
    lambda t: rollups.noshow_bucket(_air("noshow_by_booking_pattern")(t)).select(
        "booking_bucket",
        rollups.no_show_colour().alias("bucket_colour"),
        rollups.no_show_colour(limits=rollups.CHECKIN_LIMITS).alias("checkin_colour"),
    ),
    "SELECT booking_bucket, CASE WHEN r > 5.5 THEN 'dissatisfied' WHEN r > 5.0 THEN 'neutral' ELSE 'satisfied' END AS "
    "bucket_colour, CASE WHEN r > 5.5 THEN 'dissatisfied' WHEN r > 4.8 THEN 'neutral' ELSE 'satisfied' END AS "
    f"checkin_colour FROM (SELECT booking_bucket, {pct('sum(no_shows)', 'sum(passengers)')} AS r FROM air_noshow GROUP BY 1)",
)

# -- report page --------------------------------------------------------------

_CITY, _RESORT = "hotel = 'City Hotel'", "hotel = 'Resort Hotel'"


def _mean_if(cond: str, n: int = 2) -> str:
    return mean(f"CASE WHEN {cond} THEN adr END", n)


def _pct_if(flag: str, cond: str) -> str:
    return share(f"count(*) FILTER (WHERE {flag} AND {cond})", f"count(*) FILTER (WHERE {cond})")


_LEAD = (
    "CASE WHEN lead_time BETWEEN 0 AND 7 THEN '0–7 days' WHEN lead_time BETWEEN 8 AND 30 THEN '8–30 days' "
    "WHEN lead_time BETWEEN 31 AND 90 THEN '31–90 days' WHEN lead_time BETWEEN 91 AND 180 THEN '91–180 days' "
    "ELSE '180+ days' END AS lead_time_bucket"
)
R.add(
    "h_meal_adr_by_hotel",
    lambda t: page.meal_adr_by_hotel(t.curated),
    f"SELECT meal_plan, {_mean_if(_CITY)} AS city, {_mean_if(_RESORT)} AS resort FROM kept GROUP BY 1",
)
R.add(
    "h_segment_rates",
    lambda t: page.segment_rates(t.curated),
    f"SELECT market_segment, {pct_where('is_premium_meal')} AS premium_pct, {pct_where('is_canceled')} AS cancel_pct "
    "FROM curated GROUP BY 1",
)
R.add(
    "h_monthly_premium_vs_standard",
    lambda t: page.monthly_premium_vs_standard(t.curated),
    f"SELECT CAST(month(arrival_date) AS INT) AS month_num, {_mean_if('is_premium_meal')} AS premium_adr, "
    f"{_mean_if('NOT is_premium_meal')} AS standard_adr FROM kept GROUP BY 1",
)
R.add(
    "h_revenue_bucket_share",
    lambda t: page.revenue_bucket_share(t.curated),
    f"SELECT revenue_bucket, bookings, {share('bookings', 'CAST(sum(bookings) OVER () AS BIGINT)')} AS share_pct "
    "FROM (SELECT revenue_bucket, count(*) AS bookings FROM curated GROUP BY 1)",
)
R.add(
    "h_lead_cancel_matrix",
    lambda t: page.lead_cancel_matrix(t.curated),
    f"SELECT {_LEAD}, {_pct_if('is_canceled', _CITY)} AS city, {_pct_if('is_canceled', _RESORT)} AS resort "
    "FROM curated GROUP BY 1",
)
R.add(
    "h_nps_by_package",
    lambda t: page.nps_by_package(t.voices),
    "SELECT package_name, "
    + ", ".join(f"{pct_where(f'''nps_category = '{c}' ''')} AS {c.lower()}_pct" for c in ("Promoter", "Passive", "Detractor"))
    + " FROM voices GROUP BY 1",
)
R.add(
    "h_deposit",
    lambda t: page.deposit(t.curated),
    f"SELECT deposit_type, {pct_where('is_canceled')} AS cancel_pct, {mean('adr')} AS avg_adr FROM curated GROUP BY 1",
)
R.add(
    "h_repeat",
    lambda t: page.repeat(t.curated),
    f"SELECT is_repeated_guest, {pct_where('is_canceled')} AS cancel_pct, {mean('adr')} AS avg_adr, "
    f"{mean('lead_time', 1)} AS avg_lead_time FROM curated GROUP BY 1",
)
_OPP = (
    "CASE WHEN premium_pct >= 22 THEN 'High' WHEN premium_pct >= 15 THEN 'Medium' WHEN premium_pct >= 10 THEN 'Low' "
    "ELSE 'None' END AS opportunity"
)
R.add("h_segment_table", lambda t: page.segment_table(t.curated), f"SELECT *, {_OPP} FROM funnel")
_COMPARE = ", ".join(
    f"('{m}', {m}, {str(lower).lower()})" for m, lower in page.METRICS.items()
)
R.add(
    "h_hotel_compare",
    lambda t: page.hotel_compare(t.curated, t.voices),
    f"""SELECT metric, city, resort, CASE WHEN city = resort THEN 'Equal' WHEN (lower AND city < resort) OR
  (NOT lower AND city > resort) THEN 'City Hotel' WHEN city IS NOT NULL AND resort IS NOT NULL THEN 'Resort Hotel' END AS best
FROM (SELECT metric, lower, max(CASE WHEN hotel = 'City Hotel' THEN figure END) AS city,
  max(CASE WHEN hotel = 'Resort Hotel' THEN figure END) AS resort
  FROM (SELECT s.hotel, x.metric, x.figure, x.lower FROM (SELECT b.*, v.avg_nps, v.avg_sat AS avg_satisfaction FROM
  (SELECT hotel, {pct_where('is_canceled')} AS cancellation_pct, {mean('lead_time', 1)} AS avg_lead_time,
   {pct_where('is_repeated_guest')} AS repeat_guest_pct, {mean('special_requests')} AS avg_special_requests
   FROM curated GROUP BY hotel) b LEFT JOIN nps_hotel v ON b.hotel = v.hotel_type) s,
  LATERAL (VALUES {_COMPARE}) AS x(metric, figure, lower)) GROUP BY metric, lower)""",
)
R.add(
    "drv_best_hotel",
    lambda t: page.hotel_compare(t.curated, t.voices).select("metric", "best"),
    f"SELECT metric, best FROM ({SQL['h_hotel_compare']})",
)
R.add(
    "h_kpi_tiles",
    lambda t: page.kpi_tiles(t.bookings, t.voices),
    f"""SELECT c.*, k.*, p.m AS peak_month, p.adr AS peak_month_adr, s.market_segment AS top_segment,
  s.pct AS top_segment_pct, n.avg_nps, r.raw_rows
FROM (SELECT count(*) AS curated_rows, {pct_where('is_premium_meal')} AS premium_conversion_pct,
  {pct_where('is_canceled')} AS cancellation_pct, {mean('lead_time', 0)} AS avg_lead_time,
  {pct_where('is_repeated_guest')} AS repeat_guest_pct, {mean('special_requests')} AS avg_special_requests FROM curated) c,
 (SELECT {_mean_if('is_premium_meal')} AS premium_adr, {_mean_if('NOT is_premium_meal')} AS standard_adr,
  {_mean_if('is_premium_meal AND ' + _RESORT)} AS resort_premium_adr,
  {_mean_if('is_premium_meal AND ' + _CITY)} AS city_premium_adr FROM kept) k,
 (SELECT CAST(month(arrival_date) AS INT) AS m, {mean('adr')} AS adr FROM kept WHERE is_premium_meal GROUP BY 1
  ORDER BY adr DESC, m LIMIT 1) p,
 (SELECT market_segment, {pct_where('is_premium_meal')} AS pct FROM curated WHERE market_segment IS NOT NULL GROUP BY 1
  ORDER BY pct DESC, market_segment LIMIT 1) s,
 (SELECT {mean('nps_score', 1)} AS avg_nps FROM voices) n, (SELECT count(*) AS raw_rows FROM bookings) r""",
)
