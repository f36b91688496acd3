"""SQL reports (q_*), windows (w_*) and JSON export."""

from __future__ import annotations

from pyspark.sql import functions as F

from verification.ctes import CTES, avg, mean, pct_where, rnd, share, share_where, total
from wayfare.operators import reports

from .common import Registry

R = Registry()
QUERIES, SQL = R.queries, R.sql

# clocks are parameters, so that two runs agree
SNAPSHOT, STAMP = "2024-01-31", "2024-01-31 12:00:00"


def _day():
    return F.lit(SNAPSHOT).cast("date")


def _now():
    return F.lit(STAMP).cast("timestamp")


CTES["nps_hotel"] = f"""
SELECT hotel_type, {mean('nps_score')} AS avg_nps, {pct_where("nps_category = 'Promoter'")} AS promoter_pct,
  {pct_where("nps_category = 'Detractor'")} AS detractor_pct, {mean('avg_satisfaction')} AS avg_sat
FROM voices GROUP BY hotel_type"""
CTES["premium_snapshot"] = f"""
SELECT DATE '{SNAPSHOT}' AS snapshot_date, hotel, market_segment, meal_plan, revenue_bucket,
  count(*) AS total_bookings, {total('adr')} AS total_adr, {mean('adr')} AS avg_adr,
  {share_where('is_canceled')} AS cancellation_rate, {share_where('is_premium_meal')} AS premium_conversion_rate
FROM kept GROUP BY ALL"""
CTES["satisfaction_snapshot"] = f"""
SELECT DATE '{SNAPSHOT}' AS snapshot_date, b.hotel, b.market_segment, {mean('b.lead_time', 1)} AS avg_lead_time,
  {share_where('b.is_canceled')} AS cancellation_rate, {mean('b.special_requests')} AS avg_special_requests,
  {share_where('b.is_repeated_guest')} AS repeat_guest_rate, n.avg_nps AS avg_nps_score, n.promoter_pct,
  n.detractor_pct, n.avg_sat AS avg_satisfaction
FROM curated b LEFT JOIN nps_hotel n ON b.hotel = n.hotel_type
GROUP BY b.hotel, b.market_segment, n.avg_nps, n.promoter_pct, n.detractor_pct, n.avg_sat"""
CTES["funnel"] = f"""
SELECT *, rank() OVER (ORDER BY premium_pct DESC) AS premium_rank_big FROM (
SELECT market_segment, total_bookings, premium_bookings, {share('premium_bookings', 'total_bookings')} AS premium_pct,
  avg_adr, cancel_rate FROM (SELECT market_segment, count(*) AS total_bookings,
  count(*) FILTER (WHERE is_premium_meal) AS premium_bookings, {mean('adr')} AS avg_adr,
  {share_where('is_canceled')} AS cancel_rate FROM curated GROUP BY market_segment))"""
CTES["funnel"] = (
    "SELECT * EXCLUDE (premium_rank_big), CAST(premium_rank_big AS INT) AS premium_rank FROM ("
    + CTES["funnel"].strip()
    + ")"
)

R.add("q_bo1_snapshot", lambda t: reports.premium_snapshot(t.curated, _day()), "SELECT * FROM premium_snapshot")
R.add(
    "q_bo1_snapshot_all",
    lambda t: reports.premium_snapshot(t.curated, _day(), include_canceled=True),
    CTES["premium_snapshot"].replace("FROM kept", "FROM curated"),
)
R.add(
    "q_bo1_meal_share",
    lambda t: reports.meal_share(t.curated),
    f"""SELECT meal_plan, hotel, bookings, avg_daily_rate, {rnd('revenue', 0)} AS total_revenue,
  {share('revenue', 'hotel_revenue')} AS pct_of_hotel_revenue FROM (SELECT *, sum(revenue) OVER (PARTITION BY hotel)
  AS hotel_revenue FROM (SELECT meal_plan, hotel, count(*) AS bookings, {mean('adr')} AS avg_daily_rate,
  {total('adr')} AS revenue FROM kept GROUP BY 1, 2))""".replace("sum(revenue) OVER", "sum(CAST(revenue AS DECIMAL(24,6))) OVER")
    .replace("AS hotel_revenue FROM (SELECT meal", "AS hotel_dec FROM (SELECT meal")
    .replace("hotel_revenue,0", "CAST(hotel_dec AS DOUBLE),0"),
)
R.add("q_bo1_segment_funnel", lambda t: reports.segment_funnel(t.curated), "SELECT * FROM funnel")
_MONTHNAME = "monthname(arrival_date)"
R.add(
    "q_bo1_seasonal",
    lambda t: reports.seasonal(t.curated),
    "SELECT CAST(year(arrival_date) AS INT) AS arrival_date_year, CAST(month(arrival_date) AS INT) AS month_num, "
    f"{_MONTHNAME} AS arrival_date_month, hotel, count(*) AS bookings, {mean('adr')} AS avg_adr, "
    f"{pct_where('is_premium_meal')} AS premium_pct FROM kept GROUP BY ALL",
)
R.add(
    "q_bo1_room_upgrade",
    lambda t: reports.room_upgrade(t.curated),
    f"SELECT hotel, room_upgrade, count(*) AS bookings, {mean('adr')} AS avg_adr, {mean('special_requests')} AS "
    f"avg_special_requests, {pct_where('is_canceled')} AS cancel_pct FROM curated GROUP BY ALL",
)
_CROSS = f"""
SELECT gp.loyalty_tier, b.meal_plan, b.hotel, count(DISTINCT gp.guest_id) AS guests, {mean('b.adr')} AS avg_adr,
  {mean('gp.total_spend_eur')} AS avg_lifetime_spend
FROM kept b JOIN guest_profiles gp ON b.country = gp.country AND b.market_segment = gp.preferred_segment
GROUP BY ALL"""
R.add("q_bo1_loyalty_cross", lambda t: reports.loyalty_cross(t.curated, t.guest_profiles), _CROSS)
R.add(
    "q_bo1_loyalty_cross_unique",
    lambda t: reports.loyalty_cross(t.curated, t.guest_profiles, unique_guests=True),
    _CROSS,
)
R.add(
    "jn_profiles_segment",
    lambda t: reports.profile_matches(t.curated, t.guest_profiles),
    """SELECT b.country, b.market_segment, count(DISTINCT b.rn) AS bookings, count(DISTINCT gp.guest_id) AS guests,
  count(*) AS pairs FROM (SELECT *, row_number() OVER () AS rn FROM kept) b JOIN guest_profiles gp
  ON b.country = gp.country AND b.market_segment = gp.preferred_segment GROUP BY 1, 2""",
)
R.add(
    "q_bo2_nps",
    lambda t: reports.nps_by_hotel(t.voices),
    "SELECT * FROM nps_hotel",
)
R.add(
    "q_bo2_snapshot",
    lambda t: reports.satisfaction_snapshot(t.curated, t.voices, _day()),
    "SELECT * FROM satisfaction_snapshot",
)
R.add(
    "jn_nps",
    lambda t: reports.with_nps(t.curated.groupBy("hotel").agg(F.count(F.lit(1)).alias("bookings")), t.voices),
    "SELECT b.*, n.* EXCLUDE (hotel_type) FROM (SELECT hotel, count(*) AS bookings FROM curated GROUP BY 1) b "
    "LEFT JOIN nps_hotel n ON b.hotel = n.hotel_type",
)
R.add(
    "jn_seasonal_raw",
    lambda t: reports.seasonal(t.curated).groupBy("arrival_date_year").agg(F.sum("bookings").alias("bookings")),
    "SELECT CAST(year(arrival_date) AS INT) AS arrival_date_year, count(*) AS bookings FROM kept GROUP BY 1",
)
_LEAD = (
    "CASE WHEN lead_time BETWEEN 0 AND 7 THEN '0–7 days' WHEN lead_time BETWEEN 8 AND 30 THEN '8–30 days' "
    "WHEN lead_time BETWEEN 31 AND 90 THEN '31–90 days' WHEN lead_time BETWEEN 91 AND 180 THEN '91–180 days' "
    "ELSE '180+ days' END"
)
R.add(
    "q_bo2_lead_cancel",
    lambda t: reports.lead_cancel(t.curated),
    f"SELECT hotel, {_LEAD} AS lead_time_bucket, count(*) AS bookings, count(*) FILTER (WHERE is_canceled) AS "
    f"canceled, {pct_where('is_canceled')} AS cancellation_pct, {mean('adr')} AS avg_adr FROM curated GROUP BY ALL",
)
R.add(
    "q_bo2_special_requests",
    lambda t: reports.special_requests(t.curated),
    f"SELECT hotel, special_requests, count(*) AS bookings, {pct_where('is_canceled')} AS cancel_pct, {mean('adr')} "
    "AS avg_adr FROM curated GROUP BY ALL",
)
R.add(
    "q_bo2_deposit",
    lambda t: reports.deposit(t.curated),
    f"SELECT hotel, deposit_type, count(*) AS bookings, {pct_where('is_canceled')} AS cancel_pct, "
    f"{mean('lead_time', 1)} AS avg_lead_time, {mean('adr')} AS avg_adr, {mean('special_requests')} AS "
    "avg_special_requests FROM curated GROUP BY ALL",
)
R.add(
    "q_bo2_nps_channel",
    lambda t: reports.nps_by_channel(t.voices),
    f"SELECT hotel_type, package_name, booking_channel, count(*) AS responses, {mean('nps_score', 1)} AS avg_nps, "
    f"""{pct_where("nps_category = 'Promoter'")} AS promoter_pct, {pct_where("nps_category = 'Detractor'")} AS """
    f"detractor_pct, {mean('avg_satisfaction')} AS avg_satisfaction FROM voices GROUP BY ALL",
)
R.add(
    "q_bo2_repeat",
    lambda t: reports.repeat_guests(t.curated),
    f"SELECT hotel, is_repeated_guest, {mean('lead_time', 1)} AS avg_lead_time, {mean('adr')} AS avg_adr, "
    f"{mean('special_requests')} AS avg_special_requests, {mean('booking_changes')} AS avg_changes, "
    f"{pct_where('is_canceled')} AS cancel_pct, count(*) AS bookings FROM curated GROUP BY ALL",
)
R.add(
    "q_bo2_waiting",
    lambda t: reports.waiting_list(t.curated),
    "SELECT hotel, CASE WHEN days_in_waiting_list = 0 THEN 'No wait' WHEN days_in_waiting_list BETWEEN 1 AND 7 THEN "
    f"'1–7 days wait' ELSE '8+ days wait' END AS wait_bucket, count(*) AS bookings, {mean('adr')} AS avg_adr, "
    f"{pct_where('is_canceled')} AS cancel_pct FROM curated GROUP BY ALL",
)
R.add(
    "q_sim_bo1",
    lambda t: reports.premium_by_meal(t.curated),
    f"SELECT hotel, meal_plan, count(adr) AS total_bookings, {avg('adr')} AS avg_adr, count(*) FILTER (WHERE "
    "is_premium_meal) AS premium_count FROM kept GROUP BY 1, 2",
)
R.add(
    "q_sim_bo2",
    lambda t: reports.cancellation_by_hotel(t.curated),
    "SELECT hotel, CAST(count(*) FILTER (WHERE is_canceled) AS DOUBLE)/count(*) AS cancellation_rate, "
    "avg(lead_time) AS avg_lead_time FROM curated GROUP BY 1",
)

_NUMBER = "CAST({c} AS VARCHAR)"


def _object(numbers: tuple[str, ...], keys: tuple[str, ...]) -> str:
    """The JSON text Spark writes: keys in order, NULL ones left out."""
    parts = []
    for key in keys:
        value = f"CAST({key} AS VARCHAR)" if key in numbers else f"'\"' || {key} || '\"'"
        parts.append(f"coalesce(',\"{key}\":' || {value}, '')")
    return f"'{{\"generated_at\":\"{STAMP}\"' || " + " || ".join(parts) + " || '}'"


CTES["export_premium"] = (
    "SELECT 'BO1' AS export_type, "
    + _object(reports.PREMIUM_KEYS[4:], reports.PREMIUM_KEYS)
    + " AS payload FROM premium_snapshot"
)
CTES["export_satisfaction"] = (
    "SELECT 'BO2' AS export_type, "
    + _object(reports.SATISFACTION_KEYS[2:], reports.SATISFACTION_KEYS)
    + " AS payload FROM satisfaction_snapshot"
)


def _premium_json(t):
    return reports.premium_json(reports.premium_snapshot(t.curated, _day()), _now())


def _satisfaction_json(t):
    return reports.satisfaction_json(reports.satisfaction_snapshot(t.curated, t.voices, _day()), _now())


R.add("snk_json_export_bo1", _premium_json, "SELECT * FROM export_premium")
R.add("snk_json_export_bo2", _satisfaction_json, "SELECT * FROM export_satisfaction")
R.add(
    "snk_json_read_bo1",
    lambda t: reports.read_export(_premium_json(t), reports.PREMIUM_TAG, reports.PREMIUM_KEYS),
    f"SELECT '{STAMP}' AS generated_at, {', '.join(reports.PREMIUM_KEYS)} FROM premium_snapshot",
)
R.add(
    "snk_json_read_bo2",
    lambda t: reports.read_export(_satisfaction_json(t), reports.SATISFACTION_TAG, reports.SATISFACTION_KEYS),
    f"SELECT '{STAMP}' AS generated_at, {', '.join(reports.SATISFACTION_KEYS)} FROM satisfaction_snapshot",
)
R.add(
    "dq_downstream_json",
    lambda t: reports.export_structure(
        _premium_json(t).unionByName(_satisfaction_json(t)), {reports.PREMIUM_TAG: ("hotel", "meal_plan"), reports.SATISFACTION_TAG: ("hotel",)}
    ),
    "SELECT 'BO1' AS export_type, count(*) AS objects, CAST(0 AS BIGINT) AS broken, "
    "count(*) FILTER (WHERE hotel IS NULL OR meal_plan IS NULL) AS lacking, "
    "count(*) > 0 AND count(*) FILTER (WHERE hotel IS NULL OR meal_plan IS NULL) = 0 AS passed FROM premium_snapshot UNION ALL "
    "SELECT 'BO2', count(*), 0, count(*) FILTER (WHERE hotel IS NULL), count(*) > 0 AND count(*) FILTER (WHERE hotel IS NULL) = 0 "
    "FROM satisfaction_snapshot",
)
R.add(
    "q_verify_counts",
    lambda t: reports.rows_per_type(_premium_json(t).unionByName(_satisfaction_json(t))),
    "SELECT 'BO1' AS export_type, count(*) AS n FROM premium_snapshot UNION ALL "
    "SELECT 'BO2', count(*) FROM satisfaction_snapshot",
)
R.add(
    "w_share_of_partition",
    lambda t: reports.meal_share(t.curated).select("hotel", "meal_plan", "pct_of_hotel_revenue"),
    f"SELECT hotel, meal_plan, {share(total('adr'), 'CAST(sum(sum(CAST(adr AS DECIMAL(24,6)))) OVER (PARTITION BY hotel) AS DOUBLE)')} "
    "AS pct_of_hotel_revenue FROM kept GROUP BY hotel, meal_plan",
)
R.add(
    "w_rank",
    lambda t: reports.segment_funnel(t.curated).select("market_segment", "premium_rank"),
    "SELECT market_segment, premium_rank FROM funnel",
)
