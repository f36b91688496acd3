"""Views that give the driver's tables the shape of the travel sources.

Each text is valid both for Spark SQL and for the SQL check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import broadcast_limit, path_bytes

BOOKINGS = """
SELECT
  l.l_orderkey * 10 + l.l_linenumber AS src_key,
  CASE WHEN l.l_suppkey % 2 = 0 THEN 'City Hotel' ELSE 'Resort Hotel' END AS hotel,
  CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS is_canceled,
  CAST((l.l_partkey * 7 + l.l_suppkey * 3) % 400 AS INT) AS lead_time,
  CAST(year(l.l_shipdate) AS INT) AS arrival_date_year,
  CASE month(l.l_shipdate) WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March'
    WHEN 4 THEN 'April' WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August'
    WHEN 9 THEN 'September' WHEN 10 THEN 'October' WHEN 11 THEN 'November' ELSE 'December' END AS arrival_date_month,
  CAST(day(l.l_shipdate) AS INT) AS arrival_date_day_of_month,
  CAST(l.l_linenumber % 3 AS INT) AS stays_in_weekend_nights,
  CAST(CAST(l.l_quantity AS INT) % 6 AS INT) AS stays_in_week_nights,
  CAST(1 + l.l_partkey % 3 AS INT) AS adults,
  CASE WHEN l.l_partkey % 97 = 0 THEN NULL ELSE CAST(l.l_partkey % 4 AS DOUBLE) END AS children,
  CASE WHEN l.l_orderkey % 50 = 0 THEN 1 ELSE 0 END AS babies,
  CASE l.l_partkey % 6 WHEN 0 THEN 'BB' WHEN 1 THEN 'BB' WHEN 2 THEN 'HB' WHEN 3 THEN 'FB' WHEN 4 THEN 'SC' ELSE 'Undefined' END AS meal,
  CASE WHEN c.c_nationkey = 7 THEN NULL ELSE n.n_name END AS country,
  CASE WHEN o.o_orderkey % 41 = 0 THEN 'Undefined' WHEN o.o_orderkey % 37 = 0 THEN 'Complementary' ELSE c.c_mktsegment END AS market_segment,
  o.o_orderpriority AS distribution_channel,
  CASE WHEN o.o_custkey % 9 = 0 THEN 1 ELSE 0 END AS is_repeated_guest,
  CAST(l.l_orderkey % 3 AS INT) AS previous_cancellations,
  CAST(l.l_orderkey % 4 AS INT) AS booking_changes,
  substr('ABCDEFGH', CAST(p.p_size % 8 AS INT) + 1, 1) AS reserved_room_type,
  substr('ABCDEFGH', CAST((p.p_size + CASE WHEN l.l_linenumber = 4 THEN 1 ELSE 0 END) % 8 AS INT) + 1, 1) AS assigned_room_type,
  CASE WHEN l.l_linestatus = 'F' THEN 'No Deposit' WHEN l.l_suppkey % 5 = 0 THEN 'Refundable' ELSE 'Non Refund' END AS deposit_type,
  CASE WHEN l.l_suppkey % 4 = 0 THEN CAST(l.l_orderkey % 20 AS INT) ELSE 0 END AS days_in_waiting_list,
  CASE o.o_orderstatus WHEN 'F' THEN 'Transient' WHEN 'O' THEN 'Contract' ELSE 'Group' END AS customer_type,
  CASE WHEN l.l_partkey % 40 = 0 THEN CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) % 110000 - 2000 AS DOUBLE) / 100
       ELSE CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) % 18000 AS DOUBLE) / 100 END AS adr,
  CAST((l.l_partkey + l.l_linenumber) % 5 AS INT) AS total_of_special_requests,
  CASE WHEN l.l_returnflag = 'R' THEN 'Canceled' ELSE 'Check-Out' END AS reservation_status,
  CAST(o.o_orderdate AS DATE) AS reservation_status_date,
  c.c_name AS name,
  CASE WHEN l.l_orderkey % 211 = 0 THEN NULL ELSE c.c_name || '.' || CAST(l.l_partkey % 24 AS STRING) || '@mail.test' END AS email
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {part} p ON l.l_partkey = p.p_partkey
"""

FLIGHTS = """
SELECT
  'P' || CAST(e.user_id AS STRING) AS Passenger_ID,
  'F' || CAST(e.event_id AS STRING) AS Flight_ID,
  CASE e.event_id % 5 WHEN 0 THEN 'Aero Lines' WHEN 1 THEN 'Blue Sky' WHEN 2 THEN 'Nordic Air' WHEN 3 THEN 'Sunjet' ELSE 'West Wing' END AS Airline,
  CASE e.user_id % 6 WHEN 0 THEN 'HAM' WHEN 1 THEN 'FRA' WHEN 2 THEN 'LIS' WHEN 3 THEN 'MAD' WHEN 4 THEN 'CDG' ELSE 'AMS' END AS Departure_Airport,
  CASE e.event_id % 3 WHEN 0 THEN 'JFK' WHEN 1 THEN 'LAX' ELSE 'ORD' END AS Arrival_Airport,
  substr(CAST(e.ts AS STRING), 1, 19) AS Departure_Time,
  CASE WHEN e.event_id % 31 = 0 THEN 'Cancelled' WHEN e.event_id % 13 = 0 OR (e.event_type = 'click' AND e.event_id % 2 = 0 AND e.user_id % 6 < 5) THEN 'Delayed' ELSE 'On-time' END AS Flight_Status,
  CAST(45 + e.event_id % 600 AS INT) AS Flight_Duration_Minutes,
  CAST(100 + (e.event_id * 7) % 5000 AS INT) AS Distance_Miles,
  CAST(5000 + CAST(round(e.value * 100) AS BIGINT) * 3 AS DOUBLE) / 100 AS Price_USD,
  CAST(18 + e.user_id % 60 AS INT) AS Age,
  CASE WHEN e.user_id % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
  CASE e.user_id % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS Income_Level,
  CASE e.event_id % 4 WHEN 0 THEN 'Business' WHEN 1 THEN 'Leisure' WHEN 2 THEN 'Family' ELSE 'Emergency' END AS Travel_Purpose,
  CASE WHEN e.event_id % 10 < 6 THEN 'Economy' WHEN e.event_id % 10 < 9 THEN 'Business' ELSE 'First' END AS Seat_Class,
  CASE WHEN e.event_id % 29 = 0 THEN NULL ELSE CAST(e.event_id % 4 AS INT) END AS Bags_Checked,
  CASE e.user_id % 5 WHEN 0 THEN 'Platinum' WHEN 1 THEN 'Gold' WHEN 2 THEN 'Silver' ELSE NULL END AS Frequent_Flyer_Status,
  CASE (e.event_id + e.user_id) % 4 WHEN 0 THEN 'Online' WHEN 1 THEN 'Mobile App' WHEN 2 THEN 'Airport Kiosk' ELSE 'Counter' END AS Check_in_Method,
  CASE WHEN e.event_id % 71 = 0 THEN NULL
       ELSE CAST((e.user_id % 6) * 12 + (e.event_id % 5) * 2 + CAST(round(e.value * 100) AS BIGINT) % 33 AS DOUBLE) / 10 END AS Flight_Satisfaction_Score,
  CASE WHEN e.event_id % 53 = 0 THEN NULL WHEN e.event_id % 20 = 0 THEN 0.0E0
       ELSE CAST((CAST(round(e.value * 100) AS BIGINT) * 13) % 4200 - 200 AS DOUBLE) / 10 END AS Delay_Minutes,
  CASE WHEN e.event_id % 61 = 0 THEN NULL ELSE CAST((e.event_id * 7) % 121 AS DOUBLE) END AS Booking_Days_In_Advance,
  CASE WHEN e.event_id % 17 = 0 THEN 1 ELSE 0 END AS No_Show,
  CASE WHEN e.event_id % 6 = 0 THEN 1 ELSE 0 END AS Weather_Impact
FROM {events} e
"""

FEEDBACK = """
SELECT
  e.event_id AS feedback_id, e.user_id AS guest_key,
  CASE WHEN e.user_id % 2 = 0 THEN 'City Hotel' ELSE 'Resort Hotel' END AS hotel_type,
  CASE e.event_type WHEN 'view' THEN 'Standard' WHEN 'click' THEN 'Breakfast Included' WHEN 'signup' THEN 'Half Board' WHEN 'purchase' THEN 'Full Board' ELSE 'Premium All-Inclusive' END AS package_name,
  CAST(e.ts AS DATE) AS stay_date,
  CAST(CAST(round(e.value * 100) AS BIGINT) % 11 AS INT) AS nps_score,
  CAST(1 + e.event_id % 5 AS INT) AS checkin_satisfaction, CAST(1 + (e.event_id * 3) % 5 AS INT) AS room_satisfaction,
  CAST(1 + e.user_id % 5 AS INT) AS food_satisfaction, CAST(1 + (e.user_id + e.event_id) % 5 AS INT) AS value_for_money,
  CASE e.event_id % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'Maybe' END AS would_return,
  CASE e.event_id % 7 WHEN 0 THEN 'GDS' WHEN 1 THEN 'TA/TO' ELSE 'Direct' END AS booking_channel
FROM {events} e
"""

GUEST_PROFILES = """
SELECT
  c.c_custkey AS guest_id, n.n_name AS country,
  CASE WHEN c.c_custkey % 20 = 0 THEN 'Platinum' WHEN c.c_custkey % 20 < 4 THEN 'Gold' WHEN c.c_custkey % 20 < 10 THEN 'Silver' ELSE 'Bronze' END AS loyalty_tier,
  CAST(1 + c.c_custkey % 40 AS INT) AS total_stays, abs(c.c_acctbal) AS total_spend_eur,
  c.c_mktsegment AS preferred_segment
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

_TABLES = {
    "bookings": ("lineitem", "orders", "customer", "nation", "part"),
    "flights": ("events",),
    "feedback": ("events",),
    "guest_profiles": ("customer", "nation"),
}
_TEXT = {"bookings": BOOKINGS, "flights": FLIGHTS, "feedback": FEEDBACK, "guest_profiles": GUEST_PROFILES}

# the same texts over plain table names, for the SQL check
VIEWS = {name: text.format(**{t: t for t in _TABLES[name]}) for name, text in _TEXT.items()}


# Where a lookup named here is too large to broadcast, Spark joins in this order: the same rows as by the
# text's own FROM, but lookups meet orders and narrow lines, so that no whole booking is moved for them
_LARGE = {"bookings": ("customer", "part")}
_JOINS = {
    "bookings": """
FROM ({lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey)
JOIN ({orders} o JOIN ({customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey) ON o.o_custkey = c.c_custkey)
  ON l.l_orderkey = o.o_orderkey
"""
}

# the table with the rows, and the column to deal it by
_ROWS = {"bookings": ("lineitem", "l_orderkey"), "flights": ("events", "event_id"), "feedback": ("events", "event_id"),
         "guest_profiles": ("customer", "c_custkey")}


def has_large_lookup(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether a lookup of the view is too large to broadcast, so that its rows are shuffled each time it is read."""
    return any(path_bytes(spark, f"{sf_dir}/{t}.parquet") > broadcast_limit(spark) for t in _LARGE.get(name, ()))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source built over the parquet tables in ``sf_dir``.

    No join is hinted: a table is broadcast only while its measured size is
    under the session's threshold, and sort-merge joined beyond it. A table of fewer
    files than the cluster has cores (the test tables are one file of one row group,
    which no split size divides) is dealt out first.
    """
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES[name]}
    main, key = _ROWS[name]
    text = _TEXT[name]
    cores = spark.sparkContext.defaultParallelism
    if has_large_lookup(spark, sf_dir, name):
        text = text[: text.index("FROM {")] + _JOINS[name]  # its joins deal the rows out
    elif len(tables[main].inputFiles()) < cores:
        tables[main] = tables[main].repartition(cores, key)
    return spark.sql(text, **tables)
