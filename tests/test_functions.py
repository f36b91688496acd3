"""Every expression on its edges, and on NULL."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfare.functions import coerce, dates, labels, numeric
from wayfare.operators import flight, hotel


def values(spark, kind, data, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


@pytest.mark.parametrize(
    "kind, function, cases",
    [
        ("int", labels.lead_time_bucket, {6: "< 1 week", 7: "1-4 weeks", 29: "1-4 weeks", 30: "1-3 months", 89: "1-3 months",
                                          90: "3-6 months", 179: "3-6 months", 180: "6+ months", None: "6+ months"}),
        ("int", labels.lead_days_bucket, {0: "0–7 days", 7: "0–7 days", 8: "8–30 days", 30: "8–30 days", 31: "31–90 days",
                                          91: "91–180 days", 180: "91–180 days", 181: "180+ days", -1: "180+ days", None: "180+ days"}),
        ("int", labels.wait_bucket, {0: "No wait", 1: "1–7 days wait", 7: "1–7 days wait", 8: "8+ days wait", None: "8+ days wait"}),
        ("double", labels.revenue_bucket, {60.0: "Low", 79.99: "Low", 80.0: "Mid", 100.0: "Mid", 149.99: "Mid", 150.0: "Premium", 200.0: "Premium"}),
        ("double", labels.delay_bucket, {0.0: "No Delay", 0.1: "< 15 min", 15.0: "< 15 min", 15.1: "15-30 min", 30.0: "15-30 min",
                                         60.0: "30-60 min", 60.1: "> 60 min", None: "> 60 min"}),
        ("double", labels.booking_bucket, {0.0: "< 1 week", 7.0: "< 1 week", 8.0: "1-4 weeks", 30.0: "1-4 weeks", 60.0: "1-2 months",
                                           90.0: "2-3 months", 91.0: "3+ months", None: "3+ months"}),
        ("int", labels.time_of_day, {0: "Night (0-6)", 5: "Night (0-6)", 6: "Morning (6-12)", 11: "Morning (6-12)", 12: "Afternoon (12-18)",
                                     17: "Afternoon (12-18)", 18: "Evening (18-24)", None: "Evening (18-24)"}),
        ("double", labels.satisfaction_band, {8.0: "Highly Satisfied", 7.9: "Satisfied", 7.0: "Satisfied", 5.0: "Neutral",
                                              4.9: "Dissatisfied", None: "Dissatisfied"}),
        ("double", labels.satisfaction_segment, {8.0: "Highly Satisfied", 6.5: "Satisfied", 6.4: "Neutral", 5.0: "Neutral", 4.9: "Dissatisfied"}),
        ("int", labels.nps_category, {10: "Promoter", 9: "Promoter", 8: "Passive", 7: "Passive", 6: "Detractor", 0: "Detractor"}),
        ("string", labels.guest_value_segment, {"Platinum": "High Value", "Gold": "Mid-High Value", "Silver": "Mid Value",
                                                "Bronze": "Standard", None: "Standard"}),
        ("string", dates.month_number, {"January": 1, "December": 12, "Smarch": None, None: None}),
        ("string", lambda c: dates.month_number(c, 1), {"August": 8, "Smarch": 1, None: 1}),
        ("string", coerce.to_int, {"3": 3, "3.0": 3, "3.5": None, "x": None, "": None, None: None, "9007199254740993": 9007199254740993}),
        ("string", coerce.to_float, {"3": 3.0, "1e2": 100.0, "nan": None, "x": None, None: None}),
        ("string", coerce.to_text, {"a": "a", "nan": None, None: None, "None": "None"}),
        ("string", coerce.null_token, {"NULL": None, "": None, "NA": None, "PRT": "PRT", "null": None}),
        ("double", numeric.round_half_up, {1.005: 1.01, 2.675: 2.68, 0.125: 0.13, -0.125: -0.13, 5.0: 5.0, None: None}),
        ("string", labels.guest_id, {"a@b.c": "G-5D60D4E2", None: None}),
        ("string", lambda c: labels.ordinal(c, labels.TIER_ORDER), {"Platinum": 0, "Bronze": 3, "Other": None, None: None}),
        ("double", lambda c: labels.threshold_band(c, 110, 80, ("a", "b", "c"), True), {110.0: "a", 109.9: "b", 80.0: "b", 79.9: "c"}),
        ("double", lambda c: labels.threshold_band(c, 5.5, 5.0, ("a", "b", "c"), False), {5.6: "a", 5.5: "b", 5.0: "c"}),
    ],
)
def test_edges(spark, kind, function, cases):
    got = values(spark, kind, list(cases), function)
    if function is labels.guest_id:
        import hashlib

        assert got == ["G-" + hashlib.md5(b"a@b.c").hexdigest()[:8].upper(), None]
    else:
        assert got == list(cases.values())


def test_null_label_is_optional(spark):
    assert values(spark, "int", [None, 3], lambda c: labels.lead_time_bucket(c, "unknown")) == ["unknown", "< 1 week"]


def test_clamps_keep_null(spark):
    adr = values(spark, "double", [-1.0, 0.0, 1000.0, 1001.0, None], lambda c: hotel.clamp("x", 0.0, 1000.0))
    assert adr == [0.0, 0.0, 1000.0, 1000.0, None]
    delay = values(spark, "double", [-1.0, 300.0, 301.0], lambda c: hotel.clamp("x", flight.DELAY_MIN, flight.DELAY_MAX))
    assert delay == [0.0, 300.0, 300.0]


@pytest.mark.parametrize(
    "parts, day",
    [((2016, 8, 15), dt.date(2016, 8, 15)), ((2016, 2, 29), dt.date(2016, 2, 29)), ((2015, 2, 29), None), ((2016, 6, 31), None),
     ((2016, None, 15), None), ((None, 8, 15), None), ((2016, 13, 1), None)],
)
def test_date_from_parts(spark, parts, day):
    df = spark.createDataFrame([parts], "y int, m int, d int")
    assert df.select(dates.date_from_parts("y", F.col("m"), "d")).first()[0] == day


def test_text_dates(spark):
    df = spark.createDataFrame([("2016-08-20",), ("2016-13-20",), ("soon",), ("2016",), (None,)], "d string")
    assert [r[0] for r in df.select(dates.to_day(df, "d")).collect()] == [dt.date(2016, 8, 20), None, None, None, None]
    df = spark.createDataFrame([("2016-08-20 05:06:07",), ("2016-08-20",), ("x" * 19,)], "d string")
    assert [r[0] for r in df.select(dates.to_moment("d")).collect()] == [dt.datetime(2016, 8, 20, 5, 6, 7), None, None]


def test_loyalty_tiers(spark):
    rows = [(1500.0, 0, 0), (0.0, 4, 0), (700.0, 0, 0), (0.0, 3, 0), (300.0, 0, 0), (0.0, 2, 0), (0.0, 0, 3), (299.0, 1, 2)]
    df = spark.createDataFrame(rows, "s double, n int, r int")
    got = [r[0] for r in df.select(labels.loyalty_tier("s", "n", "r")).collect()]
    assert got == ["Platinum", "Platinum", "Gold", "Gold", "Silver", "Silver", "Silver", "Bronze"]


def test_route_tiers(spark):
    df = spark.createDataFrame([(7.2, 0.85), (7.2, 0.84), (6.5, 0.75), (6.4, 1.0), (None, 1.0)], "s double, o double")
    got = [r[0] for r in df.select(labels.route_tier("s", "o")).collect()]
    assert got == ["High Performing", "Average", "Average", "Needs Improvement", "Needs Improvement"]


def test_premium_and_upsell_flags(spark):
    df = spark.createDataFrame(
        [("BB", "A", "Gold"), ("HB", "A", "Gold"), ("BB", "A", None), ("HB", "A", None), ("BB", "F", "Silver"), (None, "A", "Gold")],
        "meal string, reserved_room_type string, g_loyalty_tier string",
    ).coalesce(1)
    got = df.select(
        hotel.premium_flags()["is_premium_booking"], hotel.guest_columns()["is_upsell_opportunity"]
    ).collect()
    assert [tuple(r) for r in got] == [(False, True), (True, False), (False, None), (True, False), (True, False), (None, None)]


def test_exact_sums_do_not_depend_on_order(spark):
    df = spark.range(100_000).select((F.col("id") % 1000 / 100.0).alias("x"))
    results = {df.repartition(n).agg(numeric.exact_sum("x")).first()[0] for n in (1, 3, 7)}
    assert results == {sum(i % 1000 for i in range(100_000)) / 100.0}


def test_text_without_digits_is_not_parsed(spark):
    texts = ["FRANCE", "", " ", "NaN", "Infinity", "-inf", None, "3.0", " 4 ", "\t+8\n", "99999999999999999999", "1e2", "5d", "0x1p3", "3.5", "12", "-7.0"]
    df = spark.createDataFrame([(t, 2.0, True) for t in texts], "t string, d double, b boolean")
    got = df.select(coerce.to_int("t").alias("t"), coerce.to_int("d").alias("d"), coerce.to_int("b").alias("b"))
    assert [r.t for r in got.collect()] == [None] * 7 + [3, 4, 8, None, 100, 5, 8, None, 12, -7]
    assert {(r.d, r.b) for r in got.collect()} == {(2, 1)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" as bigint)") > 0 and "coalesce(try_cast" not in plan and "typeof" not in plan
