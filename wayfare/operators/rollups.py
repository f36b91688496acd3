"""Roll-ups of the KPI tables for the dashboards.

Additive measures are re-aggregated; means of group means are unweighted, as
the dashboards show them, with a weighted variant where one is offered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.dates import year_month
from ..functions.numeric import exact, exact_mean, exact_sum, ratio_pct, round_half_up
from . import kpi_flight as kpi_flight_tables
from . import kpi_hotel as kpi_hotel_tables
from .kpi import SET, in_one_pass

# Left out of the segment chart; number of routes listed; colour limits.
NO_CHARGE_SEGMENT = "Complementary"
TOP_ROUTES = 8
ADR_LIMITS = (110, 80)
NO_SHOW_LIMITS = (5.5, 5.0)
CHECKIN_LIMITS = (5.5, 4.8)


def month_label() -> Column:
    return year_month("arrival_date_year", "arrival_month_num").alias("year_month")


def weighted_mean(value: str, weight: str) -> Column:
    """Exact sum(value * weight) / sum(weight) over rows with a value."""
    total = F.sum(exact(value) * F.col(weight)).cast("double")
    return F.try_divide(total, F.sum(F.when(exact(value).isNotNull(), F.col(weight))))


# -- hotel ------------------------------------------------------------------


def monthly_meal_revenue(by_package: DataFrame) -> DataFrame:
    return (
        by_package.groupBy(month_label(), "meal")
        .agg(exact_sum("total_revenue").alias("total_revenue"))
        .orderBy("year_month", "meal")
    )


def monthly_conversion(conversion: DataFrame) -> DataFrame:
    return (
        conversion.groupBy(month_label())
        .agg(
            F.sum("total_bookings").alias("total_bookings"),
            F.sum("premium_bookings").alias("premium_bookings"),
            exact_sum("total_revenue").alias("total_revenue"),
            exact_sum("premium_revenue").alias("premium_revenue"),
        )
        .withColumns(
            {
                "premium_conversion_pct": ratio_pct("premium_bookings", "total_bookings", 1),
                "premium_revenue_pct": ratio_pct("premium_revenue", "total_revenue", 1),
            }
        )
        .orderBy("year_month")
    )


def loyalty(by_loyalty: DataFrame, weighted: bool = False) -> DataFrame:
    adr = weighted_mean("avg_adr", "total_bookings") if weighted else exact_mean("avg_adr")
    return (
        by_loyalty.filter(F.col("g_loyalty_tier").isNotNull())
        .groupBy("g_loyalty_tier")
        .agg(
            F.sum("total_bookings").alias("total_bookings"),
            F.sum("premium_bookings").alias("premium_bookings"),
            exact_sum("total_revenue").alias("total_revenue"),
            adr.alias("avg_adr"),
        )
        .withColumns(
            {
                "premium_rate_pct": ratio_pct("premium_bookings", "total_bookings", 1),
                "tier_order": labels.ordinal("g_loyalty_tier", labels.TIER_ORDER),
            }
        )
        .orderBy("tier_order")
    )


def segment_adr(by_segment: DataFrame) -> DataFrame:
    """ADR and revenue per charged segment, with the mean line of the chart.

    The mean is a scalar subquery: one value, no window over the whole table.
    """
    per_segment = (
        by_segment.filter(F.col("market_segment") != NO_CHARGE_SEGMENT)
        .groupBy("market_segment")
        .agg(exact_mean("avg_adr").alias("avg_adr"), exact_sum("total_revenue").alias("total_revenue"))
    )
    line = per_segment.agg(round_half_up(exact_mean("avg_adr"), 2).alias("m")).scalar()
    return per_segment.select("*", line.alias("overall_avg_adr")).orderBy("avg_adr")


def room(by_room: DataFrame) -> DataFrame:
    return (
        by_room.groupBy("reserved_room_type", "is_premium_room")
        .agg(exact_mean("avg_adr").alias("avg_adr"), exact_sum("total_revenue").alias("total_revenue"))
        .orderBy(F.desc("avg_adr"))
    )


def upsell(opportunity: DataFrame) -> DataFrame:
    return (
        opportunity.filter(F.col("g_loyalty_tier").isNotNull())
        .groupBy("g_loyalty_tier")
        .agg(
            F.sum("standard_bookings").alias("standard_bookings"),
            # a pandas-style sum: zero when no group has an estimate
            F.coalesce(exact_sum("estimated_uplift_30pct"), F.lit(0.0)).alias("estimated_uplift"),
        )
        .withColumn("tier_order", labels.ordinal("g_loyalty_tier", labels.TIER_ORDER))
        .orderBy("tier_order")
    )


def _labelled(tables: dict[str, DataFrame]) -> DataFrame:
    """Stored KPI tables in the form of a common pass."""
    (first, table), *others = tables.items()
    out = table.withColumn(SET, F.lit(first))
    for name, other in others:
        out = out.unionByName(other.withColumn(SET, F.lit(name)), allowMissingColumns=True)
    return out


def kpi_hotel(cube: DataFrame) -> DataFrame:
    """The cards: totals, premium shares, standard stays that could be upsold.

    One aggregate over the rows of both KPI tables, each figure from its own.
    """
    converted = F.col(SET) == "premium_conversion"
    target = (F.col(SET) == "upsell_opportunity") & F.col("g_loyalty_tier").isNotNull()
    of = lambda c: F.when(converted, F.col(c))
    totals = cube.agg(
        exact_sum(of("total_revenue")).alias("total_revenue"),
        exact_sum(of("premium_revenue")).alias("premium_revenue"),
        F.sum(of("total_bookings")).alias("total_bookings"),
        F.sum(of("premium_bookings")).alias("premium_bookings"),
        F.sum(F.when(target, F.col("standard_bookings"))).alias("upsell_targets"),
    )
    return totals.withColumns(
        {"premium_revenue_pct": ratio_pct("premium_revenue", "total_revenue"), "premium_conversion_pct": ratio_pct("premium_bookings", "total_bookings")}
    )


def kpi_hotel_stored(conversion: DataFrame, opportunity: DataFrame) -> DataFrame:
    return kpi_hotel(_labelled({"premium_conversion": conversion, "upsell_opportunity": opportunity}))


def kpi_hotel_from(stays: DataFrame) -> DataFrame:
    """The cards from silver, which is read once."""
    wanted = kpi_hotel_tables.kpis()
    return kpi_hotel(in_one_pass(stays, {n: wanted[n] for n in ("premium_conversion", "upsell_opportunity")}))


# -- flight -----------------------------------------------------------------


def kpi_flight(cube: DataFrame) -> DataFrame:
    """Totals; satisfaction weighted by passengers; share of no-shows. One aggregate over both KPI tables."""
    of = lambda table, c: F.when(F.col(SET) == table, c)
    seated = lambda c: of("satisfaction_by_segment", F.col(c))
    booked = lambda c: of("noshow_by_booking_pattern", F.col(c))
    weighted = of("satisfaction_by_segment", exact("avg_satisfaction") * F.col("passengers"))
    return cube.agg(
        F.sum(seated("passengers")).alias("total_passengers"),
        # rows without a score weigh in the divisor, as in the card's formula
        round_half_up(F.try_divide(F.sum(weighted).cast("double"), F.sum(seated("passengers"))), 4).alias("avg_satisfaction"),
        F.sum(seated("satisfied_count")).alias("satisfied_count"),
        F.sum(seated("dissatisfied_count")).alias("dissatisfied_count"),
        F.sum(booked("no_shows")).alias("total_no_shows"),
        F.try_divide(F.sum(booked("no_shows")), F.sum(booked("passengers"))).alias("overall_no_show"),
    )


def kpi_flight_stored(by_segment: DataFrame, no_show: DataFrame) -> DataFrame:
    return kpi_flight(_labelled({"satisfaction_by_segment": by_segment, "noshow_by_booking_pattern": no_show}))


def kpi_flight_from(flown: DataFrame) -> DataFrame:
    """The cards from silver, which is read once."""
    wanted = kpi_flight_tables.kpis()
    return kpi_flight(in_one_pass(flown, {n: wanted[n] for n in ("satisfaction_by_segment", "noshow_by_booking_pattern")}))


def flight_tier(by_segment: DataFrame) -> DataFrame:
    return (
        by_segment.filter(F.col("p_frequent_flyer_status").isNotNull())
        .groupBy("p_frequent_flyer_status")
        .agg(
            F.sum("passengers").alias("passengers"),
            exact_mean("avg_satisfaction").alias("avg_satisfaction"),
            exact_mean("no_show_rate").alias("no_show_rate"),
            F.sum("satisfied_count").alias("satisfied_count"),
            F.sum("dissatisfied_count").alias("dissatisfied_count"),
        )
        .withColumns(
            {
                "satisfaction_rate_pct": ratio_pct("satisfied_count", "passengers", 1),
                "order": labels.ordinal("p_frequent_flyer_status", labels.FLYER_ORDER),
            }
        )
        .orderBy("order")
    )


def band_share(bands: DataFrame) -> DataFrame:
    """Counts per satisfaction band with their share of all rows."""
    whole = bands.agg(F.sum("n").alias("n")).scalar()
    return bands.select(
        "satisfaction_band",
        "n",
        round_half_up(F.try_divide(F.lit(100.0) * F.col("n"), whole), 2).alias("share_pct"),
        labels.ordinal("satisfaction_band", labels.label_order(labels.SATISFACTION_BAND)).alias("order"),
    ).orderBy("order")


def noshow_bucket(no_show: DataFrame) -> DataFrame:
    return (
        no_show.groupBy("booking_bucket")
        .agg(
            F.sum("passengers").alias("passengers"),
            F.sum("no_shows").alias("no_shows"),
            exact_mean("avg_satisfaction").alias("avg_satisfaction"),
        )
        .withColumns(
            {
                "no_show_rate": ratio_pct("no_shows", "passengers"),
                "order": labels.ordinal("booking_bucket", labels.label_order(labels.BOOKING_AHEAD)),
            }
        )
        .orderBy("order")
    )


def checkin(friction: DataFrame) -> DataFrame:
    return (
        friction.filter(F.col("Check_in_Method").isNotNull())
        .groupBy("Check_in_Method")
        .agg(
            F.sum("passengers").alias("passengers"),
            F.sum("no_shows").alias("no_shows"),
            exact_mean("avg_satisfaction").alias("avg_satisfaction"),
            F.sum("satisfied_count").alias("satisfied_count"),
        )
        .withColumns(
            {
                "no_show_rate": ratio_pct("no_shows", "passengers"),
                "satisfaction_rate": ratio_pct("satisfied_count", "passengers"),
            }
        )
        .orderBy(F.desc("no_show_rate"))
    )


def delay(delays: DataFrame) -> DataFrame:
    return (
        delays.groupBy("delay_bucket")
        .agg(
            F.sum("flights").alias("flights"),
            exact_mean("avg_satisfaction").alias("avg_satisfaction"),
            exact_mean("no_show_rate").alias("no_show_rate"),
            F.sum("dissatisfied_count").alias("dissatisfied_count"),
        )
        .withColumn("order", labels.ordinal("delay_bucket", labels.label_order(labels.DELAY)))
        .orderBy("order")
    )


def seat_class(by_segment: DataFrame) -> DataFrame:
    return (
        by_segment.filter(F.col("Seat_Class").isNotNull())
        .groupBy("Seat_Class")
        .agg(
            F.sum("passengers").alias("passengers"),
            exact_mean("avg_satisfaction").alias("avg_satisfaction"),
            exact_mean("no_show_rate").alias("no_show_rate"),
            exact_mean("avg_price_paid").alias("avg_price_paid"),
        )
        .orderBy(F.desc("avg_satisfaction"))
    )


def top_routes(by_route: DataFrame, n: int = TOP_ROUTES) -> DataFrame:
    """Best routes; equal scores by route id, so that the list is stable."""
    return by_route.orderBy(F.desc_nulls_last("avg_satisfaction"), "r_route_id").limit(n)


def bottom_routes(by_route: DataFrame, n: int = TOP_ROUTES) -> DataFrame:
    return by_route.orderBy(F.asc_nulls_last("avg_satisfaction"), "r_route_id").limit(n)


def adr_colour(value: str | Column = "avg_adr") -> Column:
    return labels.threshold_band(value, *ADR_LIMITS, ("premium", "revenue", "standard"), inclusive=True)


def no_show_colour(value: str | Column = "no_show_rate", limits: tuple[float, float] = NO_SHOW_LIMITS) -> Column:
    return labels.threshold_band(value, *limits, ("dissatisfied", "neutral", "satisfied"), inclusive=False)
