"""Hotel KPI tables over completed stays of the silver table.

Percentages and per-booking figures are computed from the rounded measures, as
the reports define them. Every aggregate is combined in the map tasks first, so
a segment holding a third of all stays costs one partial row per task.
No table is sorted before it is written; ``by`` orders a result for reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_sum, mean, ratio_pct, round_half_up, rows, tally
from .kpi import Kpi

# Report constants.
UPLIFT_RATE = 0.30
UNDEFINED_SEGMENT = "Undefined"

# Columns that the tables only sum, as they are.
SUMMED = ("adr", "total_nights", "total_revenue", "p_base_price", "price_gap_per_night", "g_lifetime_spend", "total_of_special_requests")

# -- measures shared by the tables ------------------------------------------


def adr() -> Column:
    return mean("adr").alias("avg_adr")


def nights() -> Column:
    return mean("total_nights").alias("avg_nights")


def revenue() -> Column:
    return exact_sum("total_revenue").alias("total_revenue")


def list_price() -> Column:
    return mean("p_base_price").alias("avg_catalogue_price")


def price_gap() -> Column:
    return mean("price_gap_per_night").alias("avg_price_gap")


def bookings() -> Column:
    return rows().alias("total_bookings")


def premium() -> Column:
    return tally("is_premium_booking").alias("premium_bookings")


def premium_revenue() -> Column:
    paid = F.when(F.col("is_premium_booking"), F.col("total_revenue")).otherwise(F.lit(0))
    return exact_sum(paid).alias("premium_revenue")


def month_keys() -> list:
    return ["arrival_date_year", "arrival_date_month", F.month("arrival_date").alias("arrival_month_num")]


def summarise(df: DataFrame, keys: Sequence, measures: Sequence[Column], derived: dict[str, Column] | None = None) -> DataFrame:
    """Group, measure, then derive from the rounded measures."""
    out = df.groupBy(*keys).agg(*measures)
    return out.withColumns(derived) if derived else out


def per_booking() -> Column:
    return round_half_up(F.try_divide("total_revenue", "total_bookings"), 2)


def premium_rate() -> Column:
    return ratio_pct("premium_bookings", "total_bookings")


def defined_segment(df: DataFrame) -> DataFrame:
    """Rows of a named segment; a missing one is dropped too."""
    return df.filter(is_defined_segment())


def is_defined_segment() -> Column:
    return F.col("market_segment") != UNDEFINED_SEGMENT


def standard_only(df: DataFrame) -> DataFrame:
    return df.filter(is_standard())


def is_standard() -> Column:
    return ~F.col("is_premium_booking")


def uplift() -> Column:
    """What 30 % of the standard stays would add at list price."""
    return round_half_up(F.col("standard_bookings") * F.lit(UPLIFT_RATE) * F.col("avg_price_gap") * F.col("avg_nights"), 2)


def kpis() -> dict[str, Kpi]:
    """The six tables."""
    return {
        "revenue_by_package": Kpi(
            [*month_keys(), "meal", "is_premium_meal", "hotel"],
            [rows().alias("bookings"), adr(), nights(), revenue(), list_price(), price_gap()],
        ),
        "premium_conversion": Kpi(
            [*month_keys(), "hotel"],
            [
                bookings(),
                premium(),
                tally("is_premium_meal").alias("premium_meal_bookings"),
                tally("is_premium_room").alias("premium_room_bookings"),
                revenue(),
                premium_revenue(),
                adr(),
            ],
            lambda: {
                "premium_conversion_pct": premium_rate(),
                "premium_revenue_pct": ratio_pct("premium_revenue", "total_revenue"),
            },
        ),
        "revenue_by_loyalty": Kpi(
            ["g_loyalty_tier", "hotel"],
            [
                bookings(),
                premium(),
                adr(),
                nights(),
                revenue(),
                mean("g_lifetime_spend").alias("avg_lifetime_spend"),
                tally("is_upsell_opportunity").alias("upsell_opportunities"),
            ],
            lambda: {"premium_rate_pct": premium_rate(), "revenue_per_booking": per_booking()},
        ),
        "revenue_by_segment": Kpi(
            ["market_segment", "hotel"],
            [
                bookings(),
                premium(),
                adr(),
                nights(),
                revenue(),
                mean("total_of_special_requests").alias("avg_special_requests"),
            ],
            lambda: {"premium_rate_pct": premium_rate(), "revenue_per_booking": per_booking()},
            only=is_defined_segment,
            only_by=["market_segment"],
        ),
        "upsell_opportunity": Kpi(
            ["g_loyalty_tier", "hotel", "meal", "guest_value_segment"],
            [
                rows().alias("standard_bookings"),
                mean("adr").alias("avg_current_adr"),
                list_price(),
                exact_sum("total_revenue").alias("current_revenue"),
                price_gap(),
                nights(),
            ],
            lambda: {"estimated_uplift_30pct": uplift()},
            only=is_standard,
            only_by=["is_premium_booking"],
        ),
        "revenue_by_room": Kpi(
            ["reserved_room_type", "is_premium_room", "hotel"],
            [bookings(), adr(), nights(), revenue(), tally("was_upgraded").alias("upgrades_received"), list_price()],
            lambda: {
                "upgrade_rate_pct": ratio_pct("upgrades_received", "total_bookings"),
                "revenue_per_booking": per_booking(),
            },
        ),
    }


def revenue_by_package(stays: DataFrame) -> DataFrame:
    return kpis()["revenue_by_package"].build(stays)


def premium_conversion(stays: DataFrame) -> DataFrame:
    return kpis()["premium_conversion"].build(stays)


def revenue_by_loyalty(stays: DataFrame) -> DataFrame:
    return kpis()["revenue_by_loyalty"].build(stays)


def revenue_by_segment(stays: DataFrame) -> DataFrame:
    return kpis()["revenue_by_segment"].build(stays)


def upsell_opportunity(stays: DataFrame) -> DataFrame:
    """Standard stays per tier, and what 30 % of them would add at list price."""
    return kpis()["upsell_opportunity"].build(stays)


def revenue_by_room(stays: DataFrame) -> DataFrame:
    return kpis()["revenue_by_room"].build(stays)


TABLES = {
    "revenue_by_package": revenue_by_package,
    "premium_conversion": premium_conversion,
    "revenue_by_loyalty": revenue_by_loyalty,
    "revenue_by_segment": revenue_by_segment,
    "upsell_opportunity": upsell_opportunity,
    "revenue_by_room": revenue_by_room,
}
# reading order of each table; "-" is descending
ORDER = {
    "revenue_by_package": ("arrival_date_year", "arrival_month_num", "meal"),
    "premium_conversion": ("arrival_date_year", "arrival_month_num"),
    "revenue_by_segment": ("-avg_adr",),
    "revenue_by_room": ("-avg_adr",),
}


def sort_columns(order: Sequence[str]) -> list[Column]:
    return [F.desc(c[1:]) if c.startswith("-") else F.col(c) for c in order]


def by(name: str, table: DataFrame) -> DataFrame:
    return table.orderBy(*sort_columns(ORDER[name])) if name in ORDER else table


def headline(stays: DataFrame) -> DataFrame:
    return stays.agg(bookings(), revenue(), premium_revenue(), premium())


def by_meal(stays: DataFrame) -> DataFrame:
    out = summarise(stays, ["meal"], [rows().alias("bookings"), adr(), revenue()])
    return out.orderBy(F.desc("total_revenue"))


def by_tier(stays: DataFrame) -> DataFrame:
    measures = [rows().alias("bookings"), adr(), revenue(), tally("is_premium_booking").alias("premium")]
    return summarise(stays, ["g_loyalty_tier"], measures).orderBy(F.desc("total_revenue"))


def table_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table; one counting pass per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("cols")
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
