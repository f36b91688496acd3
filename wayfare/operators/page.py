"""Data behind the report page: matrices, shares, comparison table, tiles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.numeric import mean, pct_where, rows, share_pct
from .curated import fits as fits_curated
from .curated import shaped as shape_curated
from .reports import kept, nps_by_hotel, segment_funnel

# The page's hotels and their column names, NPS column names. Another
# mapping can be given; a hotel outside it is an error, never left out.
HOTELS = {"City Hotel": "city", "Resort Hotel": "resort"}
NPS_COLUMNS = {"Promoter": "promoter_pct", "Passive": "passive_pct", "Detractor": "detractor_pct"}
# The page labels the opportunity by hand; these limits on the premium share
# are our own rule (see README) and can be replaced.
OPPORTUNITY = ((22.0, "High"), (15.0, "Medium"), (10.0, "Low"), (None, "None"))
# metric -> is a lower figure better
METRICS = {
    "cancellation_pct": True,
    "avg_lead_time": True,
    "repeat_guest_pct": False,
    "avg_nps": False,
    "avg_special_requests": True,
    "avg_satisfaction": False,
}


def listed(hotels: Mapping[str, str], column: str = "hotel") -> Column:
    """The hotel, or an error where it is not in the list."""
    unknown = F.raise_error(F.concat(F.lit("hotel not in the list: "), F.coalesce(F.col(column), F.lit("NULL")))).cast("string")
    return F.when(F.col(column).isin(*hotels), F.col(column)).otherwise(unknown)


def _by_hotel(df: DataFrame, key: str | Column, figure: Column, hotels: Mapping[str, str]) -> DataFrame:
    out = df.withColumn("hotel", listed(hotels)).groupBy(key).pivot("hotel", list(hotels)).agg(figure)
    return out.withColumnsRenamed(dict(hotels))


def meal_adr_by_hotel(bookings: DataFrame, hotels: Mapping[str, str] = HOTELS) -> DataFrame:
    return _by_hotel(kept(bookings), "meal_plan", mean("adr"), hotels).orderBy("meal_plan")


def segment_rates(bookings: DataFrame) -> DataFrame:
    return (
        bookings.groupBy("market_segment")
        .agg(
            pct_where(F.col("is_premium_meal")).alias("premium_pct"),
            pct_where(F.col("is_canceled")).alias("cancel_pct"),
        )
        .orderBy("market_segment")
    )


def monthly_premium_vs_standard(bookings: DataFrame) -> DataFrame:
    return (
        kept(bookings)
        .groupBy(F.month("arrival_date").alias("month_num"))
        .pivot("is_premium_meal", [True, False])
        .agg(mean("adr"))
        .withColumnsRenamed({"true": "premium_adr", "false": "standard_adr"})
        .orderBy("month_num")
    )


def revenue_bucket_share(bookings: DataFrame) -> DataFrame:
    counts = bookings.groupBy("revenue_bucket").agg(rows().alias("bookings"))
    whole = counts.agg(F.sum("bookings").alias("n")).scalar()
    return counts.select("revenue_bucket", "bookings", share_pct("bookings", whole).alias("share_pct")).orderBy(
        labels.ordinal("revenue_bucket", labels.label_order(labels.REVENUE))
    )


def lead_cancel_matrix(bookings: DataFrame, hotels: Mapping[str, str] = HOTELS) -> DataFrame:
    out = _by_hotel(
        bookings, labels.lead_days_bucket().alias("lead_time_bucket"), pct_where(F.col("is_canceled")), hotels
    )
    return out.orderBy(labels.ordinal("lead_time_bucket", labels.label_order(labels.LEAD_DAYS)))


def nps_by_package(feedback: DataFrame) -> DataFrame:
    counts = feedback.groupBy("package_name").pivot("nps_category", list(NPS_COLUMNS)).agg(rows()).fillna(0)
    whole = sum((F.col(c) for c in NPS_COLUMNS), F.lit(0))
    shares = [share_pct(c, whole).alias(name) for c, name in NPS_COLUMNS.items()]
    return counts.select("package_name", *shares).orderBy("package_name")


def deposit(bookings: DataFrame) -> DataFrame:
    return (
        bookings.groupBy("deposit_type")
        .agg(pct_where(F.col("is_canceled")).alias("cancel_pct"), mean("adr").alias("avg_adr"))
        .orderBy("deposit_type")
    )


def repeat(bookings: DataFrame) -> DataFrame:
    return (
        bookings.groupBy("is_repeated_guest")
        .agg(
            pct_where(F.col("is_canceled")).alias("cancel_pct"),
            mean("adr").alias("avg_adr"),
            mean("lead_time", 1).alias("avg_lead_time"),
        )
        .orderBy("is_repeated_guest")
    )


def opportunity(premium_pct: str | Column = "premium_pct", limits: tuple = OPPORTUNITY) -> Column:
    return labels.bucketize(premium_pct, limits, lambda x, bound: x >= bound)


def segment_table(bookings: DataFrame, limits: tuple = OPPORTUNITY) -> DataFrame:
    return segment_funnel(bookings).withColumn("opportunity", opportunity(limits=limits))


def hotel_compare(bookings: DataFrame, feedback: DataFrame, hotels: Mapping[str, str] = HOTELS) -> DataFrame:
    """Metric x hotel with the better hotel; long form, then one column each."""
    stays = bookings.groupBy(listed(hotels).alias("hotel")).agg(
        pct_where(F.col("is_canceled")).alias("cancellation_pct"),
        mean("lead_time", 1).alias("avg_lead_time"),
        pct_where(F.col("is_repeated_guest")).alias("repeat_guest_pct"),
        mean("special_requests").alias("avg_special_requests"),
    )
    voices = nps_by_hotel(feedback).select(
        F.col("hotel_type").alias("hotel"), "avg_nps", F.col("avg_sat").alias("avg_satisfaction")
    )
    long = stays.join(voices, "hotel", "left").unpivot("hotel", list(METRICS), "metric", "figure")
    wide = long.groupBy("metric").pivot("hotel", list(hotels)).agg(F.max("figure"))
    lower_is_better = F.col("metric").isin([m for m, lower in METRICS.items() if lower])
    figures = [F.col(f"`{h}`") for h in hotels]
    # hotels with the best figure; NULL figures take no part
    best_figure = F.when(lower_is_better, F.least(*figures)).otherwise(F.greatest(*figures))
    winners = F.filter(F.array(*[F.when(x == best_figure, F.lit(h)) for h, x in zip(hotels, figures)]), lambda h: h.isNotNull())
    complete = F.forall(F.array(*figures), lambda x: x.isNotNull())
    best = F.when(complete, F.when(F.size(winners) == 1, F.get(winners, F.lit(0))).otherwise("Equal"))
    return wide.withColumn("best", best).withColumnsRenamed(dict(hotels))


def kpi_tiles(raw: DataFrame, feedback: DataFrame, hotels: Mapping[str, str] = HOTELS) -> DataFrame:
    """All tiles in one row, from one scan of the raw bookings.

    Totals, months and segments are grouping sets of one aggregate, whose few rows a
    second one folds into the tiles: the first month, and the first segment by name,
    among equals. The mean of the feedback's scores comes as a scalar subquery.
    """
    fits = F.coalesce(fits_curated(), F.lit(False))
    premium, stayed = F.col("is_premium_meal"), ~F.col("is_canceled")

    def share(condition: Column) -> Column:
        return share_pct(F.count_if(fits & condition), F.count_if(fits))

    def mean_of(column: str, digits: int = 2) -> Column:
        return mean(F.when(fits, F.col(column)), digits)

    def adr_where(condition: Column) -> Column:
        return mean(F.when(fits & stayed & condition, F.col("adr")))

    totals = {
        "curated_rows": F.count_if(fits),
        "premium_conversion_pct": share(premium),
        "cancellation_pct": share(F.col("is_canceled")),
        "avg_lead_time": mean_of("lead_time", 0),
        "repeat_guest_pct": share(F.col("is_repeated_guest")),
        "avg_special_requests": mean_of("special_requests"),
        "premium_adr": adr_where(premium),
        "standard_adr": adr_where(~premium),
        **{f"{label}_premium_adr": adr_where(premium & (F.col("hotel") == hotel)) for hotel, label in hotels.items()},
        "raw_rows": rows(),
    }
    shaped = shape_curated(raw).withColumn("month", F.month("arrival_date"))
    cube = shaped.groupingSets([[], ["month"], ["market_segment"]], "month", "market_segment").agg(
        F.grouping_id().alias("_id"), *[c.alias(n) for n, c in totals.items()]
    )
    of_all, of_month, of_segment = (F.col("_id") == k for k in (3, 1, 2))

    def best(condition: Column, key: str, figure: str) -> Column:
        known = condition & F.col(key).isNotNull() & F.col(figure).isNotNull()
        return F.min_by(F.struct(F.col(key).alias("k"), F.col(figure).alias("v")), F.when(known, F.struct((-F.col(figure)).alias("a"), key)))

    tiles = cube.agg(
        F.max(F.when(of_all, F.struct(*totals))).alias("_all"),
        best(of_month, "month", "premium_adr").alias("_peak"),
        best(of_segment, "market_segment", "premium_conversion_pct").alias("_top"),
    )
    counts, none = ("curated_rows", "raw_rows"), F.lit(0).cast("bigint")
    return tiles.select(
        *[(F.coalesce(F.col("_all")[n], none) if n in counts else F.col("_all")[n]).alias(n) for n in totals],
        F.col("_peak.k").alias("peak_month"),
        F.col("_peak.v").alias("peak_month_adr"),
        F.col("_top.k").alias("top_segment"),
        F.col("_top.v").alias("top_segment_pct"),
        feedback.agg(mean("nps_score", 1).alias("n")).scalar().alias("avg_nps"),
    )
