"""The SQL reports: premium revenue and satisfaction over curated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.numeric import (
    exact, exact_mean, exact_sum, mean, pct_where, round_half_up, rows, share_pct, share_where,
)

# Fixed value: key under which the feedback figures are joined.
ALL_SEGMENTS = "All"


def kept(bookings: DataFrame) -> DataFrame:
    return bookings.filter(~F.col("is_canceled"))


def premium_snapshot(bookings: DataFrame, snapshot_date: Column, include_canceled: bool = False) -> DataFrame:
    """Rows of the premium-revenue table. Over completed stays, as reported,
    the cancellation rate is 0; ``include_canceled`` makes it meaningful."""
    source = bookings if include_canceled else kept(bookings)
    out = source.groupBy("hotel", "market_segment", "meal_plan", "revenue_bucket").agg(
        rows().alias("total_bookings"),
        exact_sum("adr").alias("total_adr"),
        mean("adr").alias("avg_adr"),
        share_where(F.col("is_canceled")).alias("cancellation_rate"),
        share_where(F.col("is_premium_meal")).alias("premium_conversion_rate"),
    )
    return out.select(snapshot_date.alias("snapshot_date"), *out.columns)


def meal_share(bookings: DataFrame) -> DataFrame:
    """Revenue per meal plan and its share of the hotel's revenue.

    The window runs over the aggregate, one row per hotel and meal plan.
    """
    per_meal = kept(bookings).groupBy("meal_plan", "hotel").agg(
        rows().alias("bookings"), mean("adr").alias("avg_daily_rate"), F.sum(exact("adr")).alias("_paid")
    )
    hotel_paid = F.sum("_paid").over(Window.partitionBy("hotel")).cast("double")
    paid = F.col("_paid").cast("double")
    return per_meal.select(
        "meal_plan",
        "hotel",
        "bookings",
        "avg_daily_rate",
        round_half_up(paid, 0).alias("total_revenue"),
        share_pct(paid, hotel_paid).alias("pct_of_hotel_revenue"),
    ).orderBy("hotel", F.desc("total_revenue"))


def segment_stats(bookings: DataFrame) -> DataFrame:
    return bookings.groupBy("market_segment").agg(
        rows().alias("total_bookings"),
        F.count_if("is_premium_meal").alias("premium_bookings"),
        mean("adr").alias("avg_adr"),
        share_where(F.col("is_canceled")).alias("cancel_rate"),
    )


def segment_funnel(bookings: DataFrame) -> DataFrame:
    """Segments ranked by premium share; the ranked input is one row per segment."""
    stats = segment_stats(bookings).withColumn("premium_pct", share_pct("premium_bookings", "total_bookings"))
    ranked = stats.withColumn("premium_rank", F.rank().over(Window.orderBy(F.desc_nulls_first("premium_pct"))))
    return ranked.select(
        "market_segment", "total_bookings", "premium_bookings", "premium_pct", "avg_adr", "cancel_rate", "premium_rank"
    ).orderBy(F.desc("premium_pct"))


def seasonal(bookings: DataFrame) -> DataFrame:
    """Premium share per arrival month, from the parts of the arrival date."""
    return (
        kept(bookings)
        .groupBy(
            F.year("arrival_date").alias("arrival_date_year"),
            F.month("arrival_date").alias("month_num"),
            "hotel",
        )
        .agg(
            rows().alias("bookings"),
            mean("adr").alias("avg_adr"),
            pct_where(F.col("is_premium_meal")).alias("premium_pct"),
        )
        .withColumn("arrival_date_month", F.element_at(F.array(*[F.lit(m) for m in labels.MONTHS]), F.col("month_num")))
        .orderBy("arrival_date_year", "month_num", "hotel")
    )


def room_upgrade(bookings: DataFrame) -> DataFrame:
    return (
        bookings.groupBy("hotel", "room_upgrade")
        .agg(
            rows().alias("bookings"),
            mean("adr").alias("avg_adr"),
            mean("special_requests").alias("avg_special_requests"),
            pct_where(F.col("is_canceled")).alias("cancel_pct"),
        )
        .orderBy("hotel", "room_upgrade")
    )


def profile_matches(bookings: DataFrame, guests: DataFrame) -> DataFrame:
    """Size of the country x segment join, per key, without emitting its pairs."""
    left = kept(bookings).groupBy("country", "market_segment").agg(rows().alias("bookings"))
    right = guests.groupBy("country", F.col("preferred_segment").alias("market_segment")).agg(rows().alias("guests"))
    return left.join(right, ["country", "market_segment"]).withColumn("pairs", F.col("bookings") * F.col("guests"))


def loyalty_cross(bookings: DataFrame, guests: DataFrame, unique_guests: bool = False) -> DataFrame:
    """Tier x meal plan x hotel over bookings joined to guests of the same
    country and segment.

    The join pairs every booking with every such guest, billions of rows for a
    popular key. Both sides are summed per join key first, and the sums are
    multiplied: a booking counts once per guest, a guest once per booking.
    Distinct guests are counted from the rows, unless ``unique_guests`` says that
    guest_id identifies a profile row (the quality rules check that).
    """
    stays = (
        kept(bookings)
        .groupBy("country", "market_segment", "meal_plan", "hotel")
        .agg(rows().alias("n_stays"), F.sum(exact("adr")).alias("adr_sum"), F.count(exact("adr")).alias("n_adr"))
    )
    profiles = guests.groupBy("country", F.col("preferred_segment").alias("market_segment"), "loyalty_tier").agg(
        rows().alias("n_guests"),
        F.count("guest_id").alias("n_ids"),
        F.sum(exact("total_spend_eur")).alias("spend_sum"),
        F.count(exact("total_spend_eur")).alias("n_spend"),
    )
    keys = ["country", "market_segment"]
    group = ["loyalty_tier", "meal_plan", "hotel"]

    def weighted(total: str, n: str, weight: str) -> Column:
        # decimal: the number of pairs can pass 64 bits
        times = F.col(weight).cast("decimal(15,0)")
        over = F.sum(F.col(n).cast("decimal(20,0)") * times).cast("double")
        paid = F.sum(F.col(total) * times).cast("double")
        return round_half_up(F.try_divide(paid, over), 2)

    out = (
        stays.join(profiles, keys)
        .groupBy(*group)
        .agg(
            F.sum("n_ids").alias("guests"),
            weighted("adr_sum", "n_adr", "n_guests").alias("avg_adr"),
            weighted("spend_sum", "n_spend", "n_stays").alias("avg_lifetime_spend"),
        )
    )
    if not unique_guests:
        members = guests.select("country", F.col("preferred_segment").alias("market_segment"), "loyalty_tier", "guest_id")
        offers = stays.select(*keys, "meal_plan", "hotel")
        distinct = members.join(offers, keys).groupBy(*group).agg(F.count_distinct("guest_id").alias("guests"))
        out = out.drop("guests").join(distinct, group)
    return out.select(*group, "guests", "avg_adr", "avg_lifetime_spend").orderBy("loyalty_tier", F.desc("avg_adr"))


def nps_by_hotel(feedback: DataFrame) -> DataFrame:
    return feedback.groupBy("hotel_type").agg(
        mean("nps_score").alias("avg_nps"),
        pct_where(F.col("nps_category") == "Promoter").alias("promoter_pct"),
        pct_where(F.col("nps_category") == "Detractor").alias("detractor_pct"),
        mean("avg_satisfaction").alias("avg_sat"),
    )


def with_nps(per_hotel: DataFrame, feedback: DataFrame) -> DataFrame:
    """LEFT join of the feedback figures, one row per hotel; both inputs are
    aggregates, so AQE broadcasts the measured right side."""
    nps = nps_by_hotel(feedback).withColumn("scope", F.lit(ALL_SEGMENTS))
    same = (per_hotel["hotel"] == nps["hotel_type"]) & (nps["scope"] == ALL_SEGMENTS)
    return per_hotel.join(nps, same, "left").drop("hotel_type", "scope")


def satisfaction_snapshot(bookings: DataFrame, feedback: DataFrame, snapshot_date: Column) -> DataFrame:
    """Rows of the satisfaction table. Bookings are grouped before the join:
    the joined figures depend on the hotel only, so the groups are the same."""
    per_segment = bookings.groupBy("hotel", "market_segment").agg(
        mean("lead_time", 1).alias("avg_lead_time"),
        share_where(F.col("is_canceled")).alias("cancellation_rate"),
        mean("special_requests").alias("avg_special_requests"),
        share_where(F.col("is_repeated_guest")).alias("repeat_guest_rate"),
    )
    joined = with_nps(per_segment, feedback)
    return joined.select(
        snapshot_date.alias("snapshot_date"),
        *per_segment.columns,
        F.col("avg_nps").alias("avg_nps_score"),
        "promoter_pct",
        "detractor_pct",
        F.col("avg_sat").alias("avg_satisfaction"),
    )


def lead_cancel(bookings: DataFrame) -> DataFrame:
    out = bookings.groupBy("hotel", labels.lead_days_bucket().alias("lead_time_bucket")).agg(
        rows().alias("bookings"),
        F.count_if("is_canceled").alias("canceled"),
        pct_where(F.col("is_canceled")).alias("cancellation_pct"),
        mean("adr").alias("avg_adr"),
    )
    return out.orderBy("hotel", labels.ordinal("lead_time_bucket", labels.label_order(labels.LEAD_DAYS)))


def special_requests(bookings: DataFrame) -> DataFrame:
    return (
        bookings.groupBy("hotel", "special_requests")
        .agg(
            rows().alias("bookings"),
            pct_where(F.col("is_canceled")).alias("cancel_pct"),
            mean("adr").alias("avg_adr"),
        )
        .orderBy("hotel", "special_requests")
    )


def deposit(bookings: DataFrame) -> DataFrame:
    return (
        bookings.groupBy("hotel", "deposit_type")
        .agg(
            rows().alias("bookings"),
            pct_where(F.col("is_canceled")).alias("cancel_pct"),
            mean("lead_time", 1).alias("avg_lead_time"),
            mean("adr").alias("avg_adr"),
            mean("special_requests").alias("avg_special_requests"),
        )
        .orderBy("hotel", F.desc("cancel_pct"))
    )


def nps_by_channel(feedback: DataFrame) -> DataFrame:
    return (
        feedback.groupBy("hotel_type", "package_name", "booking_channel")
        .agg(
            rows().alias("responses"),
            mean("nps_score", 1).alias("avg_nps"),
            pct_where(F.col("nps_category") == "Promoter").alias("promoter_pct"),
            pct_where(F.col("nps_category") == "Detractor").alias("detractor_pct"),
            mean("avg_satisfaction").alias("avg_satisfaction"),
        )
        .orderBy("hotel_type", F.desc("avg_nps"))
    )


def repeat_guests(bookings: DataFrame) -> DataFrame:
    return (
        bookings.groupBy("hotel", "is_repeated_guest")
        .agg(
            mean("lead_time", 1).alias("avg_lead_time"),
            mean("adr").alias("avg_adr"),
            mean("special_requests").alias("avg_special_requests"),
            mean("booking_changes").alias("avg_changes"),
            pct_where(F.col("is_canceled")).alias("cancel_pct"),
            rows().alias("bookings"),
        )
        .orderBy("hotel", "is_repeated_guest")
    )


def waiting_list(bookings: DataFrame) -> DataFrame:
    return (
        bookings.groupBy("hotel", labels.wait_bucket().alias("wait_bucket"))
        .agg(
            rows().alias("bookings"),
            mean("adr").alias("avg_adr"),
            pct_where(F.col("is_canceled")).alias("cancel_pct"),
        )
        .orderBy("hotel", "wait_bucket")
    )


def premium_by_meal(bookings: DataFrame) -> DataFrame:
    """Completed stays per hotel and meal: count, mean rate, premium count."""
    return kept(bookings).groupBy("hotel", "meal_plan").agg(
        F.count("adr").alias("total_bookings"),
        exact_mean("adr").alias("avg_adr"),
        F.count_if("is_premium_meal").alias("premium_count"),
    )


def cancellation_by_hotel(bookings: DataFrame) -> DataFrame:
    return bookings.groupBy("hotel").agg(
        F.try_divide(F.count_if("is_canceled"), rows()).alias("cancellation_rate"),
        F.avg("lead_time").alias("avg_lead_time"),
    )


# -- JSON export ------------------------------------------------------------

# Tags and keys of the exported objects, and the stamp format.
PREMIUM_TAG, SATISFACTION_TAG = "BO1", "BO2"
PREMIUM_KEYS = (
    "hotel", "market_segment", "meal_plan", "revenue_bucket", "total_bookings", "avg_adr", "cancellation_rate",
    "premium_conversion_rate",
)
SATISFACTION_KEYS = (
    "hotel", "market_segment", "avg_lead_time", "cancellation_rate", "avg_special_requests", "repeat_guest_rate",
    "avg_nps_score", "promoter_pct", "detractor_pct", "avg_satisfaction",
)
STAMP = "yyyy-MM-dd HH:mm:ss"


def json_export(snapshot: DataFrame, tag: str, keys: tuple[str, ...], generated_at: Column) -> DataFrame:
    """One JSON object per row; keys whose value is NULL are left out."""
    stamp = F.date_format(generated_at, STAMP).alias("generated_at")
    return snapshot.select(F.lit(tag).alias("export_type"), F.to_json(F.struct(stamp, *keys)).alias("payload"))


def premium_json(snapshot: DataFrame, generated_at: Column) -> DataFrame:
    return json_export(snapshot, PREMIUM_TAG, PREMIUM_KEYS, generated_at)


def satisfaction_json(snapshot: DataFrame, generated_at: Column) -> DataFrame:
    return json_export(snapshot, SATISFACTION_TAG, SATISFACTION_KEYS, generated_at)


#: Types of the values in the exported objects; all other keys are text.
EXPORT_TYPES = {"total_bookings": "bigint"} | dict.fromkeys((*PREMIUM_KEYS[5:], *SATISFACTION_KEYS[2:]), "double")


def read_export(exports: DataFrame, tag: str, keys: tuple[str, ...]) -> DataFrame:
    """The objects of one tag as columns again, ``generated_at`` first.

    The text becomes a VARIANT once per row; keys that were left out are NULL, and so is
    everything of a text that is no JSON. A value of another type than declared is an error.
    """
    parsed = exports.filter(F.col("export_type") == tag).withColumn("_object", F.try_parse_json("payload"))
    wanted = ("generated_at", *keys)
    return parsed.select(*[F.variant_get("_object", f"$.{k}", EXPORT_TYPES.get(k, "string")).alias(k) for k in wanted])


def export_structure(exports: DataFrame, required: dict[str, tuple[str, ...]]) -> DataFrame:
    """Per tag: objects, texts that are no objects, objects without one of the required keys, and the verdict.

    A tag without any object fails too.
    """
    tags = exports.sparkSession.createDataFrame([(t, list(k)) for t, k in required.items()], "export_type string, keys array<string>")
    held = F.json_object_keys("payload")
    seen = exports.join(tags, "export_type").select(
        "export_type", held.isNull().alias("broken"), (F.size(F.array_except("keys", F.coalesce(held, F.array()))) > 0).alias("lacking")
    )
    counted = seen.groupBy("export_type").agg(
        rows().alias("objects"), F.count_if("broken").alias("broken"), F.count_if("lacking").alias("lacking")
    )
    zero = F.lit(0).cast("bigint")
    whole = tags.join(counted, "export_type", "left").select("export_type", *[F.coalesce(c, zero).alias(c) for c in ("objects", "broken", "lacking")])
    return whole.withColumn("passed", (F.col("objects") > 0) & (F.col("broken") == 0) & (F.col("lacking") == 0))


def rows_per_type(exports: DataFrame) -> DataFrame:
    return exports.groupBy("export_type").agg(rows().alias("n"))
