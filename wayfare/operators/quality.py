"""Data quality checks and profiles.

A check is one row ``(dataset, check, passed, observed, expected)``. All checks
that are plain aggregates share a single scan; only uniqueness and duplicate
counts, which need a grouping, take one more each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import to_float
from ..functions.content import content_key
from ..functions.numeric import finite, round_half_up

# ---------------------------------------------------------------------------
# What each dataset is checked for.
# ---------------------------------------------------------------------------
BOOKING_COLUMNS = (
    "hotel", "is_canceled", "lead_time", "arrival_date_year", "arrival_date_month", "arrival_date_day_of_month",
    "stays_in_weekend_nights", "stays_in_week_nights", "adults", "meal", "country", "market_segment",
    "distribution_channel", "adr", "reservation_status",
)
HOTELS = ("City Hotel", "Resort Hotel")
MEALS = ("BB", "HB", "FB", "SC", "Undefined", "")
TIERS = ("Bronze", "Silver", "Gold", "Platinum")
MIN_BOOKINGS, PROFILE_ROWS, CATALOGUE_ROWS, FEEDBACK_ROWS = 100_000, 5_000, 8, 8_000
YEARS = (2015, 2020)
MAX_DUPLICATE_SHARE, MAX_PLATINUM_SHARE = 0.01, 0.10
PREMIUM_PACKAGE, STANDARD_PACKAGE = "Premium All-Inclusive", "Standard"
SCORES = ("checkin_satisfaction", "room_satisfaction", "food_satisfaction", "value_for_money")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """``observed`` is an aggregate, ``passed`` a condition on such aggregates.

    ``column`` is what it reads: without that column the check fails.
    """

    name: str
    observed: Column
    passed: Column
    expected: str
    column: str | None = None


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def required_columns(df: DataFrame, columns: Sequence[str]) -> Check:
    """Names the missing columns."""
    missing = missing_columns(df, columns)
    return Check("required_columns", F.lit(len(missing)), F.lit(not missing), f"0 missing{': ' if missing else ''}{', '.join(missing)}")


def row_count(low: int | None = None, exact: int | None = None) -> Check:
    n = F.count(F.lit(1))
    if exact is not None:
        return Check("exact_rows", n, n == exact, f"= {exact}")
    return Check("min_rows", n, n > low, f"> {low}")


def allowed(column: str, values: Sequence) -> Check:
    """Every value listed; a missing value is an unlisted one."""
    bad = F.count_if(F.coalesce(~F.col(column).cast("string").isin([str(v) for v in values]), F.lit(True)))
    return Check(f"allowed_values:{column}", bad, bad == 0, "0 outside the list", column)


def non_negative(column: str) -> Check:
    bad = F.count_if(to_float(column) < 0)
    return Check(f"non_negative:{column}", bad, bad == 0, "0 below zero", column)


def positive(column: str) -> Check:
    bad = F.count_if(F.coalesce(~(F.col(column) > 0), F.lit(True)))
    return Check(f"positive:{column}", bad, bad == 0, "0 not above zero", column)


def in_range(column: str, low: float, high: float) -> Check:
    bad = F.count_if(F.coalesce(~F.col(column).between(low, high), F.lit(True)))
    return Check(f"range:{column}", bad, bad == 0, f"0 outside {low}..{high}", column)


def bounds(column: str, low: float, high: float) -> list[Check]:
    x = to_float(column)
    return [
        Check(f"min:{column}", F.min(x), F.min(x) >= low, f">= {low}", column),
        Check(f"max:{column}", F.max(x), F.max(x) <= high, f"<= {high}", column),
    ]


def share_below(column: str, value: str, limit: float) -> Check:
    share = F.try_divide(F.count_if(F.col(column) == value), F.count(F.lit(1)))
    return Check(f"share_below:{value}", round_half_up(share, 6), share < limit, f"< {limit}", column)


def greater_mean(name: str, column: str, high: Column, low: Column) -> Check:
    """The mean over the rows of ``high`` exceeds that over ``low``."""
    gap = F.avg(F.when(high, F.col(column))) - F.avg(F.when(low, F.col(column)))
    return Check(name, round_half_up(gap, 6), gap > 0, "> 0", column)


def null_count(column: str) -> Check:
    bad = F.count_if(F.col(f"`{column}`").isNull())
    return Check(f"null_keys:{column}", bad, bad == 0, "0 missing", column)


def _row(dataset: str, name: str, passed: Column, observed: Column, expected: str) -> Column:
    return F.struct(
        F.lit(dataset).alias("dataset"),
        F.lit(name).alias("check"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        observed.cast("double").alias("observed"),
        F.lit(expected).alias("expected"),
    )


def run_checks(dataset: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks in one aggregation, then one output row each. A check of a
    column that isn't there is a failed row without a figure."""
    known = [c.column is None or c.column in df.columns for c in checks]
    measured = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[c.observed.alias(f"o{i}") for i, c in enumerate(checks) if known[i]],
        *[c.passed.alias(f"p{i}") for i, c in enumerate(checks) if known[i]],
    )
    listed = [
        _row(dataset, c.name, F.col(f"p{i}") if known[i] else F.lit(False), F.col(f"o{i}") if known[i] else F.lit(None), c.expected)
        for i, c in enumerate(checks)
    ]
    return measured.select(F.inline(F.array(*listed)))


def unique(dataset: str, df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once (a missing one counts as a value)."""
    repeated = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    found = repeated.agg(F.count(F.lit(1)).alias("n"))
    return found.select(F.inline(F.array(_row(dataset, f"unique:{column}", F.col("n") == 0, F.col("n"), "0 repeated"))))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows and those equal to an earlier one, grouping on a fingerprint of the whole content.

    A task's hash map and the shuffle hold 128 bits a row, not the row. Copies are counted
    in the map tasks, so a group of copies holding a third of the table is one partial row
    per task.
    """
    groups = df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(content_key(df))]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def duplicate_fraction(dataset: str, df: DataFrame, limit: float = MAX_DUPLICATE_SHARE) -> DataFrame:
    share = F.try_divide("duplicate_rows", "total_rows")
    row = _row(dataset, "duplicate_fraction", share < limit, round_half_up(share, 6), f"< {limit}")
    return duplicate_rows(df).select(F.inline(F.array(row)))


def unexpected_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """The values outside the list (NULL included), with their number of rows."""
    counted = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(~F.coalesce(F.col("value").isin([str(v) for v in values]), F.lit(False)))


def booking_checks(df: DataFrame, min_rows: int = MIN_BOOKINGS) -> DataFrame:
    checks = [
        required_columns(df, BOOKING_COLUMNS),
        row_count(low=min_rows),
        allowed("hotel", HOTELS),
        allowed("is_canceled", ("0", "1")),
        non_negative("adr"),
        *bounds("arrival_date_year", *YEARS),
        allowed("meal", MEALS),
    ]
    return run_checks("bookings", df, checks).unionByName(duplicate_fraction("bookings", df))


def profile_checks(df: DataFrame, exact_rows: int = PROFILE_ROWS) -> DataFrame:
    checks = [
        row_count(exact=exact_rows),
        allowed("loyalty_tier", TIERS),
        positive("total_spend_eur"),
        share_below("loyalty_tier", "Platinum", MAX_PLATINUM_SHARE),
    ]
    if "email_opt_in" in df.columns:
        checks.append(allowed("email_opt_in", ("Y", "N")))
    return run_checks("guest_profiles", df, checks).unionByName(unique("guest_profiles", df, "guest_id"))


def catalogue_checks(df: DataFrame) -> DataFrame:
    name = F.col("package_name")
    checks = [
        row_count(exact=CATALOGUE_ROWS),
        in_range("margin_pct", 0.0, 1.0),
        greater_mean("premium_margin_higher", "margin_pct", name == PREMIUM_PACKAGE, name == "Standard Room"),
    ]
    return run_checks("package_catalog", df, checks).unionByName(unique("package_catalog", df, "pkg_id"))


def standard_package(column: str = "package_name") -> Column:
    return F.coalesce(F.col(column).contains(STANDARD_PACKAGE), F.lit(False))


def feedback_checks(df: DataFrame, exact_rows: int = FEEDBACK_ROWS) -> DataFrame:
    name = F.col("package_name")
    checks = [
        row_count(exact=exact_rows),
        in_range("nps_score", 0, 10),
        *[in_range(c, 1, 5) for c in SCORES],
        greater_mean("premium_nps_higher", "nps_score", name == PREMIUM_PACKAGE, standard_package()),
        allowed("hotel_type", HOTELS),
    ]
    return run_checks("feedback", df, checks)


# -- profiles -----------------------------------------------------------------


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


#: Size of the quantile sketches, and how far beside a quantile their bracket begins and ends, as a share of the ranks.
SKETCH_SIZE, BRACKET = 1_000, 0.01
QUARTILES = (0.25, 0.5, 0.75)


def quantiles(df: DataFrame, columns: Sequence[str], at: Sequence[float] = QUARTILES, bracket: float = BRACKET) -> DataFrame:
    """(column, q, value): exact quantiles of numeric columns, interpolated between neighbours; NULL without values.

    Three scans, none of which sorts or gathers a column. A mergeable sketch gives a bracket
    around each quantile; the second scan counts the values below and inside it; the third groups
    the values inside, a small share of all, where the two neighbours are found by
    their ranks. A bracket that misses its ranks (a sketch can err) is widened to the
    column's whole range. The driver gets one row of numbers per column and quantile.
    """
    x = {c: finite(f"`{c}`") for c in columns}
    sketched = df.agg(
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(x.values())],
        *[f(v).alias(f"{name}{i}") for i, v in enumerate(x.values()) for name, f in (("min", F.min), ("max", F.max))],
        *[F.kll_sketch_agg_double(v, F.lit(SKETCH_SIZE)).alias(f"s{i}") for i, v in enumerate(x.values())],
    )
    edges = [(i, k, max(q - bracket, 0.0), min(q + bracket, 1.0)) for i in range(len(x)) for k, q in enumerate(at)]
    side = lambda i, r: F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(F.col(f"s{i}"), F.lit(r)))
    found = sketched.select(
        *[f"{n}{i}" for i in range(len(x)) for n in ("n", "min", "max")],
        *[side(i, r).alias(f"{name}{i}_{k}") for i, k, lo, hi in edges for name, r in (("lo", lo), ("hi", hi))],
    ).first()
    ranges = {(i, k): (found[f"lo{i}_{k}"], found[f"hi{i}_{k}"]) for i, k, *_ in edges if found[f"n{i}"]}
    values = list(x.values())

    def counted() -> dict[tuple[int, int], tuple[int, int]]:
        inside = lambda v, lo, hi: (v >= F.lit(lo)) & (v <= F.lit(hi))
        row = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(values[i] < F.lit(lo)).alias(f"b{i}_{k}") for (i, k), (lo, _) in ranges.items()],
            *[F.count_if(inside(values[i], lo, hi)).alias(f"i{i}_{k}") for (i, k), (lo, hi) in ranges.items()],
        ).first()
        return {(i, k): (row[f"b{i}_{k}"], row[f"i{i}_{k}"]) for i, k in ranges}

    wanted = {(i, k): (found[f"n{i}"] - 1) * at[k] for i, k in ranges}
    counts = counted()
    missed = [key for key, (below, held) in counts.items() if wanted[key] < below or math.ceil(wanted[key]) >= below + held]
    if missed:
        ranges |= {(i, k): (found[f"min{i}"], found[f"max{i}"]) for i, k in missed}
        counts = counted()
    spark = df.sparkSession
    asked = spark.createDataFrame(
        [(i, k, c, q, (ranges.get((i, k)) and wanted[(i, k)]), counts.get((i, k), (0, 0))[0]) for i, c in enumerate(columns) for k, q in enumerate(at)],
        "i int, k int, column string, q double, rank double, below long",
    )
    if not ranges:
        return asked.select("column", "q", F.lit(None).cast("double").alias("value"))
    hits = [
        F.when((values[i] >= F.lit(lo)) & (values[i] <= F.lit(hi)), F.struct(F.lit(i).alias("i"), F.lit(k).alias("k"), values[i].alias("v")))
        for (i, k), (lo, hi) in ranges.items()
    ]
    grouped = df.select(F.inline(F.array_compact(F.array(*hits)))).groupBy("i", "k", "v").agg(F.count(F.lit(1)).alias("n"))
    through = F.sum("n").over(Window.partitionBy("i", "k").orderBy("v"))
    ranked = grouped.withColumn("through", through).join(asked, ["i", "k"]).withColumn("last", F.col("below") + F.col("through") - 1)
    holds = lambda r: (F.col("last") >= r) & (F.col("last") - F.col("n") < r)
    low, high = F.floor("rank"), F.ceil("rank")
    near = ranked.groupBy("i", "k").agg(F.max(F.when(holds(low), F.col("v"))).alias("low"), F.max(F.when(holds(high), F.col("v"))).alias("high"))
    between = F.col("low") + (F.col("high") - F.col("low")) * (F.col("rank") - F.floor("rank"))
    return asked.join(near, ["i", "k"], "left").select("column", "q", between.alias("value"))


def describe(df: DataFrame) -> DataFrame:
    """Per column: count, unique, top, freq, and for numbers mean, std, min,
    quartiles, max (mean, std and quartiles to 4 places).

    Value frequencies are needed only for text, and are taken in one grouping
    over (column, value) pairs combined in the map tasks. Quartiles are exact, see ``quantiles``.
    """
    numeric = [c for c, k in df.dtypes if k.split("(")[0] in ("int", "bigint", "double", "float", "smallint", "tinyint", "decimal")]
    textual = [c for c in df.columns if c not in numeric]
    parts = []
    if numeric:
        stats = {
            "count": lambda x: F.count(x).cast("double"),
            "mean": lambda x: round_half_up(F.avg(x), 4),
            "std": lambda x: round_half_up(F.stddev_samp(x), 4),
            "min": F.min,
            "max": F.max,
        }
        row = df.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"{i}_{s}") for i, c in enumerate(numeric) for s, f in stats.items()])
        lines = [
            F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{s}").alias(s) for s in stats]) for i, c in enumerate(numeric)
        ]
        quartile = lambda q: round_half_up(F.max(F.when(F.col("q") == q, F.col("value"))), 4)
        wide = quantiles(df, numeric).groupBy("column").agg(*[quartile(q).alias(f"p{round(100 * q)}") for q in QUARTILES])
        table = row.select(F.inline(F.array(*lines))).join(wide, "column")
        parts.append(
            table.select(
                "column", F.col("count").cast("bigint").alias("count"), F.lit(None).cast("bigint").alias("unique"),
                F.lit(None).cast("string").alias("top"), F.lit(None).cast("bigint").alias("freq"),
                "mean", "std", "min", "p25", "p50", "p75", "max",
            )
        )
    if textual:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in textual])
        # every column keeps a line, also one without any value
        counted = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("m"), F.col("value"))))
        table = counted.groupBy("column").agg(
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("count"),
            F.count("value").alias("unique"),
            best["value"].alias("top"),
            (-best["m"]).alias("freq"),
        )
        blank = [F.lit(None).cast("double").alias(s) for s in ("mean", "std", "min", "p25", "p50", "p75", "max")]
        parts.append(table.select("column", "count", "unique", "top", "freq", *blank))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
