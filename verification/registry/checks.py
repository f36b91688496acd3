"""Data quality checks and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from verification.ctes import rnd
from wayfare.operators import profiles, quality, reports
from wayfare.sources import catalogues

from .common import Registry

R = Registry()
QUERIES, SQL = R.queries, R.sql


def _check(dataset: str, name: str, observed: str, passed: str, expected: str, source: str) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{name}' AS \"check\", coalesce({passed}, false) AS passed, "
        f"CAST({observed} AS DOUBLE) AS observed, '{expected}' AS expected FROM {source}"
    )


def _bad(dataset: str, name: str, condition: str, expected: str, source: str) -> str:
    n = f"count(*) FILTER (WHERE {condition})"
    return _check(dataset, name, n, f"{n} = 0", expected, source)


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


def _listed(column, values):
    return f"{column} IS NULL OR CAST({column} AS VARCHAR) NOT IN ({', '.join(repr(v) for v in values)})"





def _distinct_groups(table: str) -> str:
    return f"(SELECT count(*) AS t, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table})) AS d FROM {table})"


_BOOKINGS = _union(
    _check("bookings", "required_columns", "0", "true", "0 missing", "(SELECT count(*) FROM bookings)"),
    _check("bookings", "min_rows", "count(*)", "count(*) > 100000", "> 100000", "bookings"),
    _bad("bookings", "allowed_values:hotel", _listed("hotel", quality.HOTELS), "0 outside the list", "bookings"),
    _bad("bookings", "allowed_values:is_canceled", _listed("is_canceled", ("0", "1")), "0 outside the list", "bookings"),
    _bad("bookings", "non_negative:adr", "adr < 0", "0 below zero", "bookings"),
    _check("bookings", "min:arrival_date_year", "min(arrival_date_year)", "min(arrival_date_year) >= 2015", ">= 2015", "bookings"),
    _check("bookings", "max:arrival_date_year", "max(arrival_date_year)", "max(arrival_date_year) <= 2020", "<= 2020", "bookings"),
    _bad("bookings", "allowed_values:meal", _listed("meal", quality.MEALS), "0 outside the list", "bookings"),
    _check("bookings", "duplicate_fraction", rnd("(CAST(d AS DOUBLE)/t)", 6), "CAST(d AS DOUBLE)/t < 0.01", "< 0.01", _distinct_groups("bookings")),
)
R.add("dq_bookings", lambda t: quality.booking_checks(t.bookings), _BOOKINGS)
_P = "guest_profiles"
_PLAT = "CAST(count(*) FILTER (WHERE loyalty_tier = 'Platinum') AS DOUBLE)/count(*)"
R.add(
    "dq_guest_profiles",
    lambda t: quality.profile_checks(t.guest_profiles),
    _union(
        _check(_P, "exact_rows", "count(*)", "count(*) = 5000", "= 5000", _P),
        _bad(_P, "allowed_values:loyalty_tier", _listed("loyalty_tier", quality.TIERS), "0 outside the list", _P),
        _bad(_P, "positive:total_spend_eur", "total_spend_eur IS NULL OR total_spend_eur <= 0", "0 not above zero", _P),
        _check(_P, "share_below:Platinum", rnd(f"({_PLAT})", 6), f"{_PLAT} < 0.1", "< 0.1", _P),
        _check(_P, "unique:guest_id", "count(*)", "count(*) = 0", "0 repeated",
               f"(SELECT guest_id FROM {_P} GROUP BY 1 HAVING count(*) > 1)"),
    ),
)
_GAPNPS = (
    "(avg(CASE WHEN package_name = 'Premium All-Inclusive' THEN nps_score END) - "
    "avg(CASE WHEN package_name LIKE '%Standard%' THEN nps_score END))"
)
R.add(
    "dq_feedback",
    lambda t: quality.feedback_checks(t.feedback),
    _union(
        _check("feedback", "exact_rows", "count(*)", "count(*) = 8000", "= 8000", "feedback"),
        _bad("feedback", "range:nps_score", "nps_score IS NULL OR nps_score NOT BETWEEN 0 AND 10", "0 outside 0..10", "feedback"),
        *[_bad("feedback", f"range:{c}", f"{c} IS NULL OR {c} NOT BETWEEN 1 AND 5", "0 outside 1..5", "feedback") for c in quality.SCORES],
        _check("feedback", "premium_nps_higher", rnd(_GAPNPS, 6), f"{_GAPNPS} > 0", "> 0", "feedback"),
        _bad("feedback", "allowed_values:hotel_type", _listed("hotel_type", quality.HOTELS), "0 outside the list", "feedback"),
    ),
)


def _one(name, dataset, table, check, sql):
    R.add(name, lambda t: quality.run_checks(dataset, getattr(t, table), [check(getattr(t, table))]), sql)


_CUT = ("meal", "arrival_date_year")


def _without_columns(t):
    """The booking suite over a table that lacks two of its columns."""
    return quality.booking_checks(t.bookings.drop(*_CUT), min_rows=1)


R.add(
    "dq_required_columns",
    _without_columns,
    _union(
        _check("bookings", "required_columns", f"{len(_CUT)}", "false", "0 missing: arrival_date_year, meal", "(SELECT count(*) FROM bookings)"),
        _check("bookings", "min_rows", "count(*)", "count(*) > 1", "> 1", "bookings"),
        _bad("bookings", "allowed_values:hotel", _listed("hotel", quality.HOTELS), "0 outside the list", "bookings"),
        _bad("bookings", "allowed_values:is_canceled", _listed("is_canceled", ("0", "1")), "0 outside the list", "bookings"),
        _bad("bookings", "non_negative:adr", "adr < 0", "0 below zero", "bookings"),
        *[_check("bookings", f"{n}:arrival_date_year", "NULL", "false", e, "(SELECT count(*) FROM bookings)")
          for n, e in (("min", ">= 2015"), ("max", "<= 2020"))],
        _check("bookings", "allowed_values:meal", "NULL", "false", "0 outside the list", "(SELECT count(*) FROM bookings)"),
        _check("bookings", "duplicate_fraction", rnd("(CAST(d AS DOUBLE)/t)", 6), "CAST(d AS DOUBLE)/t < 0.01", "< 0.01",
               _distinct_groups("(SELECT * EXCLUDE (meal, arrival_date_year) FROM bookings)")),
    ),
)
_one("dq_min_rows", "bookings", "bookings", lambda df: quality.row_count(low=100_000),
     _check("bookings", "min_rows", "count(*)", "count(*) > 100000", "> 100000", "bookings"))
_one("dq_exact_rows", "feedback", "feedback", lambda df: quality.row_count(exact=8_000),
     _check("feedback", "exact_rows", "count(*)", "count(*) = 8000", "= 8000", "feedback"))
R.add(
    "dq_allowed_values",
    lambda t: quality.unexpected_values(t.bookings, "country", ("FRANCE", "GERMANY", "BRAZIL")),
    "SELECT country AS value, count(*) AS n FROM bookings WHERE country IS NULL OR country NOT IN ('FRANCE', 'GERMANY', "
    "'BRAZIL') GROUP BY 1",
)
_one("dq_non_negative", "bookings", "bookings", lambda df: quality.non_negative("adr"),
     _bad("bookings", "non_negative:adr", "adr < 0", "0 below zero", "bookings"))
_one("dq_positive", _P, "guest_profiles", lambda df: quality.positive("total_spend_eur"),
     _bad(_P, "positive:total_spend_eur", "total_spend_eur IS NULL OR total_spend_eur <= 0", "0 not above zero", _P))
_one("dq_range", "feedback", "feedback", lambda df: quality.in_range("nps_score", 0, 10),
     _bad("feedback", "range:nps_score", "nps_score IS NULL OR nps_score NOT BETWEEN 0 AND 10", "0 outside 0..10", "feedback"))
R.add("dq_unique", lambda t: quality.unique("bookings", t.bookings, "email"),
      _check("bookings", "unique:email", "count(*)", "count(*) = 0", "0 repeated",
             "(SELECT email FROM bookings GROUP BY 1 HAVING count(*) > 1)"))
R.add("dq_duplicate_fraction", lambda t: quality.duplicate_fraction("bookings", t.bookings),
      _check("bookings", "duplicate_fraction", rnd("(CAST(d AS DOUBLE)/t)", 6), "CAST(d AS DOUBLE)/t < 0.01", "< 0.01", _distinct_groups("bookings")))
_one("dq_share_below", _P, "guest_profiles", lambda df: quality.share_below("loyalty_tier", "Platinum", 0.10),
     _check(_P, "share_below:Platinum", rnd(f"({_PLAT})", 6), f"{_PLAT} < 0.1", "< 0.1", _P))
_GAPMARGIN = (
    "(avg(margin_pct) FILTER (WHERE package_name = 'Premium All-Inclusive') - avg(margin_pct) FILTER (WHERE package_name = 'Half Board'))"
)
R.add(
    "dq_compare_groups",
    lambda t: quality.run_checks("feedback", t.feedback.join(catalogues.margin_catalogue(t.spark), "package_name", "left"), [
        quality.greater_mean("premium_nps_higher", "nps_score", F.col("package_name") == quality.PREMIUM_PACKAGE,
                             F.coalesce(F.col("package_name").contains("Standard"), F.lit(False))),
        quality.greater_mean("premium_margin_higher", "margin_pct", F.col("package_name") == quality.PREMIUM_PACKAGE,
                             F.col("package_name") == "Half Board"),
    ]),
    _union(
        _check("feedback", "premium_nps_higher", rnd(_GAPNPS, 6), f"{_GAPNPS} > 0", "> 0", "feedback"),
        _check("feedback", "premium_margin_higher", rnd(_GAPMARGIN, 6), f"{_GAPMARGIN} > 0", "> 0",
               "(SELECT f.package_name, m.margin_pct FROM feedback f LEFT JOIN margins m ON f.package_name = m.package_name)"),
    ),
)
_KEYS = (
    "src_key", "hotel", "is_canceled", "lead_time", "arrival_date_year", "arrival_date_month", "arrival_date_day_of_month",
    "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children", "babies", "meal", "country",
    "market_segment", "distribution_channel", "is_repeated_guest", "previous_cancellations", "booking_changes",
    "reserved_room_type", "assigned_room_type", "deposit_type", "days_in_waiting_list", "customer_type", "adr",
    "total_of_special_requests", "reservation_status", "reservation_status_date", "name", "email",
)
R.add(
    "dq_null_keys",
    lambda t: quality.run_checks("bookings", t.bookings, [quality.null_count(c) for c in _KEYS]),
    _union(*[_bad("bookings", f"null_keys:{c}", f"{c} IS NULL", "0 missing", "bookings") for c in _KEYS]),
)
_GAPCATALOGUE = (
    "(avg(margin_pct) FILTER (WHERE package_name = 'Premium All-Inclusive') - avg(margin_pct) FILTER (WHERE package_name = 'Standard Room'))"
)
R.add(
    "dq_catalogue",
    lambda t: quality.catalogue_checks(
        catalogues.margin_catalogue(t.spark).join(t.feedback.groupBy("package_name").agg(F.count(F.lit(1)).alias("n")), "package_name", "left")
    ),
    _union(
        _check("package_catalog", "exact_rows", "count(*)", "count(*) = 8", "= 8", "margins"),
        _bad("package_catalog", "range:margin_pct", "margin_pct IS NULL OR margin_pct NOT BETWEEN 0 AND 1", "0 outside 0.0..1.0", "margins"),
        _check("package_catalog", "premium_margin_higher", rnd(_GAPCATALOGUE, 6), f"{_GAPCATALOGUE} > 0", "> 0", "margins"),
        _check("package_catalog", "unique:pkg_id", "count(*)", "count(*) = 0", "0 repeated", "(SELECT pkg_id FROM margins GROUP BY 1 HAVING count(*) > 1)"),
    ),
)

# -- profiles -----------------------------------------------------------------

_NUMERIC = ("total_stays", "total_spend_eur", "guest_id")
_TEXT = ("country", "loyalty_tier", "preferred_segment")
def _quartiles(c: str) -> str:
    return ", ".join(f"{rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.{q})', 4)} AS p{q}" for q in ("25", "50", "75"))


_DESCRIBE = _union(
    *[
        f"SELECT '{c}' AS \"column\", count({c}) AS count, CAST(NULL AS BIGINT) AS \"unique\", CAST(NULL AS VARCHAR) AS top, "
        f"CAST(NULL AS BIGINT) AS freq, {rnd(f'avg(CAST({c} AS DOUBLE))', 4)} AS mean, "
        f"{rnd(f'stddev_samp(CAST({c} AS DOUBLE))', 4)} AS std, CAST(min({c}) AS DOUBLE) AS min, {_quartiles(c)}, CAST(max({c}) AS DOUBLE) AS max "
        "FROM guest_profiles"
        for c in _NUMERIC
    ],
    *[
        f"SELECT '{c}', CAST(sum(n) AS BIGINT), count(*), min_by({c}, (-n, {c})), max(n), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM (SELECT "
        f"{c}, count(*) AS n FROM guest_profiles WHERE {c} IS NOT NULL GROUP BY 1)"
        for c in _TEXT
    ],
)
R.add("dq_profile_describe", lambda t: quality.describe(t.guest_profiles), _DESCRIBE)
_MEASURES = (
    "src_key", "is_canceled", "lead_time", "arrival_date_year", "arrival_date_day_of_month", "stays_in_weekend_nights",
    "stays_in_week_nights", "adults", "children", "babies", "is_repeated_guest", "previous_cancellations", "booking_changes",
    "days_in_waiting_list", "adr", "total_of_special_requests",
)
R.add(
    "dq_profile_quartiles",
    lambda t: quality.describe(t.bookings).filter(F.col("mean").isNotNull()).select("column", "p25", "p50", "p75"),
    _union(*[
        f"SELECT '{c}' AS \"column\", {_quartiles(c)} FROM bookings"
        for c in _MEASURES
    ]),
)
R.add(
    "dq_profile_describe_bookings",
    lambda t: quality.describe(t.bookings).select("column", "count", "unique", "top", "freq", "min", "max"),
    _union(
        *[
            f"SELECT '{c}' AS \"column\", count({c}) AS count, CAST(NULL AS BIGINT) AS \"unique\", CAST(NULL AS VARCHAR) AS top, "
            f"CAST(NULL AS BIGINT) AS freq, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM bookings"
            for c in _MEASURES
        ],
        *[
            f"SELECT '{c}', CAST(coalesce(sum(n), 0) AS BIGINT), count(*), min_by(v, (-n, v)), max(n), NULL, NULL FROM (SELECT "
            f"CAST({c} AS VARCHAR) AS v, count(*) AS n FROM bookings WHERE {c} IS NOT NULL GROUP BY 1)"
            for c in _KEYS if c not in _MEASURES
        ],
    ),
)
_NULLS = _KEYS
R.add(
    "dq_profile_nulls",
    lambda t: quality.null_profile(t.bookings.select(*_NULLS)),
    _union(*[f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM bookings" for c in _NULLS]),
)
R.add("dq_profile_dupes", lambda t: quality.duplicate_rows(t.bookings),
      f"SELECT t AS total_rows, d AS duplicate_rows FROM {_distinct_groups('bookings')}")
R.add("dq_profile_shape", lambda t: quality.shape(t.bookings), "SELECT count(*) AS n_rows, 30 AS n_columns FROM bookings")
R.add("dq_preview", lambda t: profiles.preview(t.feedback, ["*"], 5, "feedback_id"), "SELECT * FROM feedback ORDER BY feedback_id LIMIT 5")


def _monotone(t):
    """Per hotel, before and after every cancelled booking is added again."""
    base = t.curated
    more = base.unionByName(base.filter("is_canceled"))
    before, after = reports.cancellation_by_hotel(base), reports.cancellation_by_hotel(more)
    return before.select("hotel", F.col("cancellation_rate").alias("before")).join(
        after.select("hotel", F.col("cancellation_rate").alias("after")), "hotel"
    ).withColumn("passed", F.col("after") >= F.col("before"))


R.add(
    "dq_downstream_monotone",
    _monotone,
    "SELECT hotel, c / n AS before, 2 * c / (n + c) AS after, 2 * c / (n + c) >= c / n AS passed FROM (SELECT hotel, CAST(count(*) FILTER "
    "(WHERE is_canceled) AS DOUBLE) AS c, count(*) AS n FROM curated GROUP BY 1)",
)


def _counted(t):
    """Per hotel, completed bookings before and after each of them is added again."""
    base = t.curated
    total = lambda df: reports.premium_by_meal(df).groupBy("hotel").agg(F.sum("total_bookings").alias("n"))
    before, after = total(base), total(base.unionByName(reports.kept(base)))
    return before.withColumnRenamed("n", "before").join(after.withColumnRenamed("n", "after"), "hotel").withColumn(
        "passed", F.col("after") > F.col("before")
    )


R.add(
    "dq_downstream_counts",
    _counted,
    "SELECT hotel, count(adr) AS before, 2 * count(adr) AS after, 2 * count(adr) > count(adr) AS passed FROM kept GROUP BY 1",
)
