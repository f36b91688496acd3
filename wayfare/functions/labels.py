"""Flags, buckets and tiers.

A comparison with NULL is unknown, so flags stay NULL on NULL input; a bucket
falls through to its last label, unless ``null_label`` says otherwise.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col

# ---------------------------------------------------------------------------
# Labels, cut points and code lists that decide the results.
# ---------------------------------------------------------------------------
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
PREMIUM_MEALS = ("HB", "FB")
PREMIUM_ROOMS = ("F", "G", "H")
PREMIUM_CLASSES = ("Business", "First")
UPPER_TIERS = ("Gold", "Platinum")

LEAD_TIME = ((7, "< 1 week"), (30, "1-4 weeks"), (90, "1-3 months"), (180, "3-6 months"), (None, "6+ months"))
REVENUE = ((80, "Low"), (150, "Mid"), (None, "Premium"))
TIME_OF_DAY = (
    (6, "Night (0-6)"), (12, "Morning (6-12)"), (18, "Afternoon (12-18)"), (None, "Evening (18-24)"),
)
DELAY = ((0, "No Delay"), (15, "< 15 min"), (30, "15-30 min"), (60, "30-60 min"), (None, "> 60 min"))
BOOKING_AHEAD = (
    (7, "< 1 week"), (30, "1-4 weeks"), (60, "1-2 months"), (90, "2-3 months"), (None, "3+ months"),
)
SATISFACTION_BAND = (
    (8.0, "Highly Satisfied"), (7.0, "Satisfied"), (5.0, "Neutral"), (None, "Dissatisfied"),
)
SATISFACTION_SEGMENT = (
    (8.0, "Highly Satisfied"), (6.5, "Satisfied"), (5.0, "Neutral"), (None, "Dissatisfied"),
)
NPS = ((9, "Promoter"), (7, "Passive"), (None, "Detractor"))

LEAD_DAYS = (
    (0, 7, "0–7 days"), (8, 30, "8–30 days"), (31, 90, "31–90 days"), (91, 180, "91–180 days"),
    (None, None, "180+ days"),
)
WAIT_DAYS = ((0, 0, "No wait"), (1, 7, "1–7 days wait"), (None, None, "8+ days wait"))

GUEST_VALUE = {"Platinum": "High Value", "Gold": "Mid-High Value", "Silver": "Mid Value"}
GUEST_VALUE_OTHER = "Standard"

# minimum lifetime spend, minimum stays, minimum special requests
LOYALTY = (
    ("Platinum", 1500, 4, None),
    ("Gold", 700, 3, None),
    ("Silver", 300, 2, 3),
    ("Bronze", None, None, None),
)
# minimum average satisfaction, minimum on-time share
ROUTE_TIER = (
    ("High Performing", 7.2, 0.85),
    ("Average", 6.5, 0.75),
    ("Needs Improvement", None, None),
)

TIER_ORDER = ("Platinum", "Gold", "Silver", "Bronze")
FLYER_ORDER = ("Platinum", "Gold", "Silver", "Non-Member")
# ---------------------------------------------------------------------------


def bucketize(value: str | Column, steps: Sequence[tuple], compare, null_label: str | None = None) -> Column:
    """First label whose ``compare(value, bound)`` holds; the open step is last."""
    x = col(value)
    *bounded, (_, last) = steps
    out = F.when(x.isNull(), null_label) if null_label is not None else F
    for bound, label in bounded:
        out = out.when(compare(x, F.lit(bound)), label)
    return out.otherwise(last)


def interval_label(value: str | Column, intervals: Sequence[tuple]) -> Column:
    """Label of the closed interval holding the value, else the open label."""
    x = col(value)
    *closed, (_, _, other) = intervals
    out = F
    for low, high, label in closed:
        out = out.when(x.between(low, high), label)
    return out.otherwise(other)


def ordinal(value: str | Column, order: Sequence[str], start: int = 0) -> Column:
    """Place of a label in a fixed order, counted from ``start``; NULL if absent.

    Not a map literal: two of those are never equal to the planner, which then
    runs equal parts of a plan twice instead of reusing their exchange.
    """
    if any("," in label for label in order):
        raise ValueError("labels with a comma cannot be searched")
    place = F.find_in_set(col(value), F.lit(",".join(order)))
    return F.nullif(place, F.lit(0)) + F.lit(start - 1)


def label_order(steps: Sequence[tuple]) -> tuple[str, ...]:
    return tuple(step[-1] for step in steps)


def lead_time_bucket(c: str | Column = "lead_time", null_label: str | None = None) -> Column:
    return bucketize(c, LEAD_TIME, operator.lt, null_label)


def revenue_bucket(c: str | Column = "adr", null_label: str | None = None) -> Column:
    return bucketize(c, REVENUE, operator.lt, null_label)


def time_of_day(c: str | Column = "departure_hour", null_label: str | None = None) -> Column:
    return bucketize(c, TIME_OF_DAY, operator.lt, null_label)


def delay_bucket(c: str | Column = "Delay_Minutes", null_label: str | None = None) -> Column:
    """Exactly zero is "No Delay"; delays are clamped at zero before this."""
    (_, none), *rest = DELAY
    x = col(c)
    later = bucketize(x, rest, operator.le, null_label)
    return F.when(x == 0, none).otherwise(later)


def booking_bucket(c: str | Column = "Booking_Days_In_Advance", null_label: str | None = None) -> Column:
    return bucketize(c, BOOKING_AHEAD, operator.le, null_label)


def satisfaction_band(c: str | Column = "Flight_Satisfaction_Score", null_label: str | None = None) -> Column:
    return bucketize(c, SATISFACTION_BAND, operator.ge, null_label)


def satisfaction_segment(c: str | Column = "avg_satisfaction", null_label: str | None = None) -> Column:
    return bucketize(c, SATISFACTION_SEGMENT, operator.ge, null_label)


def nps_category(c: str | Column = "nps_score", null_label: str | None = None) -> Column:
    return bucketize(c, NPS, operator.ge, null_label)


def lead_days_bucket(c: str | Column = "lead_time") -> Column:
    return interval_label(c, LEAD_DAYS)


def wait_bucket(c: str | Column = "days_in_waiting_list") -> Column:
    return interval_label(c, WAIT_DAYS)


def threshold_band(value: str | Column, high: float, low: float, labels: Sequence[str], inclusive: bool) -> Column:
    """Three-way band of a figure; ``inclusive`` counts the bounds to the upper band."""
    above = operator.ge if inclusive else operator.gt
    return bucketize(value, ((high, labels[0]), (low, labels[1]), (None, labels[2])), above)


def guest_value_segment(c: str | Column = "g_loyalty_tier") -> Column:
    out = F
    for tier, segment in GUEST_VALUE.items():
        out = out.when(col(c) == tier, segment)
    return out.otherwise(GUEST_VALUE_OTHER)


def loyalty_tier(
    spend: str | Column = "lifetime_spend",
    stays: str | Column = "total_stays",
    requests: str | Column = "total_special_requests",
) -> Column:
    out = F
    *ranked, (lowest, *_) = LOYALTY
    for tier, min_spend, min_stays, min_requests in ranked:
        reached = (col(spend) >= min_spend) | (col(stays) >= min_stays)
        if min_requests is not None:
            reached = reached | (col(requests) >= min_requests)
        out = out.when(reached, tier)
    return out.otherwise(lowest)


def route_tier(satisfaction: str | Column = "avg_satisfaction", on_time: str | Column = "pct_on_time") -> Column:
    out = F
    *ranked, (lowest, *_) = ROUTE_TIER
    for tier, min_score, min_on_time in ranked:
        out = out.when((col(satisfaction) >= min_score) & (col(on_time) >= min_on_time), tier)
    return out.otherwise(lowest)


def guest_id(email: str | Column = "email") -> Column:
    return F.concat(F.lit("G-"), F.upper(F.substring(F.md5(col(email)), 1, 8)))


def route_id(
    departure: str | Column = "Departure_Airport",
    arrival: str | Column = "Arrival_Airport",
    airline: str | Column = "Airline",
) -> Column:
    # concat, not concat_ws: a missing part makes the whole id NULL
    carrier = F.replace(col(airline), F.lit(" "), F.lit("_"))
    return F.concat(col(departure), F.lit("-"), col(arrival), F.lit("-"), carrier)
