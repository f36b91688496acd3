"""Dates from parts and text, tolerant of bad values under ANSI."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labels import MONTHS, ordinal
from .numeric import col

# Profile dates fall back to this day when no booking date parses.
FIRST_BOOKING_FALLBACK = "2015-07-01"
JOINED_MIN_DAYS, JOINED_MAX_DAYS = 30, 365


def month_number(name: str | Column, unknown: int | None = None) -> Column:
    """1..12 for an English month name; ``unknown`` (default NULL) otherwise."""
    found = ordinal(name, MONTHS, start=1)
    return found if unknown is None else F.coalesce(found, F.lit(unknown))


def date_from_parts(year: str | Column, month: Column, day: str | Column) -> Column:
    """Date of whole-number parts; NULL if one is missing or the day does not
    exist (31 June).

    Each part is named once: filters on the date are pushed below the columns
    it is made of, and every mention is computed again there.
    """
    parts = [col(year), month, col(day)]
    text = F.concat(parts[0].cast("string"), F.lit("-"), parts[1].cast("string"), F.lit("-"), parts[2].cast("string"))
    return text.try_cast("date")


def to_day(df: DataFrame, c: str) -> Column:
    """A date column as is, text as ``yyyy-MM-dd``; unparsable gives NULL.

    The cast has a parser of its own, many times faster than a pattern; the
    length keeps out the bare years and months that it would accept.
    """
    if dict(df.dtypes)[c] == "date":
        return F.col(c)
    text = F.col(c).cast("string")
    return F.when(F.length(text) >= 8, text.try_cast("date"))


def to_moment(c: str | Column) -> Column:
    """Text ``yyyy-MM-dd HH:mm:ss`` as a timestamp; anything else gives NULL."""
    return F.when(F.length(col(c)) == 19, col(c).try_cast("timestamp"))


def year_month(year: str | Column, month: str | Column) -> Column:
    return F.format_string("%d-%02d", col(year), col(month))


def joined_date(first_booking: str | Column, email: str | Column) -> Column:
    """Day the guest joined, 30..365 days before the first booking.

    The offset is drawn from the e-mail's hash, so that re-runs agree.
    """
    span = JOINED_MAX_DAYS - JOINED_MIN_DAYS + 1
    draw = F.conv(F.substring(F.md5(col(email)), 1, 4), 16, 10).cast("int")
    start = F.coalesce(col(first_booking), F.lit(FIRST_BOOKING_FALLBACK).cast("date"))
    return F.date_sub(start, (F.lit(JOINED_MIN_DAYS) + F.pmod(draw, F.lit(span))).cast("int"))
