"""Rounding, exact sums and means, percentages.

Double sums depend on the order in which partitions arrive. Money, scores and
minutes are therefore summed as decimals with ``SCALE`` places: exact and
order-free, combined in the map tasks, and an overflow is an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Places that are kept of every input before it is summed: more than any source has.
SCALE = 6


def finite(value: str | Column) -> Column:
    """The value as a double; NaN and the infinities are no measurements and become NULL."""
    x = col(value).cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def round_half_up(value: str | Column, digits: int = 2) -> Column:
    """Half away from zero of the number as it is written (1.005 gives 1.01); never returns -0.0."""
    return F.round(col(value).cast("double"), digits) + F.lit(0.0)


def exact(value: str | Column, scale: int = SCALE) -> Column:
    """``value`` as a decimal. One that is it already stays as it is: the planner knows the type and drops the other branch."""
    kind = f"decimal(24,{scale})"
    return F.when(F.typeof(col(value)) == kind, col(value).cast(kind)).otherwise(finite(value).cast(kind))


def exact_sum(value: str | Column, scale: int = SCALE) -> Column:
    return F.sum(exact(value, scale)).cast("double")


def exact_mean(value: str | Column, scale: int = SCALE) -> Column:
    """Mean of the finite values; NULL when there are none."""
    return F.try_divide(exact_sum(value, scale), F.count(exact(value, scale)))


def mean(value: str | Column, digits: int = 2, scale: int = SCALE) -> Column:
    return round_half_up(exact_mean(value, scale), digits)


def tally(flag: str | Column) -> Column:
    """How many rows have the flag set; NULL when it is unknown on every row."""
    return F.sum(col(flag).cast("int"))


def rows() -> Column:
    return F.count(F.lit(1))


def ratio_pct(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """part / whole * 100, from already aggregated inputs."""
    return round_half_up(F.try_divide(col(part), col(whole)) * 100, digits)


def share_pct(part: str | Column, whole: str | Column, digits: int = 1) -> Column:
    """100 * part / whole (multiplied first, as the SQL reports do)."""
    return round_half_up(F.try_divide(F.lit(100.0) * col(part), col(whole)), digits)


def pct_where(condition: Column, digits: int = 1) -> Column:
    """Percentage of all rows where the condition holds; unknown counts as no."""
    return share_pct(F.count_if(condition), rows(), digits)


def share_where(condition: Column, digits: int = 4) -> Column:
    return round_half_up(F.try_divide(F.count_if(condition).cast("double"), rows()), digits)
