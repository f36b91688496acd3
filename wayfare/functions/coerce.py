"""Text to typed values: a value that does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import col, finite

# Texts that mean "missing" in the CSV sources (the two explicit
# ones and the usual defaults of the CSV reader the sources were made for).
NULL_TOKENS = (
    "NULL", "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NaN", "None", "n/a", "nan", "null",
)

# Every text that Spark casts to a whole number, blanks and control characters around it included.
WHOLE = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"


def null_token(c: str | Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    return F.when(~col(c).isin(*tokens), col(c))


def to_float(c: str | Column) -> Column:
    return finite(col(c).try_cast("double"))


def to_int(c: str | Column) -> Column:
    """Whole number; '3.0' is 3, a fraction or text is NULL.

    Only what can succeed is parsed, as each failure costs an exception: no finite number is
    without a digit (the planner knows the type, so other columns go without that test).
    """
    text = col(c).cast("string")
    numeral = (F.typeof(col(c)) != "string") | text.rlike("[0-9]")
    number = to_float(F.when(numeral, col(c)))
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(F.when(text.rlike(WHOLE), text.try_cast("bigint")), whole)


def to_text(c: str | Column) -> Column:
    text = col(c).cast("string")
    return F.when(text != "nan", text)


def to_whole(df: DataFrame, c: str) -> Column:
    """Integer part of a number or of its text ('3.0' and '3.7' are 3)."""
    kind = dict(df.dtypes)[c]
    if kind in ("tinyint", "smallint", "int"):
        return F.col(c)
    number = F.col(c) if kind in ("bigint", "double", "float") else F.col(c).try_cast("double")
    return number.try_cast("int")


def to_flag(df: DataFrame, c: str) -> Column:
    """0/1 text or number to boolean by way of an integer."""
    return to_whole(df, c).cast("boolean")
