"""What to group whole rows by: fingerprints where only counts of equal rows are wanted, else a text of the row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types whose values are equal exactly if a grouping takes them for equal and their bytes hash alike.
_PLAIN = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
    T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType,
)


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _hashed(kind: T.DataType) -> bool:
    return isinstance(kind, _PLAIN) or kind == T.StringType()


def content_key(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Columns to group by in place of all ``columns``: 128 bits, whatever the width of a row.

    Two chains of 64-bit hashes, one in each order of the columns, both over the places of
    the NULLs too, which the hashes by themselves pass over: no collisions to expect at 10**12
    rows. NaN and both zeros hash as they group. Columns of nested or collated types, which do
    not, stay in the key as they are.
    """
    columns = df.columns if columns is None else columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    hashed = [c for c in columns if _hashed(kinds[c])]
    kept = [_col(c) for c in columns if not _hashed(kinds[c])]
    if not hashed:
        return kept
    nulls = F.concat(*[F.when(_col(c).isNull(), "1").otherwise("0") for c in hashed])
    return [F.xxhash64(nulls, *[_col(c) for c in hashed]), F.xxhash64(*[_col(c) for c in reversed(hashed)], nulls), *kept]


#: Between the fields of a row's text, and what stands for NULL.
SEPARATOR, NULL = "\x1f", "\x00"


def _in_text(kind: T.DataType) -> bool:
    """Types that have one text per value as a grouping sees it, from which the value comes back."""
    return kind == T.StringType() or isinstance(kind, (T.BooleanType, T.IntegralType, T.DateType, T.FractionalType))


def _field(c: str, kind: T.DataType, exact: bool) -> Column:
    """A value's text; -0.0 is 0.0, as in a grouping, unless ``exact``."""
    x = _col(c)
    return (x + F.lit(0.0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) and not exact else x).cast("string")


def kept_apart(df: DataFrame, apart: Sequence[str] = ()) -> list[str]:
    """Columns that ``as_text`` leaves as they are: nested, collated, binary, times, and those of ``apart``."""
    return [f.name for f in df.schema.fields if f.name in apart or not _in_text(f.dataType)]


def as_text(df: DataFrame, name: str, apart: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """``df`` with its columns put into one text ``name``; rows are equal exactly where a grouping takes them for equal.

    A shuffle moves less than half the bytes: there are no eight bytes and no offset for each field,
    which change from row to row and so don't compress. Where a string holds one of the two signs, or is no
    valid text, ``name``_odd has the fields one by one. ``from_text`` gives the columns back. The generated
    code stays below the 8000 bytes of a method that the virtual machine compiles. Columns of ``apart`` stay
    as they are; ``exact`` also keeps the sign of -0.0, for rows that are only moved.
    """
    apart = kept_apart(df, apart)
    kinds = {f.name: f.dataType for f in df.schema.fields if f.name not in apart}
    fields = df.select(*[_field(c, k, exact).alias(c) for c, k in kinds.items()], *map(_col, apart))
    strings = F.concat_ws("", *[_col(c) for c, k in kinds.items() if isinstance(k, T.StringType)])
    odd = strings.contains(SEPARATOR) | strings.contains(NULL) | ~F.is_valid_utf8(strings)
    return fields.select(
        F.concat_ws(SEPARATOR, *[F.coalesce(_col(c), F.lit(NULL)) for c in kinds]).alias(name),
        F.when(odd, F.array(*map(_col, kinds)).cast("array<string>")).alias(f"{name}_odd"),
        *map(_col, apart),
    )


def from_text(df: DataFrame, name: str, schema: T.StructType, apart: Sequence[str] = ()) -> DataFrame:
    """The columns of ``schema`` after those of ``df``, whose rows ``as_text`` made; all NULL where there is no text."""
    kinds = {f.name: f.dataType for f in schema.fields if f.name not in apart and _in_text(f.dataType)}
    fields = f"{name}_fields"
    # fields one by one have their own NULLs; the others get theirs all at once, which keeps the generated method
    # of 29 columns at 3607 bytes (13062 with a comparison for each)
    found = F.transform(F.split(name, SEPARATOR, -1), lambda x: F.nullif(x, F.lit(NULL)))
    split = df.withColumn(fields, F.coalesce(f"{name}_odd", found))
    typed = [F.get(fields, F.lit(n)).cast(k).alias(c) for n, (c, k) in enumerate(kinds.items())]
    return split.select(*[c for c in df.columns if c not in schema.names], *typed, *[_col(c) for c in schema.names if c not in kinds])


def moved(df: DataFrame, apart: Sequence[str], move: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``df`` after ``move``, an exchange by columns of ``apart``: all others go through it as one text."""
    return from_text(move(as_text(df, "_moved", apart, exact=True)), "_moved", df.schema, apart).select(*map(_col, df.columns))
