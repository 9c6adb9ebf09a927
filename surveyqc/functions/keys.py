"""Composite keys of survey rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType, StringType

MISSING_PART = "NULO"
SEPARATOR = "-"

_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def as_number(c: Column) -> Column:
    """Text as a double, null if it is no number. Spellings that only Java reads as
    numbers (``1d``, ``NaN``) are none."""
    return F.when(F.regexp_like(c, F.lit(_NUMBER)), c.try_cast("double"))


def whole_number(number: Column, on_fractional: str = "error") -> Column:
    """A double as bigint; a fraction raises or gives null, as do NaN and infinity."""
    finite = ~F.isnan(number) & (F.abs(number) < F.lit(float(2**63)))
    exact = finite & (number == F.floor(number))
    whole = F.when(exact, number.try_cast("bigint"))
    if on_fractional == "null":
        return whole
    message = F.concat(F.lit("id part is not a whole number: "), number.cast("string"))
    return F.when(finite & ~exact, F.raise_error(message).cast("bigint")).otherwise(whole)


def integer_part(c: Column, kind: DataType, on_fractional: str = "error") -> Column:
    """The value as a whole number, by the column's type. Text is read as an integer
    first, as doubles lose ids above 2**53; text that is no number gives null."""
    if isinstance(kind, IntegralType):
        return c.cast("bigint")
    if isinstance(kind, StringType):
        return F.coalesce(
            c.try_cast("bigint"), whole_number(as_number(c), on_fractional)
        )
    return whole_number(c.cast("double"), on_fractional)


def id_text(c: Column, kind: DataType) -> Column:
    """An id as text. Whole floating numbers are written out, ``12345678.0``, up to where
    they are exact."""
    if not isinstance(kind, (FloatType, DoubleType)):
        return c.cast("string")
    number = c.cast("double")
    whole = (F.abs(number) < 1e16) & (number == F.floor(number))
    written = F.concat(number.try_cast("decimal(38,0)").cast("string"), F.lit(".0"))
    return F.when(whole, written).otherwise(c.cast("string"))


def code_text(c: Column, kind: DataType) -> Column:
    """A category code as text: numeric, truncated to a whole number, else null."""
    if isinstance(kind, IntegralType):
        return c.cast("string")
    if isinstance(kind, StringType):
        whole = F.coalesce(c.try_cast("bigint"), as_number(c).try_cast("bigint"))
        return whole.cast("string")
    number = c.cast("double")
    return F.when(~F.isnan(number), number.try_cast("bigint")).cast("string")


def row_key(df: DataFrame, parts: Sequence[str], on_fractional: str = "error") -> Column:
    """Parts joined by ``-``; a missing part shows as ``NULO``."""
    texts = [
        F.coalesce(
            integer_part(F.col(p), df.schema[p].dataType, on_fractional).cast("string"),
            F.lit(MISSING_PART),
        )
        for p in parts
    ]
    return F.concat_ws(SEPARATOR, *texts)


def base_key(key: Column) -> Column:
    """The row key without its last part."""
    return F.regexp_replace(key, "-[^-]*$", "")


def last_part(key: Column) -> Column:
    """The expected code: what follows the last ``-`` of the row key."""
    return F.substring_index(key, SEPARATOR, -1)
