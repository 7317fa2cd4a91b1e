"""Raw feed text to typed values; what cannot be read becomes null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from priceloom.fixed_values import COORDINATE_SCALE

_BLANKS = " \t\r\n\f\v"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_TIMESTAMP = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def clean_text(text: Column) -> Column:
    """Trim, then empty to null."""
    return empty_to_null(F.btrim(text, F.lit(_BLANKS)))


def _number(text: Column) -> Column:
    """Decimal notation only: the bare cast would also take Java suffixes such as ``1.5d``."""
    return F.when(text.rlike(_NUMBER), F.btrim(text, F.lit(_BLANKS)).try_cast("double"))


def fixed_point(text: Column, scale: int = COORDINATE_SCALE) -> Column:
    """An integer-coded coordinate as degrees."""
    return _number(text) / F.lit(float(scale))


def price(text: Column) -> Column:
    """A price in euros, rounded to three decimals; what has over fifteen digits before the point is no price."""
    value = _number(text)
    return F.when(F.abs(value) < 1e15, F.round(value, 3))


def strict_ts(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` without a zone; every other shape is null."""
    return F.when(text.rlike(_TIMESTAMP), text.try_cast("timestamp_ntz"))
