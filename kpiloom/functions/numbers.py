"""Guarded arithmetic, rounding and number parsing (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_PLAIN_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``; null when the denominator is 0 or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def safe_ratio_nz(num: Column, den: Column) -> Column:
    """``num / den``; null when either side is 0 or null."""
    return F.when(num != 0, safe_ratio(num, den))


def positive_ratio(num: Column, den: Column) -> Column:
    """``num / den``; null unless the denominator is above 0."""
    return F.when(den > 0, safe_ratio(num, den))


def round_half_up(c: Column) -> Column:
    """Nearest integer, ties towards plus infinity."""
    return F.floor(c + F.lit(0.5))


def round_half_even(c: Column) -> Column:
    return F.bround(c, 0)


def nan_to_null(c: Column) -> Column:
    """Double value; NaN, infinities and unreadable text become null."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def _plain_double(text: Column) -> Column:
    return F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double"))


def parse_decimal_comma(c: Column) -> Column:
    """``1.234,5`` to 1234.5; blank, percent and unreadable text become null."""
    text = F.replace(F.replace(F.trim(c), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return _plain_double(text)


def parse_comma_cell(c: Column) -> Column:
    """``71,0%`` to 71.0 and ``12,2`` to 12.2; unreadable text becomes null."""
    text = F.replace(F.replace(F.trim(c), F.lit("%"), F.lit("")), F.lit(","), F.lit("."))
    return _plain_double(F.trim(text))


def parse_percent(c: Column) -> Column:
    """``71,0%`` to 0.71."""
    return parse_comma_cell(c) / 100
