"""Calendar expressions (Column -> Column)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from kpiloom.constants import MONTH_ABBR


def as_date(value: str | dt.date | Column) -> Column:
    """A date literal; a string is read as ISO ``yyyy-MM-dd``."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def day(c: Column) -> Column:
    return F.to_date(c)


def week_sunday(c: Column) -> Column:
    """First day of the Sunday-based week."""
    d = F.to_date(c)
    return F.date_sub(d, F.dayofweek(d) - 1)


def month_start(c: Column) -> Column:
    return F.trunc(F.to_date(c), "month")


#: Period grains accepted by the plans.
GRAINS = {"day": day, "week": week_sunday, "month": month_start}


def to_period(c: Column, grain: str) -> Column:
    return GRAINS[grain](c)


def try_date(c: Column, fmt: str | None = None) -> Column:
    """Text to date; anything unreadable becomes null."""
    ts = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return ts.cast("date")


def month_from_yyyymm(c: Column) -> Column:
    """Integer month such as 202510 (or its text, '202510.0') to first of month."""
    digits = c.try_cast("double").try_cast("long").cast("string")
    return try_date(digits, "yyyyMM")


def previous_month_end(as_of: str | dt.date | Column) -> Column:
    return F.last_day(F.add_months(as_date(as_of), -1))


def day_before(as_of: str | dt.date | Column) -> Column:
    return F.date_sub(as_date(as_of), 1)


def month_abbr(d: Column) -> Column:
    names = F.array(*[F.lit(m) for m in MONTH_ABBR])
    return F.element_at(names, F.month(d))


def month_label(d: Column) -> Column:
    """``Ene'26``"""
    return F.concat(month_abbr(d), F.lit("'"), F.date_format(d, "yy"))


def day_label(d: Column) -> Column:
    """``27/abr``"""
    return F.concat(F.dayofmonth(d).cast("string"), F.lit("/"), F.lower(month_abbr(d)))


def day_text(d: Column) -> Column:
    """``27 abr``"""
    return F.concat(F.dayofmonth(d).cast("string"), F.lit(" "), F.lower(month_abbr(d)))


def month_number(abbr: Column) -> Column:
    """Spanish three-letter month to 1..12, null when unknown."""
    pairs = [x for i, m in enumerate(MONTH_ABBR, 1) for x in (F.lit(m.lower()), F.lit(i))]
    return F.try_element_at(F.create_map(*pairs), F.lower(abbr))


def parse_day_month(text: Column, year: int | Column, fallback_month: Column) -> Column:
    """``1-abr`` to a date of ``year``; an unknown month word uses the fallback."""
    parts = F.split(F.trim(text), "-")
    day_no = F.trim(F.get(parts, F.lit(0))).try_cast("int")
    month = F.coalesce(month_number(F.get(parts, F.lit(1))), fallback_month)
    year = year if isinstance(year, Column) else F.lit(year)
    iso = F.format_string("%04d-%02d-%02d", year, month, day_no)
    known = day_no.isNotNull() & month.isNotNull()
    return F.when(known, try_date(iso, "yyyy-MM-dd"))
