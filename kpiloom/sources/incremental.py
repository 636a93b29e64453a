"""Tables by date of which only the days, weeks or months are recomputed whose facts have changed."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from kpiloom.functions.dates import to_period

#: Column of the stored rows that names their folder, the first date of its day, week or month; and
#: one that is true for all rows but that which a folder keeps when it has lost all others.
PART, PRESENT = "part", "present"


def changed_days(changed: DataFrame, key: str, date_col: str, state: DataFrame | None = None,
                 day_col: str = "day") -> list[dt.date]:
    """Days that new or changed facts touch: their own, and those where ``state`` has the same keys.

    A key whose date has moved is thus taken out of its old day. As many dates as the calendar has.
    """
    days = changed.select(F.to_date(date_col).alias("d"))
    if state is not None:
        keys = changed.select(F.col(key).alias("__key")).distinct()
        before = state.join(keys, F.col(key) == F.col("__key"), "left_semi")
        days = days.unionByName(before.select(F.to_date(day_col).alias("d")))
    return sorted(r.d for r in days.where("d is not null").distinct().collect())


def on_days(df: DataFrame, date_col: str, days: Iterable[dt.date], partition: str | None = None) -> DataFrame:
    """Rows of the listed days. The first and last day stand on the column itself, for the scan;
    ``partition`` names a column that holds the day in a partitioned table, for its folders."""
    days = sorted(days)
    if not days:
        return df.limit(0)
    inside = df.filter((F.col(date_col) >= F.lit(days[0])) & (F.col(date_col) < F.lit(days[-1] + dt.timedelta(1)))
                       & F.to_date(date_col).isin(*days))
    return inside if partition is None else inside.filter(F.col(partition).isin(*days))


def whole_periods(days: Iterable[dt.date], grain: str) -> dict[dt.date, list[dt.date]]:
    """All days of the days, weeks (from Sunday) or months that ``days`` lie in, by their first date."""
    out = {}
    for day in days:
        first = {"day": day, "week": day - dt.timedelta(day.isoweekday() % 7), "month": day.replace(day=1)}[grain]
        length = {"day": 1, "week": 7, "month": calendar.monthrange(first.year, first.month)[1]}[grain]
        out.setdefault(first, [first + dt.timedelta(k) for k in range(length)])
    return out


def refresh_days(spark: SparkSession, build: Callable[[list[dt.date]], DataFrame], days: Iterable[dt.date], path: str,
                 day_col: str = "day", grain: str = "day") -> list[dt.date]:
    """Replace the listed days of the table at ``path`` by the rows of ``build(days)``; returns these days.

    The table has a folder per ``grain``: days where each holds much, months where a day's rows
    would make a file of their own for little. Whole folders are replaced, so ``build`` is asked for all
    days of theirs, and gives rows of those only. Other folders stay as they are; a failed or
    repeated run leaves whole ones. Read the table with ``read_days``.
    """
    periods = whole_periods(days, grain)
    wanted = sorted(d for inside in periods.values() for d in inside)
    if wanted:
        listed = spark.createDataFrame([(p,) for p in periods], f"{PART} date")
        built = build(wanted).withColumns({PART: to_period(F.col(day_col), grain), PRESENT: F.lit(True)})
        # few files a folder: small ones share a task, a large one is split
        rows = listed.join(built, PART, "left").hint("rebalance", PART)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    return wanted


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``refresh_days`` keeps."""
    return spark.read.parquet(path).where(PRESENT).drop(PRESENT, PART)
