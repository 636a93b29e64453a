"""Sorting, limits and distinct keys. Plans return unordered rows; sort at the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def order_output(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*keys)


def sort_periods(df: DataFrame, period: str) -> DataFrame:
    """The distinct periods in order."""
    return df.select(period).distinct().orderBy(period)


def result_cap(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first ``n`` rows by ``keys``. Never applied unless asked for."""
    return df.orderBy(*keys).limit(n)


def top_latest(df: DataFrame, period: str) -> DataFrame:
    """The row of the last period."""
    return df.orderBy(F.desc(period)).limit(1)


def distinct_keys(df: DataFrame, *cols: str, unpack: str | None = None) -> DataFrame:
    """Union of keys over all periods and stores; ``unpack`` names an array column
    of keys to be flattened first."""
    if unpack:
        df = df.withColumn(unpack, F.explode(unpack))
    return df.select(*cols).distinct()


def distinct_dates(df: DataFrame, date_col: str) -> DataFrame:
    return df.select(F.to_date(date_col).alias(date_col)).distinct()
