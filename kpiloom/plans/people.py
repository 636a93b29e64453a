"""Buyer demographics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kpiloom.constants import GENDERS, TOTAL
from kpiloom.functions.dates import month_start
from kpiloom.functions.retail import age_band, segment_map
from kpiloom.operators.aggregates import total_label
from kpiloom.operators.filters import not_null_filter, value_set_filter


def _monthly_sum(demo: DataFrame, by: dict[str, Column]) -> DataFrame:
    keys = [c.alias(n) for n, c in by.items()]
    rows = not_null_filter(demo, "Mes").groupBy(*keys).agg(F.sum("MABs").cast("bigint").alias("MABs"))
    return not_null_filter(rows, *by)


def demographic_totals(demo: DataFrame) -> DataFrame:
    """Active buyers of equal month, store, segment, age range and gender in one row, for the four breakdowns."""
    return demo.groupBy("Mes", "TIENDA", "Segmento", "Rango_edad", "Genero").agg(F.sum("MABs").alias("MABs"))


def demo_segment_month(demo: DataFrame) -> DataFrame:
    return _monthly_sum(demo, {"Mes": month_start(F.col("Mes")), "segment": segment_map(F.col("Segmento"))})


def demo_segment_store(demo: DataFrame) -> DataFrame:
    return _monthly_sum(demo, {"TIENDA": F.col("TIENDA"), "segment": segment_map(F.col("Segmento"))})


def demo_age_month(demo: DataFrame) -> DataFrame:
    return _monthly_sum(demo, {"Mes": month_start(F.col("Mes")), "age_group": age_band(F.col("Rango_edad"))})


def demo_gender_month(demo: DataFrame) -> DataFrame:
    rows = value_set_filter(demo, "Genero", GENDERS)
    return _monthly_sum(rows, {"Mes": month_start(F.col("Mes")), "Genero": F.col("Genero")})


def buyers_ytd(buyers_monthly: DataFrame) -> DataFrame:
    """Monthly unique buyers and their sum as a totals row.

    The sum counts a buyer once per month; count distinct buyers from the sales rows
    where unique ones are wanted.
    """
    rows = not_null_filter(buyers_monthly, "Mes").select(
        F.date_format(month_start(F.col("Mes")), "yyyy-MM-dd").alias("Mes"), "Total_Buyers")
    return total_label(rows, ["Mes"], "Mes", [F.sum("Total_Buyers").cast("bigint").alias("Total_Buyers")], TOTAL)
