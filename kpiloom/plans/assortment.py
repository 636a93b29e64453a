"""The assortment sheet: stacked blocks, one per store.

A block is a store-name row, a month-name row and metric rows. A row is understood
by the nearest store row and month row above it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from kpiloom.constants import MONTH_NAMES
from kpiloom.functions.numbers import parse_comma_cell
from kpiloom.functions.retail import value_status
from kpiloom.operators.aggregates import mean_over_stores
from kpiloom.operators.joins import period_spine_join
from kpiloom.operators.periods import forward_fill

# Fixed values -- metric words of the sheet, whether given in percent, status limits.
METRICS = {"Disponibilidad": True, "Profundidad": True, "Gap": False}
LIMITS = {"Disponibilidad": (0.70, True), "Profundidad": (0.60, True), "Gap": (10.0, False)}


def _first_match(text: Column, names: Iterable[str]) -> Column:
    """The first of ``names`` found in ``text``, ignoring case."""
    hits = [F.when(F.lower(text).contains(n.lower()), n) for n in names]
    return F.coalesce(*hits)


def assortment_parse(sheet: DataFrame, year: int | Column, stores: Iterable[str],
                     sheet_key: list[str] = ()) -> DataFrame:
    """Long form: store, month, metric, value (percent metrics as fractions)."""
    text = lambda i: F.trim(F.coalesce(F.get("cells", F.lit(i)), F.lit("")))
    month_of = F.transform("cells", lambda c: F.array_position(
        F.array(*[F.lit(m) for m in MONTH_NAMES]), F.lower(F.trim(F.coalesce(c, F.lit(""))))))
    is_month_row = F.exists("months", lambda m: m > 0)
    rows = sheet.select(*sheet_key, "row_no", "cells", text(0).alias("head"), text(1).alias("side"),
                        month_of.alias("months"))
    store = F.when((F.col("head") == "") & (F.col("side") != ""), _first_match(F.col("side"), stores))
    marked = rows.withColumn("store_here", store).withColumn(
        "months_here", F.when((F.col("head") == "") & F.col("store_here").isNull() & is_month_row, F.col("months")))
    marks = marked.withColumns({
        "s": F.when(F.col("store_here").isNotNull(), F.struct("row_no", "store_here")),
        "m": F.when(F.col("months_here").isNotNull(), F.struct("row_no", "months_here"))})
    filled = forward_fill(marks, sheet_key, "row_no", ["s", "m"])
    metric = _first_match(F.col("head"), METRICS)
    inside = filled.filter((F.col("head") != "") & (F.col("m.row_no") > F.col("s.row_no"))).select(
        *sheet_key, F.col("row_no"), F.col("s.store_here").alias("Tienda"), metric.alias("metric"),
        F.posexplode(F.arrays_zip("cells", F.col("m.months_here").alias("month"))).alias("col", "c"))
    year = year if isinstance(year, Column) else F.lit(year)
    cells = inside.filter(F.col("metric").isNotNull() & (F.col("c.month") > 0) & (F.col("col") > 0)).select(
        *sheet_key, "row_no", "Tienda", F.make_date(year.cast("int"), F.col("c.month").cast("int"), F.lit(1)).alias("Mes"),
        "metric", parse_comma_cell(F.col("c.cells")).alias("number"))
    percent = F.col("metric").isin(*[m for m, pct in METRICS.items() if pct])
    # a metric row met again in the sheet replaces the earlier one
    return (cells.groupBy(*sheet_key, "Tienda", "Mes", "metric").agg(F.max_by("number", "row_no").alias("number"))
            .select(*sheet_key, "Tienda", "Mes", "metric",
                    F.when(percent, F.col("number") / 100).otherwise(F.col("number")).alias("value")))


def assortment_wide(assortment: DataFrame) -> DataFrame:
    """One row per store and month with a column per metric."""
    return assortment.groupBy("Tienda", "Mes").pivot("metric", list(METRICS)).agg(F.max("value"))


def assortment_summary(assortment: DataFrame, stores: Iterable[str] | None = None) -> DataFrame:
    """Month means over stores with status, from the long form.

    With ``stores``, a listed store without figures for a month counts as 0 there.
    """
    wide = assortment_wide(assortment)
    if stores is not None:
        wide = period_spine_join(wide, stores, "Mes", "Tienda")
    means = mean_over_stores(wide, "Mes", list(METRICS))
    return means.withColumns({f"{m}_status": value_status(F.col(m), limit, higher_better=up)
                              for m, (limit, up) in LIMITS.items()})
