"""The plan sheet and plan attainment.

A sheet is ``(row_no, cells)`` as read by ``scan_plan_sheet``. Positions are fixed:
row 0 holds month headers, rows 4 and 6 the two scenarios, and daily rows start
below row 22. Sheets of several years can be stacked with a ``sheet`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kpiloom.constants import WEEKDAY_NAMES
from kpiloom.functions.dates import month_number, parse_day_month, week_sunday
from kpiloom.functions.numbers import parse_decimal_comma, round_half_even
from kpiloom.operators.filters import DateLike
from kpiloom.operators.joins import join_plan_actual
from kpiloom.operators.periods import plan_variance, ytd_attainment

# Fixed values -- positions in the sheet.
HEADER_ROW, V2_ROW, FORECAST_ROW, DAILY_HEADER_ROW = 0, 4, 6, 22
DAILY_COLUMNS = {"NMV_V2": 12, "NSI_V2": 13, "NMV_4+8": 47, "NSI_4+8": 48, "Purchases_4+8": 49}
PLAN_MEASURES = list(DAILY_COLUMNS)
SCENARIOS = {"NMV_V2": "VS_V2", "NMV_4+8": "VS_4p8"}


def _year(year: int | Column) -> Column:
    return year if isinstance(year, Column) else F.lit(year)


def plan_monthly(sheet: DataFrame, year: int | Column, sheet_key: list[str] = ()) -> DataFrame:
    """Month, both scenarios: the header row and two value rows turned on their side."""
    wanted = sheet.filter(F.col("row_no").isin(HEADER_ROW, V2_ROW, FORECAST_ROW))
    year = _year(year)
    cells = wanted.select(*sheet_key, "row_no", year.cast("string").alias("year"),
                          F.posexplode("cells").alias("col", "text"))
    of_row = lambda r: F.max(F.when(F.col("row_no") == r, F.col("text")))
    columns = cells.groupBy(*sheet_key, "year", "col").agg(
        of_row(HEADER_ROW).alias("header"), of_row(V2_ROW).alias("v2"), of_row(FORECAST_ROW).alias("f48"))
    label = F.lower(F.trim("header"))
    for suffix in (F.concat(F.lit("-"), F.substring("year", 3, 2)), F.concat(F.lit("-"), F.col("year"))):
        label = F.replace(label, suffix, F.lit(""))
    months = columns.withColumn("month", month_number(label)).filter(F.col("month").isNotNull())
    return months.select(*sheet_key, F.make_date(F.col("year").cast("int"), "month", F.lit(1)).alias("Mes"),
                         parse_decimal_comma(F.col("v2")).alias("NMV_V2"),
                         parse_decimal_comma(F.col("f48")).alias("NMV_4+8"))


def plan_daily(sheet: DataFrame, year: int | Column) -> DataFrame:
    """Daily rows of the sheet: those that start with a weekday name and have a date."""
    cell = lambda i: F.get("cells", F.lit(i))
    rows = sheet.filter((F.col("row_no") > DAILY_HEADER_ROW) & F.lower(F.trim(cell(0))).isin(*WEEKDAY_NAMES))
    month = F.trim(cell(1)).try_cast("int")
    dated = rows.select(
        parse_day_month(cell(2), _year(year), month).alias("Fecha"), F.trim(cell(0)).alias("Dia"),
        *[parse_decimal_comma(cell(i)).alias(name) for name, i in DAILY_COLUMNS.items()])
    return dated.filter(F.col("Fecha").isNotNull())


def plan_weekly(daily: DataFrame) -> DataFrame:
    """Sunday-week sums of the daily plan in whole numbers, a missing value adding 0."""
    whole = lambda m: round_half_even(F.coalesce(F.sum(f"`{m}`"), F.lit(0.0))).cast("bigint").alias(m)
    return daily.groupBy(week_sunday(F.col("Fecha")).alias("Semana")).agg(*[whole(m) for m in PLAN_MEASURES])


def plan_vs_actual(kpis: DataFrame, plan: DataFrame, period: str) -> DataFrame:
    """Real and planned NMV of every actual period, with the variance to each plan."""
    joined = join_plan_actual(kpis.select(period, "NMV", "NSI"), plan.select(period, "NMV_V2", "`NMV_4+8`"), period)
    gaps = [plan_variance(F.col("NMV"), F.col(f"`{p}`")).alias(out) for p, out in SCENARIOS.items()]
    return joined.select(period, "NMV", "NMV_V2", F.col("`NMV_4+8`").alias("NMV_4p8"), *gaps, "NSI")


def plan_ytd(kpis: DataFrame, plan: DataFrame, period: str, as_of: DateLike) -> DataFrame:
    """Real and planned NMV since 1 January, and attainment of both plans."""
    joined = join_plan_actual(kpis.select(period, "NMV"), plan.select(
        period, "NMV_V2", F.col("`NMV_4+8`").alias("NMV_4p8")), period)
    return ytd_attainment(joined, period, as_of, "NMV", {"NMV_V2": "VS_V2", "NMV_4p8": "VS_4p8"})
