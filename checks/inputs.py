"""Period results on the generated tables, shared by the checks of the marts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.registry import shared_path
from kpiloom import bindings as b, plans
from kpiloom.operators.periods import within_days
from kpiloom.session import bucketed, materialise, parts_for

SCOPE = {"site": "S1", "marketplace": "TM", "pick_keys": b.PICK_KEYS}
START = "1995-01-03"
#: Lookbacks reach back past the first row from here; cutoffs lie near the last one.
LOOKBACK_AS_OF = "1996-01-15"
AS_OF = "2001-07-15"
SHIP_START = "1993-01-01"


def g_day(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    return plans.growth_daily_net(b.order_lines(spark, sf), b.picks(spark, sf), START, valued=lines, **SCOPE)


def g_week(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    return plans.growth_weekly(b.order_lines(spark, sf), b.picks(spark, sf), START, valued=lines, **SCOPE)


def g_week_store(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    return plans.growth_weekly_store(b.order_lines(spark, sf), b.picks(spark, sf), b.STORES, START, valued=lines, **SCOPE)


def g_day_store(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    return plans.growth_daily_store(b.order_lines(spark, sf), b.picks(spark, sf), b.STORES, START, valued=lines, **SCOPE)


def v_day(spark: SparkSession, sf: str) -> DataFrame:
    return plans.visits_daily(b.order_visits(spark, sf))


def v_week(spark: SparkSession, sf: str) -> DataFrame:
    return plans.visits_weekly(b.order_visits(spark, sf))


def c_day(spark: SparkSession, sf: str, counted: DataFrame | None = None) -> DataFrame:
    return plans.cvr_daily(b.order_buyers(spark, sf), b.order_traffic(spark, sf), tallies=counted)


def c_week(spark: SparkSession, sf: str, counted: DataFrame | None = None) -> DataFrame:
    return plans.cvr_weekly(b.order_buyers(spark, sf), b.order_traffic(spark, sf), tallies=counted)


def c_tallies(spark: SparkSession, sf: str) -> DataFrame:
    return plans.conversion_tallies(b.order_buyers(spark, sf), b.order_traffic(spark, sf))


def o_week(spark: SparkSession, sf: str, totals: DataFrame | None = None) -> DataFrame:
    return plans.ops_weekly(totals if totals is not None else b.scorecard(spark, sf), b.STORE_IDS, SHIP_START, "S1")


def o_day(spark: SparkSession, sf: str, totals: DataFrame | None = None) -> DataFrame:
    return plans.ops_daily(totals if totals is not None else b.scorecard(spark, sf), b.STORE_IDS, SHIP_START, site="S1")


def o_week_store(spark: SparkSession, sf: str, totals: DataFrame | None = None) -> DataFrame:
    return plans.ops_weekly_store(totals if totals is not None else b.scorecard(spark, sf), b.STORE_IDS, SHIP_START, "S1")


def b_week_store(spark: SparkSession, sf: str) -> DataFrame:
    return plans.buyers_weekly_store(b.store_sales(spark, sf))


def valued(spark: SparkSession, sf: str) -> DataFrame:
    """The valued lines behind marts of several growth results; a job of its own would store them first."""
    return plans.valued_lines(b.order_lines(spark, sf), b.picks(spark, sf), START, **SCOPE)


def stored_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``valued``, computed once for all growth results: an order's lines share a bucket, so its sums need no shuffle."""
    count = parts_for(b.picks(spark, sf).count(), spark.sparkContext.defaultParallelism)
    return bucketed(valued(spark, sf), shared_path(spark, "valued"), f"valued_{uuid.uuid4().hex}", ["order_id"], count, most_rows=None)


def tallies(spark: SparkSession, sf: str) -> DataFrame:
    """What the four growth results count, from one pass over the lines: those of an order are dealt to one partition."""
    count = parts_for(b.picks(spark, sf).count(), spark.sparkContext.defaultParallelism)
    lines = plans.lines_by_week(valued(spark, sf).repartition(count, "order_id"), b.STORES)
    return plans.growth_tallies(bucketed(lines, shared_path(spark, "weeklines"), f"weeklines_{uuid.uuid4().hex}", ["order_id"], count, most_rows=None))


def growth_results(counted: DataFrame) -> dict[str, DataFrame]:
    """The growth results of stored ``tallies``."""
    of = lambda *options: plans.growth_of_tallies(counted, options[0], b.STORES, *options[1:])
    return {"growth_week": of("week"), "growth_day": of("day"), "growth_week_store": of("week", True, "Semana"), "growth_day_store": of("day", True)}


def k_week(spark: SparkSession, sf: str) -> DataFrame:
    lines = valued(spark, sf)
    by_store = plans.growth_of_lines(lines, "week", b.STORES, name="Semana")
    return plans.weekly_kpis(plans.growth_of_lines(lines, "week"), v_week(spark, sf), c_week(spark, sf), by_store, AS_OF)


def k_month(spark: SparkSession, sf: str) -> DataFrame:
    lines = valued(spark, sf)
    by_store = plans.growth_of_lines(lines, "week", b.STORES, name="Semana")
    return plans.monthly_kpis(plans.growth_of_lines(lines, "day"), v_day(spark, sf), c_week(spark, sf), by_store, AS_OF)


def window(spark: SparkSession, sf: str, days: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Daily growth, visits and conversion of the last ``days`` days with sales, and the last day; only those are read.

    The day is a stored row: a plan that names it many times does not hold its pass over the lines each time.
    """
    lines = b.order_lines(spark, sf)
    anchor = materialise(plans.sales_anchor(lines, AS_OF, START, site="S1", marketplace="TM"), shared_path(spark, "anchor"))
    recent = lambda df, column="day": within_days(df, column, anchor, days)
    sold = plans.growth_daily_net(recent(lines, "closed_at"), b.picks(spark, sf), START, **SCOPE)
    return (sold, plans.visits_daily(recent(b.order_visits(spark, sf))),
            plans.cvr_daily(recent(b.order_buyers(spark, sf)), recent(b.order_traffic(spark, sf))), anchor)


def k_day(spark: SparkSession, sf: str) -> DataFrame:
    *facts, anchor = window(spark, sf, 28)
    return plans.daily_kpis(*facts, AS_OF, anchor=anchor)


def rolled_28d(spark: SparkSession, sf: str) -> DataFrame:
    *facts, anchor = window(spark, sf, 7 * 28)
    return plans.rolling_28d(*facts, AS_OF, anchor)


def nps(spark: SparkSession, sf: str) -> DataFrame:
    return plans.nps_monthly(b.survey(spark, sf), b.order_lines(spark, sf), b.STORES, "SHOP", "S1", unmapped="unmapped")


def assortment(spark: SparkSession, sf: str, sheet: DataFrame | None = None) -> DataFrame:
    return plans.assortment_parse(sheet if sheet is not None else b.assortment_sheet(spark, sf), F.col("sheet"), list(b.STORES.values()), ["sheet"])
