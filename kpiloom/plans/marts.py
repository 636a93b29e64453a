"""Period marts over the query results: weekly, monthly, daily and rolling KPIs.

All inputs here are period tables (one row per day or week, and store), so their size
follows the calendar. Spark broadcasts the lookups when their measured size allows.
Window and rolling marts read the growth table more than once: give them a stored
table, not a plan that goes back to the order lines.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from kpiloom.constants import DAILY_WINDOW_DAYS
from kpiloom.functions.dates import month_from_yyyymm, month_start, previous_month_end
from kpiloom.functions.numbers import safe_ratio, safe_ratio_nz
from kpiloom.operators.aggregates import mean_of_rates, store_nunique, sum_to_period, zero_sum
from kpiloom.operators.filters import DateLike, between_filter, cutoff_filter
from kpiloom.operators.joins import enrich_period, join_pl_growth
from kpiloom.operators.periods import (
    last_n_days, rolling_anchor, rolling_spine, rolling_sums, window_margin_sum)

GROWTH_MEASURES = ["Compras", "Ordenes", "NMV", "NSI", "TSIE_total"]
STORE_MEASURES = ["Compras", "Ordenes", "NMV", "NSI"]

#: Scorecard name -> column of the ops results.
OPS_NAMES = {
    "FR_Items": "FR_Items", "FR_Items_Remp": "FR_Items_Reemplazo", "FR_Compras": "FR_Compras",
    "FR_Compras_Remp": "FR_Compras_Reemplazo", "Compra_Perfecta": "Compra_Perfecta", "On_Time": "On_Time",
    "Cancel_Rate": "Cancel_Rate", "Cancel_Buyer": "Cancel_Buyer", "Cancel_Stockout": "Cancel_Stockout",
    "Cancel_Seller": "Cancel_Seller"}
OPS_STORE_NAMES = {k: OPS_NAMES[k] for k in (
    "FR_Items", "FR_Items_Remp", "FR_Compras", "Compra_Perfecta", "On_Time", "Cancel_Rate")}

#: Output -> P&L column, as shares of the P&L's own NMV and of growth NMV.
PL_RATIOS = {"Take_Rate": "Net_Monetization", "VC_Over_NMV": "Variable_Contribution",
             "DC_Over_NMV": "Direct_Contribution", "Shipping_Over_NMV": "Shipping_Cost",
             "Promo_Over_NMV": "Promotions"}
PL_GROWTH_SHARES = {
    "TGMV_pct": "TGMV", "Net_Variable_Fee_pct": "Net_Variable_Fee", "Net_Monetization_pct": "Net_Monetization",
    "Product_NetMon_pct": "Product_Net_Monetization", "Shipping_Cost_pct": "Shipping_Cost",
    "Promotions_pct": "Promotions", "Coupons_pct": "Coupons",
    "Variable_Contribution_pct": "Variable_Contribution", "Direct_Contribution_pct": "Direct_Contribution"}


def unit_economics(df: DataFrame) -> DataFrame:
    """Value per purchase and per order, fill rate, pieces per order, orders per purchase."""
    c = F.col
    return df.withColumns({
        "APV_LC": safe_ratio_nz(c("NMV"), c("Compras")),
        "NASP_LC": safe_ratio_nz(c("NMV"), c("Ordenes")),
        "FR_Items": safe_ratio_nz(c("NSI"), c("TSIE_total")),
        "NSI_Cart": safe_ratio_nz(c("NSI"), c("Ordenes")),
        "Ord_Comp": safe_ratio(c("Ordenes"), c("Compras")),
    })


def growth_columns(growth: DataFrame, period: str) -> DataFrame:
    return unit_economics(growth.select(period, *GROWTH_MEASURES)).drop("TSIE_total")


def weekly_kpis(growth: DataFrame, visits: DataFrame, cvr: DataFrame, store_growth: DataFrame,
                as_of: DateLike) -> DataFrame:
    """Closed weeks with unit economics, visits, conversion and active stores."""
    weeks = cutoff_filter(growth_columns(growth, "Fecha"), "Fecha", as_of, "week")
    return enrich_period(weeks, [
        visits.select("Fecha", "Visitas"),
        cvr.select(F.col("Semana").alias("Fecha"), "CVR", "Buyers"),
        store_nunique(store_growth, "Semana", "Tienda").withColumnRenamed("Semana", "Fecha")], "Fecha")


def monthly_kpis(growth: DataFrame, visits: DataFrame, cvr: DataFrame, store_growth: DataFrame,
                 as_of: DateLike) -> DataFrame:
    """Closed months: daily growth and visits, weekly conversion and stores.

    Purchases, buyers and visitors are sums of the finer period's distinct counts.
    """
    months = cutoff_filter(growth_columns(sum_to_period(growth, "Fecha", GROWTH_MEASURES), "Mes"),
                           "Mes", as_of, "month")
    people = sum_to_period(cvr, "Semana", ["Buyers", "Visitors"])
    stores = store_growth.withColumn("Mes", month_start(F.col("Semana")))
    return enrich_period(months, [
        sum_to_period(visits, "Fecha", ["Visitas"]),
        people.withColumn("CVR", safe_ratio(F.col("Buyers"), F.col("Visitors"))),
        store_nunique(stores, "Mes", "Tienda")], "Mes")


def daily_kpis(growth: DataFrame, visits: DataFrame, cvr: DataFrame, as_of: DateLike,
               days: int = DAILY_WINDOW_DAYS, anchor: DataFrame | None = None) -> DataFrame:
    """The last ``days`` days with unit economics, visits and conversion; see ``rolling_kpis`` for ``anchor``."""
    window = last_n_days(growth_columns(growth, "Fecha"), "Fecha", as_of, days, anchor)
    return enrich_period(window, [visits.select("Fecha", "Visitas"), cvr.select("Fecha", "Buyers", "CVR")], "Fecha")


def _ops_select(ops: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    return ops.select(*keys, *[F.col(c).alias(out) for out, c in names.items()])


def weekly_ops_mart(ops_weekly: DataFrame) -> DataFrame:
    return _ops_select(ops_weekly, ["Semana"], OPS_NAMES)


def weekly_ops_store_mart(ops_weekly_store: DataFrame) -> DataFrame:
    return _ops_select(ops_weekly_store, ["Semana", "Tienda"], OPS_STORE_NAMES)


def daily_ops(ops_daily: DataFrame, dates: DataFrame) -> DataFrame:
    """Rates of the days between the first and last of ``dates`` (column ``Fecha``)."""
    first, last = (dates.agg(f("Fecha")).scalar() for f in (F.min, F.max))
    return between_filter(_ops_select(ops_daily, ["Fecha"], OPS_NAMES), "Fecha", first, last)


def monthly_ops(ops_weekly: DataFrame, weights: Mapping[str, str] | None = None) -> DataFrame:
    """Month means of the ten rates; ``weights`` names each rate's denominator, as ``ops.RATE_WEIGHTS`` does."""
    return mean_of_rates(ops_weekly, "Semana", OPS_NAMES, weights=weights)


def monthly_ops_store(ops_weekly_store: DataFrame, weights: Mapping[str, str] | None = None) -> DataFrame:
    return mean_of_rates(ops_weekly_store, "Semana", OPS_STORE_NAMES, ["Tienda"], weights)


def weekly_store_mart(growth_weekly_store: DataFrame) -> DataFrame:
    return growth_weekly_store.select("Semana", "Tienda", *STORE_MEASURES, F.col("TSIE_total").alias("TSIE"))


def weekly_buyers_mart(buyers_weekly_store: DataFrame) -> DataFrame:
    return buyers_weekly_store.select("Semana", "TIENDA", F.col("Buyers").cast("double").alias("Buyers"))


def monthly_buyers_store(buyers_weekly_store: DataFrame) -> DataFrame:
    """Month sums of weekly buyers; see ``buyers_exact`` for distinct ones."""
    return sum_to_period(buyers_weekly_store, "Semana", ["Buyers"], ["TIENDA"])


def buyers_exact(store_sales: DataFrame) -> DataFrame:
    """Distinct buyers per month and store from the sales rows themselves."""
    return (store_sales.groupBy(month_start(F.col("day")).alias("Mes"), F.col("store").alias("TIENDA"))
            .agg(F.countDistinct("buyer_id").alias("Buyers")))


def monthly_store(growth_weekly_store: DataFrame) -> DataFrame:
    return sum_to_period(growth_weekly_store, "Semana", STORE_MEASURES, ["Tienda"])


def daily_store(growth_daily_store: DataFrame) -> DataFrame:
    fill = safe_ratio_nz(F.col("NSI"), F.col("TSIE_total")).alias("FR_Items")
    return growth_daily_store.select("Fecha", "Tienda", *STORE_MEASURES, fill)


def window_store_totals(growth_weekly_store: DataFrame, dates: DataFrame) -> DataFrame:
    """Store totals of the weeks touching the daily window."""
    return window_margin_sum(growth_weekly_store, "Semana", ["Tienda"], dates, "Fecha", STORE_MEASURES)


def rolling_kpis(growth: DataFrame, visits: DataFrame, cvr: DataFrame, as_of: DateLike, width: int, n: int,
                 prefix: str, anchor: DataFrame | None = None) -> DataFrame:
    """``n`` buckets of ``width`` days ending at the last day with growth data.

    ``anchor`` is that day if it is known, as from ``sales_anchor``: without it the plan holds
    ``growth`` once more wherever the day is needed.
    """
    anchor = anchor if anchor is not None else rolling_anchor(growth, "Fecha", as_of)
    sums = lambda df, cols: rolling_sums(df, "Fecha", anchor, width, n, cols)
    people = sums(cvr, ["Buyers", "Visitors"]).select(
        "bucket", safe_ratio(F.col("Buyers"), F.col("Visitors")).alias("CVR"))
    rows = enrich_period(rolling_spine(anchor, width, n, prefix),
                         [sums(growth, GROWTH_MEASURES), sums(visits, ["Visitas"]), people], "bucket")
    return rows.select(
        "bucket", "label", "start", "end", "NMV", "Compras", "Ordenes", "NSI",
        safe_ratio_nz(F.col("NMV"), F.col("Compras")).alias("APV_LC"),
        safe_ratio_nz(F.col("NSI"), F.col("TSIE_total")).alias("FR_Items"), "Visitas", "CVR")


def rolling_7d(growth: DataFrame, visits: DataFrame, cvr: DataFrame, as_of: DateLike,
               anchor: DataFrame | None = None) -> DataFrame:
    return rolling_kpis(growth, visits, cvr, as_of, 7, 14, "P", anchor)


def rolling_28d(growth: DataFrame, visits: DataFrame, cvr: DataFrame, as_of: DateLike,
                anchor: DataFrame | None = None) -> DataFrame:
    return rolling_kpis(growth, visits, cvr, as_of, 28, 7, "P28", anchor)


def pl_month(pl_monthly: DataFrame) -> DataFrame:
    """P&L rows keyed on the first of the month instead of ``yyyymm``."""
    return pl_monthly.withColumn("Mes", month_from_yyyymm(F.col("Mes"))).filter(F.col("Mes").isNotNull())


def pl_ratios(pl_monthly: DataFrame) -> DataFrame:
    """P&L lines with their share of the P&L's NMV, where that is above 0.

    Where it is not, a ratio the input already has is kept.
    """
    given = {out: F.col(out) if out in pl_monthly.columns else F.lit(None).cast("double") for out in PL_RATIOS}
    ratio: dict[str, Column] = {
        out: F.when(F.col("NMV") > 0, safe_ratio(F.col(c), F.col("NMV"))).otherwise(given[out])
        for out, c in PL_RATIOS.items()}
    return pl_month(pl_monthly).withColumns(ratio)


def pl_pct_of_growth(pl_monthly: DataFrame, kpis: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """P&L lines as shares of growth NMV."""
    return join_pl_growth(pl_month(pl_monthly), kpis, "Mes", PL_GROWTH_SHARES, months)


def buyers_table(buyers_store: DataFrame, stores: list[str], period: str = "Semana") -> DataFrame:
    """Buyers per period: a column per listed store, and the total of all stores."""
    one = lambda s: F.sum(F.when(F.col("TIENDA") == s, F.col("Buyers")))
    cells = [F.nullif(one(s), F.lit(0)).alias(s) for s in stores]
    return buyers_store.groupBy(period).agg(F.nullif(zero_sum("Buyers"), F.lit(0)).alias("Total"), *cells)
