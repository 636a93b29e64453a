"""Store operations: scorecard rates, cancellations, punctuality, fill."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from kpiloom.constants import LOOKBACK_DAYS, OPS_LOOKBACK_DAYS
from kpiloom.functions.dates import day, to_period
from kpiloom.functions.retail import store_label
from kpiloom.operators.aggregates import rate
from kpiloom.operators.filters import (
    DateLike, equality_filter, lookback_filter, start_date_filter, store_filter, store_filter_cast)

#: Rate -> (numerator, denominator) columns of the scorecard.
RATES = {
    "FR_Items": ("fi_picked", "fi_requested"),
    "FR_Items_Reemplazo": ("fi_picked_replaced", "fi_requested"),
    "FR_Compras": ("fc_complete", "fc_purchases"),
    "FR_Compras_Reemplazo": ("fc_complete_replaced", "fc_purchases"),
    "Compra_Perfecta": ("fc_complete", "fc_purchases"),
    "On_Time": ("ot_on_time", "ot_packs"),
    "Cancel_Rate": ("cr_cancels", "cr_purchases"),
    "Cancel_Buyer": ("cr_buyer_cancels", "cr_purchases"),
    "Cancel_Stockout": ("cr_stockout_cancels", "cr_purchases"),
    "Cancel_Seller": ("cr_seller_cancels", "cr_purchases"),
}
#: Rate -> the column of ``ops_weekly(totals=True)`` that weighs it.
RATE_WEIGHTS = {name: f"{den}_weight" for name, (_, den) in RATES.items()}
STORE_RATES = ("FR_Items", "FR_Items_Reemplazo", "FR_Compras", "Compra_Perfecta", "On_Time", "Cancel_Rate")

#: Columns of the ready-made daily scorecard, defaulted to 0.
SCORECARD_COLUMNS = (
    "cancel_rate", "cancels_total", "cancels_seller", "cancels_buyer", "cancels_stockout", "fill_rate",
    "ot_rate", "ot_early_pct", "ot_delay_pct", "ot_ontime_pct", "perfect_purchase_rate", "total_orders")


def rate_columns(names: Iterable[str] = tuple(RATES)) -> list[Column]:
    return [rate(*RATES[n]).alias(n) for n in names]


def ops_scorecard(scorecard: DataFrame, stores: Iterable[str], as_of: DateLike,
                  days: int = LOOKBACK_DAYS) -> DataFrame:
    """Scorecard rows with nulls as 0."""
    rows = store_filter(lookback_filter(scorecard, "day", as_of, days), "node_id", stores)
    return rows.select(day(F.col("day")).alias("order_date"), F.col("node_id").alias("store_id"),
                       *[F.coalesce(c, F.lit(0)).alias(c) for c in SCORECARD_COLUMNS])


def _of_stores(scorecard: DataFrame, stores: Iterable[str], site: str | None) -> DataFrame:
    rows = equality_filter(scorecard, site=site) if site is not None else scorecard
    return store_filter_cast(rows, "store_id", stores)


def ops_totals(scorecard: DataFrame) -> DataFrame:
    """Sums of the rates' numerators and denominators by day, store and site.

    Rows that ``ops_weekly``, ``ops_daily`` and ``ops_weekly_store`` take for the scorecard's own: store them
    when more than one of those is wanted.
    """
    columns = dict.fromkeys(c for pair in RATES.values() for c in pair)
    return scorecard.groupBy("day", "store_id", "site").agg(*[F.sum(c).alias(c) for c in columns])


def ops_weekly(scorecard: DataFrame, stores: Iterable[str], start: DateLike | None = None,
               site: str | None = None, totals: bool = False) -> DataFrame:
    """The ten rates per week; with ``totals`` also the sum of each rate's denominator."""
    weights = sorted({den for _, den in RATES.values()}) if totals else []
    rows = start_date_filter(_of_stores(scorecard, stores, site), "day", start)
    return rows.groupBy(to_period(F.col("day"), "week").alias("Semana")).agg(
        *rate_columns(), F.sum("cr_purchases").alias("CR_Purchases_total"),
        *[F.sum(c).alias(f"{c}_weight") for c in weights])


def ops_daily(scorecard: DataFrame, stores: Iterable[str], as_of: DateLike, days: int = OPS_LOOKBACK_DAYS,
              site: str | None = None) -> DataFrame:
    rows = lookback_filter(_of_stores(scorecard, stores, site), "day", as_of, days)
    return rows.groupBy(day(F.col("day")).alias("Fecha")).agg(*rate_columns())


def ops_weekly_store(scorecard: DataFrame, stores: Mapping[str, str], start: DateLike | None = None,
                     site: str | None = None) -> DataFrame:
    rows = start_date_filter(_of_stores(scorecard, stores, site), "day", start)
    return rows.groupBy(to_period(F.col("day"), "week").alias("Semana"),
                        store_label(F.col("store_id"), stores).alias("Tienda")).agg(*rate_columns(STORE_RATES))


def _recent(df: DataFrame, stores: Iterable[str], as_of: DateLike, days: int) -> DataFrame:
    return store_filter(lookback_filter(df, "day", as_of, days), "node_id", stores)


def _keys(date_name: str) -> list[Column]:
    return [day(F.col("day")).alias(date_name), F.col("node_id").alias("store_id")]


def cancels_by_type(cancels: DataFrame, stores: Iterable[str], as_of: DateLike,
                    days: int = LOOKBACK_DAYS) -> DataFrame:
    return (_recent(cancels, stores, as_of, days)
            .groupBy(*_keys("cancel_date"), F.upper("reason_type").alias("cancel_type"))
            .agg(F.count("*").alias("cancels")))


def ontime_by_status(packs: DataFrame, stores: Iterable[str], as_of: DateLike,
                     days: int = LOOKBACK_DAYS) -> DataFrame:
    return (_recent(packs, stores, as_of, days)
            .groupBy(*_keys("pack_date"), F.upper("status").alias("ot_status"))
            .agg(F.countDistinct("pack_id").alias("packs")))


def perfect_purchase(perfect_orders: DataFrame, stores: Iterable[str], as_of: DateLike,
                     days: int = LOOKBACK_DAYS) -> DataFrame:
    return _recent(perfect_orders, stores, as_of, days).groupBy(*_keys("order_date")).agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum(F.col("perfect_flag").cast("bigint")).alias("perfect_orders"))


def fill_rate_items(fill_items: DataFrame, stores: Iterable[str], as_of: DateLike,
                    days: int = LOOKBACK_DAYS) -> DataFrame:
    return _recent(fill_items, stores, as_of, days).groupBy(*_keys("order_date")).agg(
        F.sum("ordered").alias("items_ordered"), F.sum("picked").alias("items_picked"),
        rate("picked", "ordered").alias("fill_rate"))
