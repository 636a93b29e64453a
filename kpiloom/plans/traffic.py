"""Visits, buyers and conversion."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from kpiloom.constants import LOOKBACK_DAYS, TRAFFIC_EVENTS
from kpiloom.functions.dates import day, to_period
from kpiloom.functions.masks import WEEK_SLOTS, held, row_masks
from kpiloom.operators.filters import (
    DateLike, equality_filter, has_event, lookback_filter, start_date_filter, store_filter)
from kpiloom.operators.joins import full_join_cvr


def visits_daily_store(visits: DataFrame, stores: Iterable[str], as_of: DateLike,
                       days: int = LOOKBACK_DAYS) -> DataFrame:
    recent = store_filter(lookback_filter(visits, "day", as_of, days), "node_id", stores)
    return recent.groupBy(day(F.col("day")).alias("visit_date"), F.col("node_id").alias("store_id")).agg(
        F.sum("sessions").alias("sessions"), F.sum("visitors").alias("unique_visitors"))


def visits_total(visits: DataFrame, grain: str, start: DateLike | None = None, **scope) -> DataFrame:
    """Visits per period; ``scope`` holds equality filters such as site and model."""
    rows = start_date_filter(equality_filter(visits, **scope), "day", start)
    return rows.groupBy(to_period(F.col("day"), grain).alias("Fecha")).agg(F.sum("visits").alias("Visitas"))


def visits_weekly(visits: DataFrame, start: DateLike | None = None, **scope) -> DataFrame:
    return visits_total(visits, "week", start, **scope)


def visits_daily(visits: DataFrame, start: DateLike | None = None, **scope) -> DataFrame:
    return visits_total(visits, "day", start, **scope)


def buyers_weekly_store(store_sales: DataFrame, start: DateLike | None = None) -> DataFrame:
    rows = start_date_filter(store_sales, "day", start)
    return (rows.groupBy(to_period(F.col("day"), "week").alias("Semana"), F.col("store").alias("TIENDA"))
            .agg(F.countDistinct("buyer_id").alias("Buyers")))


def conversion(buyer_orders: DataFrame, traffic: DataFrame, grain: str, name: str, start: DateLike | None = None,
               events: Iterable[str] = TRAFFIC_EVENTS, **scope) -> DataFrame:
    """Distinct buyers over distinct visitors with a listed page event."""
    period = to_period(F.col("day"), grain).alias(name)
    sold, seen = _scoped(buyer_orders, traffic, start, events, scope)
    buyers = sold.groupBy(period).agg(F.countDistinct("buyer_id").alias("Buyers"))
    visitors = seen.groupBy(period).agg(F.countDistinct("user_id").alias("Visitors"))
    return full_join_cvr(buyers, visitors, name)


def _scoped(buyer_orders: DataFrame, traffic: DataFrame, start: DateLike | None, events: Iterable[str],
            scope: dict) -> tuple[DataFrame, DataFrame]:
    """Purchases, and traffic with a listed page event, of the scope."""
    narrow = lambda df: start_date_filter(equality_filter(df, **scope), "day", start)
    return narrow(buyer_orders), narrow(traffic).filter(has_event(F.col("page_events"), events))


def conversion_tallies(buyer_orders: DataFrame, traffic: DataFrame, start: DateLike | None = None,
                       events: Iterable[str] = TRAFFIC_EVENTS, **scope) -> DataFrame:
    """Buyers and visitors by week and by the days of it that they came, as bits of ``mask_0``.

    A person of a week is one row, whatever its days. Few rows: store them once for daily and weekly ``conversion``.
    """
    sold, seen = _scoped(buyer_orders, traffic, start, events, scope)
    slot = F.coalesce(F.dayofweek("day") - 1, F.lit(WEEK_SLOTS - 1))

    def known(people: DataFrame, key: str, name: str) -> DataFrame:
        at = row_masks(F.lit(0), 1, slot, WEEK_SLOTS)[0]
        ids = people.groupBy(to_period(F.col("day"), "week").alias("week"), key).agg(F.bit_or(at).alias("mask_0"))
        return ids.groupBy("week", "mask_0").agg(F.count(key).alias(name))

    return known(sold, "buyer_id", "Buyers").unionByName(known(seen, "user_id", "Visitors"), allowMissingColumns=True)


def conversion_of_tallies(tallies: DataFrame, grain: str, name: str) -> DataFrame:
    """``conversion`` by day or week from ``conversion_tallies``."""
    if grain not in ("day", "week"):
        raise ValueError(f"no tallies by {grain}")
    slots = [[s] for s in range(WEEK_SLOTS)] if grain == "day" else [range(WEEK_SLOTS)]
    cells = held(["mask_0"], [(0, taken, None) for taken in slots], WEEK_SLOTS)

    def people(side: str) -> DataFrame:
        met = tallies.filter(F.col(side).isNotNull()).withColumn("cell", F.explode(cells))
        return met.groupBy(F.date_add("week", F.col("cell.slot")).alias(name)).agg(F.sum(side).alias(side))

    return full_join_cvr(people("Buyers"), people("Visitors"), name)


def cvr_weekly(buyer_orders: DataFrame, traffic: DataFrame, start: DateLike | None = None, tallies: DataFrame | None = None,
               **scope) -> DataFrame:
    """Conversion by week; from ``tallies``, the stored ``conversion_tallies`` of the same facts and options, if given."""
    if tallies is not None:
        return conversion_of_tallies(tallies, "week", "Semana")
    return conversion(buyer_orders, traffic, "week", "Semana", start, **scope)


def cvr_daily(buyer_orders: DataFrame, traffic: DataFrame, start: DateLike | None = None, tallies: DataFrame | None = None,
              **scope) -> DataFrame:
    """The same by day."""
    if tallies is not None:
        return conversion_of_tallies(tallies, "day", "Fecha")
    return conversion(buyer_orders, traffic, "day", "Fecha", start, **scope)
