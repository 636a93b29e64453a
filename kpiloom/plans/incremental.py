"""Growth kept up to date by day instead of read anew over the whole lookback.

The stored state has one row per day, purchase and order (and store). A run finds the days that new
and late lines touch, recomputes those from the facts, and leaves the other days' files alone;
growth of any period comes from the state.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from kpiloom.plans.growth import Stores, orders_of_lines, valued_lines
from kpiloom.sources.incremental import changed_days, on_days, read_days, refresh_days


def refresh_orders(order_lines: DataFrame, picks: DataFrame, changed: DataFrame, path: str, first: bool = False,
                   stores: Stores | None = None, grain: str = "day", partition: str | None = None, **lines) -> list[dt.date]:
    """Bring the order state at ``path`` up to date with ``order_lines``; returns the days it recomputed.

    ``changed`` holds the new and changed lines since the last run (order_id, closed_at): those
    of an arrival mark after the last one. ``first`` builds the state from it alone. The state has a
    folder per ``grain``, always the same. ``lines`` goes to ``valued_lines``. Days are bounds on ``closed_at``, and on its ``partition`` column if there
    is one. Picks are joined by order: store them in buckets (``session.bucketed``), or
    limit them to recent ones, so that a small run does not shuffle all of them.
    """
    spark = order_lines.sparkSession
    days = changed_days(changed, "order_id", "closed_at", None if first else read_days(spark, path))

    def build(days: list[dt.date]) -> DataFrame:
        valued = valued_lines(on_days(order_lines, "closed_at", days, partition), picks, **lines)
        return orders_of_lines(valued, "day", stores).withColumnRenamed("period", "day")

    return refresh_days(spark, build, days, path, grain=grain)
