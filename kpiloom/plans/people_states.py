"""Buyers and visitors of any period, counted once each, from daily states.

The other marts add up the distinct counts of finer periods, as the scorecard does; these
count people. Store ``people_states`` with ``session.materialise`` and give the stored table
to the rest: the facts are not read again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from kpiloom.functions.dates import day, month_start, to_period
from kpiloom.functions.numbers import safe_ratio
from kpiloom.operators.aggregates import store_nunique
from kpiloom.operators.filters import DateLike, cutoff_filter
from kpiloom.operators.joins import enrich_period, range_membership
from kpiloom.operators.periods import rolling_spine
from kpiloom.operators.states import count_states, distinct_states, unite_states, ytd_counts
from kpiloom.plans.marts import growth_columns, sum_to_period


def people_states(facts: DataFrame, numbers: DataFrame, id_col: str, day_col: str = "day",
                  keys: Iterable[str] = ()) -> DataFrame:
    """Daily states of the people in ``facts``, per day and ``keys``."""
    by = {"day": day(F.col(day_col)), **{k: F.col(k) for k in keys}}
    return distinct_states(facts, by, numbers, id_col)


def people_per_period(states: DataFrame, grain: str, name: str = "Buyers", period: str = "Fecha",
                      keys: Iterable[str] = ()) -> DataFrame:
    """Distinct people per day, week or month, and per each of ``keys``; over all stores where it is left out."""
    return count_states(states, {period: to_period(F.col("day"), grain), **{k: F.col(k) for k in keys}}, name)


def buyers_ytd_exact(states: DataFrame) -> DataFrame:
    """Distinct buyers per month, and from January to that month."""
    months = unite_states(states, {"Mes": month_start(F.col("day"))})
    own = count_states(months, {"Mes": F.col("Mes")}, "Total_Buyers")
    return own.join(ytd_counts(months, "Mes", "YTD_Buyers"), "Mes")


def rolling_people(states: DataFrame, anchor: DataFrame, width: int, n: int, prefix: str, name: str = "Buyers") -> DataFrame:
    """Distinct people of ``n`` buckets of ``width`` days ending at the anchor; 0 where nobody came."""
    inside = range_membership(states, "day", anchor.scalar(), width, n)
    counts = count_states(inside, {"bucket": F.col("bucket")}, name)
    return rolling_spine(anchor, width, n, prefix).join(counts, "bucket", "left").fillna(0, [name])


def conversion_exact(buyers: DataFrame, visitors: DataFrame, period: dict[str, Column]) -> DataFrame:
    """Distinct buyers over distinct visitors per period, from their states."""
    both = count_states(buyers, period, "Buyers").join(count_states(visitors, period, "Visitors"), list(period), "full")
    counts = both.fillna(0, ["Buyers", "Visitors"])
    return counts.withColumn("CVR", safe_ratio(F.col("Buyers"), F.col("Visitors")))


def monthly_kpis_exact(growth_monthly: DataFrame, visits: DataFrame, buyers: DataFrame, visitors: DataFrame,
                       growth_monthly_store: DataFrame, as_of: DateLike) -> DataFrame:
    """``monthly_kpis`` with each purchase, buyer, visitor and store of a month counted once.

    Growth is that of months (``growth_of_lines(lines, "month")``), buyers and visitors
    are daily states.
    """
    months = cutoff_filter(growth_columns(growth_monthly.withColumnRenamed("Fecha", "Mes"), "Mes"), "Mes", as_of, "month")
    return enrich_period(months, [
        sum_to_period(visits, "Fecha", ["Visitas"]),
        conversion_exact(buyers, visitors, {"Mes": month_start(F.col("day"))}),
        store_nunique(growth_monthly_store, "Mes", "Tienda")], "Mes")
