"""Joins. No broadcast hints: Spark sizes the sides, AQE splits skewed keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from kpiloom.functions.numbers import positive_ratio, safe_ratio


def join_picks(lines: DataFrame, picks: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Order lines with their pick details; unpicked lines are kept.

    Both sides are facts, so this is always a sort-merge join: no side is broadcast
    because it looked small once compressed. ``keys`` should tell the lines of an order apart.
    """
    return lines.join(picks.hint("merge"), list(keys), "left")


def join_claims_orders(claims: DataFrame, orders: DataFrame, key: str = "order_id") -> DataFrame:
    """Claims of the given orders. Both sides are reduced to distinct rows first,
    so an order with a great many claims is collapsed before the shuffle join."""
    return claims.distinct().join(orders.distinct(), key)


def join_survey_store(survey: DataFrame, order_store: DataFrame, key: str = "order_id") -> DataFrame:
    """Survey rows with the stores of their order, ids compared as text."""
    as_text = F.col(key).cast("string")
    return survey.withColumn(key, as_text).join(order_store.withColumn(key, as_text), key, "left")


def full_join_cvr(buyers: DataFrame, visitors: DataFrame, period: str) -> DataFrame:
    """Buyers and visitors of every period of either side, with their ratio."""
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    both = buyers.join(visitors, period, "full").select(period, count("Buyers"), count("Visitors"))
    return both.withColumn("CVR", F.round(safe_ratio(F.col("Buyers"), F.col("Visitors")), 4))


def enrich_period(base: DataFrame, others: Iterable[DataFrame], period: str | list[str]) -> DataFrame:
    """Left lookups on the period: only the periods of ``base`` remain."""
    for other in others:
        base = base.join(other, period, "left")
    return base


def join_plan_actual(actual: DataFrame, plan: DataFrame, period: str) -> DataFrame:
    """The plan of every actual period."""
    return actual.join(plan, period, "left")


def join_pl_growth(pl: DataFrame, growth: DataFrame, month: str, lines: Mapping[str, str],
                   months: DataFrame | None = None) -> DataFrame:
    """P&L lines over growth NMV for months found on either side.

    ``lines`` maps output names to P&L columns; ``months`` restricts the result.
    """
    pl = pl.select(month, *[F.col(c).cast("double").alias(f"__{out}") for out, c in lines.items()])
    joined = pl.join(growth.select(month, F.nullif(F.col("NMV"), F.lit(0)).alias("NMV")), month, "full")
    if months is not None:
        joined = joined.join(months.select(month).distinct(), month, "left_semi")
    return joined.select(month, "NMV", *[positive_ratio(F.col(f"__{out}"), F.col("NMV")).alias(out) for out in lines])


def period_spine_join(mart: DataFrame, stores: Iterable[str], period: str, store: str,
                      periods: DataFrame | None = None) -> DataFrame:
    """Every listed store in every period; missing cells have null measures."""
    spine = ((periods if periods is not None else mart).select(period).distinct()
             .withColumn(store, F.explode(F.array(*[F.lit(s) for s in stores]))))
    return spine.join(mart, [period, store], "left")


def range_membership(daily: DataFrame, date_col: str, anchor, width: int, n: int) -> DataFrame:
    """Number the ``width``-day bucket of each date, 0 ending at ``anchor``.

    The bucket is arithmetic on the day distance, so no range join is needed; dates
    outside the ``n`` buckets are dropped by bounds on the column itself, which reach the scan.
    """
    inside = (F.col(date_col) >= F.date_sub(anchor, width * n - 1)) & (F.col(date_col) < F.date_add(anchor, 1))
    return daily.filter(inside).withColumn("bucket", F.floor(F.date_diff(anchor, F.col(date_col)) / width).cast("int"))


def period_membership(daily: DataFrame, date_col: str, periods: DataFrame, start: str = "start", end: str = "end",
                      bin_days: int = 32) -> DataFrame:
    """Each row of ``daily`` beside every period of ``periods`` that its date lies in, both ends included.

    Periods may overlap, leave gaps, and be of any length; one without a start or an end, or
    that ends before it starts, holds no date. Dates and periods meet by bins of ``bin_days`` days, a
    join on equal keys, and then by their exact bounds. Columns of ``periods`` must not
    repeat those of ``daily``.
    """
    number = lambda c: F.floor(F.date_diff(F.to_date(c), F.lit("1970-01-01").cast("date")) / bin_days)
    spans = periods.filter(F.col(start) <= F.col(end))
    binned = spans.select("*", F.explode(F.sequence(number(start), number(end))).alias("__bin"))
    first, last = (spans.agg(f(F.to_date(c)).alias("d")).scalar() for f, c in ((F.min, start), (F.max, end)))
    dated = daily.filter((F.col(date_col) >= first) & (F.col(date_col) < F.date_add(last, 1)))
    met = dated.withColumn("__bin", number(date_col)).join(binned, "__bin")
    return met.filter(F.to_date(date_col).between(F.to_date(start), F.to_date(end))).drop("__bin")


def period_sums(daily: DataFrame, date_col: str, periods: DataFrame, measures: Iterable[str], start: str = "start",
                end: str = "end") -> DataFrame:
    """Sums of ``measures`` over each row of ``periods``; 0 for a period without rows.

    Days are summed before they meet the periods, so a fact is shuffled by day only.
    """
    measures, keys = list(measures), periods.columns
    days = daily.groupBy(F.to_date(date_col).alias("__day")).agg(*[F.sum(m).alias(f"__{m}") for m in measures])
    met = period_membership(days, "__day", periods.distinct(), start, end)
    sums = met.groupBy(*keys).agg(*[F.sum(f"__{m}").alias(m) for m in measures])
    all_keys = periods.alias("p").join(sums.alias("s"), [F.col(f"p.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], "left")
    return all_keys.select(*[F.col(f"p.{k}").alias(k) for k in keys],
                           *[F.coalesce(F.col(f"s.{m}"), F.lit(0)).alias(m) for m in measures])
