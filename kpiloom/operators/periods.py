"""Windows and period comparisons.

The ``over series`` operators work on marts: at most one row per (key, period), so
a window partition is bounded by the calendar, not by the facts behind it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from kpiloom.functions.dates import as_date, day_before
from kpiloom.functions.numbers import round_half_up, safe_ratio
from kpiloom.operators.aggregates import zero_sum
from kpiloom.operators.filters import DateLike, Partition, from_day, ytd_filter
from kpiloom.operators.joins import range_membership

NEUTRAL_BELOW = 0.001


def order_flag_window(lines: DataFrame, key: str, pred: Column, name: str = "order_flag",
                      known_keys: bool = False) -> DataFrame:
    """Add to every line 1 if any line of its order meets ``pred``, else 0.

    An aggregate joined back instead of a window: partial aggregation collapses an
    order of any size, and AQE can split the join partition of a hot order, while a
    window would sort that order in one task. Lines without a key are one order. ``known_keys``
    says that there are none: the join is then on the key itself and uses its buckets.
    """
    flags = (lines.groupBy(F.col(key).alias("__key"))
             .agg(F.max(F.when(pred, 1).otherwise(0)).alias(name)))
    same = F.col(key) == F.col("__key") if known_keys else F.col(key).eqNullSafe(F.col("__key"))
    return lines.join(flags, same, "left").drop("__key")


def _ordered(key: list[str], order: str) -> Window:
    return Window.partitionBy(*key).orderBy(order)


def prev_non_null_delta(df: DataFrame, key: list[str], order: str, value: str, name: str = "delta") -> DataFrame:
    """Change against the latest earlier non-null value; null if that is 0 or absent."""
    earlier = _ordered(key, order).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.last(value, ignorenulls=True).over(earlier)
    return df.withColumn("prev_value", prev).withColumn(
        name, safe_ratio(F.col(value) - F.col("prev_value"), F.abs("prev_value")))


def delta_direction(delta: Column, higher_better: Column | bool = True) -> Column:
    """``good``, ``bad`` or ``neutral`` (no delta, or smaller than 0.1 %)."""
    better = higher_better if isinstance(higher_better, Column) else F.lit(higher_better)
    return (F.when(delta.isNull() | (F.abs(delta) < NEUTRAL_BELOW), "neutral")
            .when((delta > 0) == better, "good").otherwise("bad"))


def trend_columns(key: list[str], order: str, value: str) -> dict[str, Column]:
    """``point`` (position among non-null values), ``points`` and 0..1 ``height``.

    Null for null values and in series of fewer than two points; a flat series has
    height 0.
    """
    whole = Window.partitionBy(*key)
    so_far = _ordered(key, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    low, high, n = F.min(value).over(whole), F.max(value).over(whole), F.count(value).over(whole)
    span = F.when(high == low, F.lit(1.0)).otherwise((high - low).cast("double"))
    drawn = F.col(value).isNotNull() & (n >= 2)
    return {"point": F.when(drawn, F.count(value).over(so_far) - 1),
            "points": F.when(drawn, n), "height": F.when(drawn, (F.col(value) - low) / span)}


def trend_normalise(df: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """The drawable points of each series, see ``trend_columns``."""
    return df.withColumns(trend_columns(key, order, value)).filter(F.col("point").isNotNull())


def forward_fill(df: DataFrame, by: list[str], order: str, cols: list[str], chunk: int = 50_000) -> DataFrame:
    """Replace each null of ``cols`` by the nearest value above it.

    Rows are filled inside chunks of ``chunk`` consecutive ``order`` numbers; the last
    values of each chunk then carry over to the following ones. No task sees more than
    one chunk, or one row per chunk.
    """
    rows = df.withColumn("__chunk", F.floor(F.col(order) / chunk))
    inside = Window.partitionBy(*by, "__chunk").orderBy(order)
    filled = rows.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in cols})
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__{c}") for c in cols]
    before = Window.partitionBy(*by).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*by, "__chunk").agg(*last).select(
        *by, "__chunk", *[F.last(f"__{c}", ignorenulls=True).over(before).alias(f"__{c}") for c in cols])
    return (filled.join(carried, [*by, "__chunk"], "left")
            .withColumns({c: F.coalesce(c, f"__{c}") for c in cols})
            .drop("__chunk", *[f"__{c}" for c in cols]))


def rolling_anchor(daily: DataFrame, date_col: str, as_of: DateLike) -> DataFrame:
    """One row ``anchor``: the last date, but at most the day before ``as_of``; null
    without dates (``least`` alone would skip that null)."""
    last = F.max(date_col)
    return daily.agg(F.when(last.isNotNull(), F.least(last, day_before(as_of))).alias("anchor"))


def last_n_days(daily: DataFrame, date_col: str, as_of: DateLike, n: int,
                anchor: DataFrame | None = None) -> DataFrame:
    """The closed ``n``-day window ending at the anchor; missing days stay missing."""
    end = (anchor if anchor is not None else rolling_anchor(daily, date_col, as_of)).scalar()
    return daily.filter(F.col(date_col).between(F.date_sub(end, n - 1), end))


def within_days(df: DataFrame, date_col: str, anchor: DataFrame, days: int,
                partition: Partition | None = None) -> DataFrame:
    """Rows of the ``days`` days up to the anchor. The bounds stand on the column itself, so
    that they reach the scan of a fact, and on its ``partition`` column if there is one;
    nothing is kept without an anchor."""
    end = anchor.scalar()
    kept = from_day(df, date_col, F.date_sub(end, days - 1), partition).filter(F.col(date_col) < F.date_add(end, 1))
    return kept if partition is None else kept.filter(F.col(partition[0]) <= end)


def rolling_sums(daily: DataFrame, date_col: str, anchor: DataFrame, width: int, n: int,
                 measures: Iterable[str]) -> DataFrame:
    """Sums per ``width``-day bucket counted back from the anchor; one pass, one
    small shuffle, instead of a scan per bucket."""
    bucketed = range_membership(daily, date_col, anchor.scalar(), width, n)
    return bucketed.groupBy("bucket").agg(*[zero_sum(m).alias(m) for m in measures])


def rolling_spine(anchor: DataFrame, width: int, n: int, prefix: str) -> DataFrame:
    """The ``n`` buckets with label, first and last day; bucket 0 is the latest."""
    last = F.date_sub(F.col("anchor"), F.col("bucket") * width)
    label = F.when(F.col("bucket") == 0, prefix).otherwise(
        F.concat(F.lit(f"{prefix}-"), F.col("bucket").cast("string")))
    return (anchor.filter(F.col("anchor").isNotNull())
            .select("anchor", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("bucket"))
            .select("bucket", label.alias("label"), F.date_sub(last, width - 1).alias("start"), last.alias("end")))


def rolling_periods(daily: DataFrame, as_of: DateLike, width: int, n: int, measures: list[str],
                    date_col: str = "Fecha", prefix: str = "P", anchor: DataFrame | None = None) -> DataFrame:
    """Sums over ``n`` consecutive buckets; a bucket without rows has nulls.

    A known ``anchor`` spares the plan another copy of ``daily``.
    """
    anchor = anchor if anchor is not None else rolling_anchor(daily, date_col, as_of)
    sums = rolling_sums(daily, date_col, anchor, width, n, measures)
    return rolling_spine(anchor, width, n, prefix).join(sums, "bucket", "left")


def window_margin_sum(weekly: DataFrame, week: str, by: list[str], dates: DataFrame, date_col: str,
                      measures: list[str], margin: int = 6) -> DataFrame:
    """Sums of the weeks starting inside the window of ``dates``, or up to
    ``margin`` days before it."""
    first = dates.agg(F.date_sub(F.min(date_col), margin)).scalar()
    last = dates.agg(F.max(date_col)).scalar()
    inside = weekly.filter(F.col(week).between(first, last)).dropna(subset=list(by))
    return inside.groupBy(*by).agg(*[zero_sum(m).alias(m) for m in measures])


def relative_label(df: DataFrame, order: str, prefix: str = "S", last: str = "Ult.sem",
                   name: str = "label", detail: Column | None = None) -> DataFrame:
    """Label periods by their distance from the latest one: ``Ult.sem``, ``S-1`` ...

    Ranks are taken over the distinct periods only, a set bounded by the calendar.
    """
    back = F.row_number().over(Window.orderBy(F.desc(order))) - 1
    ranks = df.select(order).distinct().withColumn("__back", back)
    text = F.when(F.col("__back") == 0, last).otherwise(
        F.concat(F.lit(f"{prefix}-"), F.col("__back").cast("string")))
    if detail is not None:
        text = F.concat(text, F.lit(" ("), detail, F.lit(")"))
    return df.join(ranks.select(order, text.alias(name)), order, "left")


def share_of_total(df: DataFrame, period: str, segment: str, value: str, order: Iterable[str],
                   name: str = "share") -> DataFrame:
    """Whole-percent share of each listed segment within its period.

    Every listed segment appears in every period; unlisted ones count for nothing.
    """
    order = list(order)
    sums = {s: zero_sum(F.when(F.col(segment) == s, F.col(value))) for s in order}
    wide = df.groupBy(period).agg(*[v.alias(f"__{i}") for i, v in enumerate(sums.values())])
    total = sum((F.col(f"__{i}") for i in range(1, len(order))), F.col("__0"))
    cells = F.array(*[F.struct(F.lit(s).alias(segment), F.col(f"__{i}").alias(value))
                      for i, s in enumerate(order)])
    return (wide.select(period, total.alias("__total"), F.explode(cells).alias("c"))
            .select(period, f"c.{segment}", f"c.{value}",
                    F.when(F.col("__total") > 0, round_half_up(F.col(f"c.{value}") / F.col("__total") * 100))
                    .otherwise(0).cast("bigint").alias(name)))


def latest_period(df: DataFrame, order: str, by: list[str] = (), measures: list[str] | None = None) -> DataFrame:
    """The measures of the last period (per ``by`` key), as an aggregate."""
    measures = measures or [c for c in df.columns if c not in (order, *by)]
    row = F.max_by(F.struct(*measures), order)
    return (df.groupBy(*by).agg(F.max(order).alias(order), row.alias("__row"))
            .select(*by, order, "__row.*"))


def ytd_attainment(joined: DataFrame, period: str, as_of: DateLike, real: str, plans: Mapping[str, str]) -> DataFrame:
    """Year-to-date real against plans: ``plans`` maps a plan column to the name of
    its attainment, ``(real - plan) / plan``, given only for a plan above 0."""
    sums = ytd_filter(joined, period, as_of).agg(*[F.sum(c).alias(c) for c in (real, *plans)])
    gap = lambda p: F.when(F.col(p) > 0, safe_ratio(F.col(real) - F.col(p), F.col(p)))
    return sums.select(real, *plans, *[gap(p).alias(out) for p, out in plans.items()])


def plan_variance(real: Column, plan: Column) -> Column:
    """``(real - plan) / |plan|``; null for a plan of 0."""
    return safe_ratio(real - plan, F.abs(plan))
