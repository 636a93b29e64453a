"""Aggregations. ``by`` is a list of key columns (empty for a grand total)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from kpiloom.constants import TOTAL
from kpiloom.functions.dates import month_start
from kpiloom.functions.numbers import safe_ratio
from kpiloom.functions.retail import total_label as total_label_expr
from kpiloom.session import parts_for


def zero_sum(col: str | Column) -> Column:
    """Sum that is 0, not null, for a group of nulls."""
    return F.coalesce(F.sum(col), F.lit(0))


def as_id(df: DataFrame, col: str | Column) -> Column:
    """A text that is equal for equal values and differs for different ones."""
    c = F.col(col) if isinstance(col, str) else col
    kind = df.select(c.alias("c")).schema["c"].dataType
    if isinstance(kind, T.TimestampType):  # its text repeats in the hour that a clock is set back
        return F.unix_micros(c).cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):  # 0 and -0 are equal
        return (c + F.lit(0).cast(kind)).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    return c.cast("string") if isinstance(kind, T.AtomicType) else F.when(c.isNotNull(), F.to_json(F.struct(c)))


def count_distinct(df: DataFrame, by: list[str], cols: Mapping[str, str | Column]) -> DataFrame:
    """Exact distinct counts; ``cols`` maps output names to columns or expressions.

    With several columns, a row becomes one (group, kind, value) row per column. Those are
    made distinct, with map-side combining, over a shuffle that spreads each group by its
    values, and then only counted. Rows are counted and dealt to as many partitions as they need
    first, since the tables of values that a task combines in grow with its rows. Whole numbers
    are not turned into text.
    """
    names = list(cols)
    if len(names) == 1:
        return df.groupBy(*by).agg(F.countDistinct(cols[names[0]]).alias(names[0]))
    given = df.select(*by, *[(F.col(c) if isinstance(c, str) else c).alias(f"__{k}") for k, c in enumerate(cols.values())])
    found = [f"__{k}" for k in range(len(names))]
    whole = all(isinstance(given.schema[c].dataType, T.IntegralType) for c in found)
    ids = [F.col(c).cast("bigint") if whole else as_id(given, c) for c in found]
    dealt = given.repartition(parts_for(given.count()), *ids)
    ids = [F.struct(F.lit(k).alias("kind"), i.alias("id")) for k, i in enumerate(ids)]
    values = dealt.select(*by, F.explode(F.array(*ids)).alias("e")).select(*by, "e.kind", "e.id").distinct()
    known = F.col("id").isNotNull()
    return values.groupBy(*by).agg(*[F.count_if((F.col("kind") == k) & known).alias(out) for k, out in enumerate(names)])


def count_distinct_if(df: DataFrame, by: list[str], col: str | Mapping[str, tuple[str, Column]], cond: Column | None = None,
                      name: str | None = None) -> DataFrame:
    """Distinct values among the rows meeting ``cond``; groups without any count 0.

    For several counts at once, ``col`` maps output names to (column, condition).
    """
    wanted = col if isinstance(col, Mapping) else {name: (col, cond)}
    return count_distinct(df, by, {out: F.when(c, F.col(value)) for out, (value, c) in wanted.items()})


def count_if(df: DataFrame, by: list[str], conds: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.count_if(c).alias(out) for out, c in conds.items()])


def count_star(df: DataFrame, by: list[str], name: str = "rows") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(name))


def sum_rounded(df: DataFrame, by: list[str], cols: Mapping[str, str], digits: int) -> DataFrame:
    return df.groupBy(*by).agg(*[F.round(F.sum(c), digits).alias(out) for out, c in cols.items()])


def sum_flag(df: DataFrame, by: list[str], flag: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(F.col(flag).cast("bigint")).alias(name))


def rate(num: str | Column, den: str | Column, digits: int = 4) -> Column:
    """Rounded sum over sum; null when the denominator adds up to 0."""
    return F.round(safe_ratio(F.sum(num), F.sum(den)), digits)


def ratio_of_sums(df: DataFrame, by: list[str], rates: Mapping[str, tuple[str, str]], digits: int = 4) -> DataFrame:
    """``rates`` maps output names to (numerator, denominator) columns."""
    return df.groupBy(*by).agg(*[rate(n, d, digits).alias(out) for out, (n, d) in rates.items()])


def sum_times_avg(df: DataFrame, by: list[str], value: str, factor: str, name: str, digits: int = 0) -> DataFrame:
    """Sum of a value times the average non-zero factor of the group."""
    total = F.sum(value) * F.avg(F.nullif(F.col(factor), F.lit(0)))
    return df.groupBy(*by).agg(F.round(total, digits).alias(name))


def sum_coalesced(df: DataFrame, by: list[str], first: str, second: str, name: str, digits: int = 0) -> DataFrame:
    return df.groupBy(*by).agg(F.round(F.sum(F.coalesce(first, second)), digits).alias(name))


def group_by_all(df: DataFrame) -> DataFrame:
    """Grouping by every column with no aggregate: distinct rows."""
    return df.distinct()


def select_distinct(df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.select(*cols).distinct()


def group_by_ordinals(df: DataFrame, *keys: int, aggs: list[Column]) -> DataFrame:
    """Group by 1-based column positions."""
    return df.groupBy(*[df.columns[k - 1] for k in keys]).agg(*aggs)


def grouping_sets(df: DataFrame, sets: list[list[str]], keys: list[str], aggs: list[Column]) -> DataFrame:
    """Several groupings of ``keys`` in one pass."""
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *keys).agg(*aggs)


def total_label(df: DataFrame, keys: list[str], key: str, aggs: list[Column], label: str = TOTAL,
                unmapped: str | None = None) -> DataFrame:
    """Groups of ``keys`` plus their subtotals over ``key``, labelled."""
    others = [k for k in keys if k != key]
    named = total_label_expr(key, label, unmapped).alias("__label")
    return (grouping_sets(df, [keys, others], keys, [named, *aggs])
            .drop(key).withColumnRenamed("__label", key))


def nps_score(df: DataFrame, by: list[str], bucket: str, weight: str | None = None) -> DataFrame:
    """Score and counts from -1/0/1 buckets; ``weight`` if rows stand for several."""
    w = F.col(weight) if weight else F.lit(1)
    n = lambda b: F.sum(F.when(F.col(bucket) == b, w).otherwise(0)).cast("bigint")
    score = F.round(safe_ratio(n(1) - n(-1), F.sum(w)) * 100, 0)
    return df.groupBy(*by).agg(
        score.alias("NPS_Score"), F.sum(w).cast("bigint").alias("Total_Responses"),
        n(1).alias("Promotores"), n(0).alias("Neutros"), n(-1).alias("Detractores"))


def mean_of_rates(df: DataFrame, period: str, rates: Mapping[str, str] | list[str], by: list[str] = (),
                  weights: Mapping[str, str] | None = None, month: str = "Mes") -> DataFrame:
    """Month mean of weekly rates, a week counting for the month of its first day.

    Unweighted unless ``weights`` names each rate's denominator column; nulls are skipped.
    """
    rates = rates if isinstance(rates, Mapping) else {r: r for r in rates}

    def mean(c: str) -> Column:
        weight = (weights or {}).get(c)
        if weight is None:
            return F.avg(c)
        known = F.when(F.col(c).isNotNull(), F.col(weight))
        return safe_ratio(F.sum(F.col(c) * F.col(weight)), F.sum(known))

    keyed = df.withColumn(month, month_start(F.col(period))).dropna(subset=[month, *by])
    return keyed.groupBy(month, *by).agg(*[mean(c).alias(out) for out, c in rates.items()])


def sum_to_period(df: DataFrame, date_col: str, measures: list[str], by: list[str] = (),
                  month: str = "Mes") -> DataFrame:
    """Month sums of daily or weekly measures; nulls add 0, null keys are dropped."""
    keyed = df.withColumn(month, month_start(F.col(date_col))).dropna(subset=[month, *by])
    return keyed.groupBy(month, *by).agg(*[zero_sum(m).alias(m) for m in measures])


def store_nunique(df: DataFrame, period: str, store: str, name: str = "Stores") -> DataFrame:
    """Active stores per period."""
    return df.groupBy(period).agg(F.countDistinct(store).alias(name))


def accumulate_pairs(df: DataFrame, by: list[str], measures: list[str], digits: int = 2) -> DataFrame:
    """Sums per key combination, rounded once at the end."""
    return df.groupBy(*by).agg(*[F.round(zero_sum(m), digits).alias(m) for m in measures])


def total_over_stores(df: DataFrame, period: str, value: str, name: str = "Total") -> DataFrame:
    """Period total over stores; a total of 0 is null."""
    return df.groupBy(period).agg(F.nullif(zero_sum(value), F.lit(0)).alias(name))


def grand_total_row(df: DataFrame, by: list[str], measures: list[str], key: str, label: str = "TOTAL") -> DataFrame:
    """A breakdown by ``key`` with a totals row under each ``by`` group."""
    sums = [zero_sum(m).alias(m) for m in measures]
    return total_label(df, [*by, key], key, sums, label)


def mean_over_stores(df: DataFrame, period: str, cols: list[str]) -> DataFrame:
    """Period mean over stores, a missing value counting as 0."""
    return df.groupBy(period).agg(*[F.avg(F.coalesce(c, F.lit(0))).alias(c) for c in cols])


def running_total_sum(df: DataFrame, cols: list[str], by: list[str] = ()) -> DataFrame:
    """Sums of the rows that have a value; null if none has."""
    return df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in cols])
