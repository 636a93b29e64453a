"""Row filters and unnesting (DataFrame -> DataFrame).

Every predicate is a plain comparison on a source column, so it reaches the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kpiloom.constants import CANCELLED, INVALID, LOOKBACK_DAYS
from kpiloom.functions.dates import as_date, day_before, previous_month_end, to_period
from kpiloom.functions.retail import store_label as store_label_expr

DateLike = str | dt.date


def unnest_items(df: DataFrame, items_col: str, alias: str = "item") -> DataFrame:
    """One row per nested item; rows without items disappear."""
    rest = [c for c in df.columns if c != items_col]
    return df.select(*rest, F.explode(items_col).alias(alias))


def unnest_events(df: DataFrame, events_col: str, names: Iterable[str], alias: str = "event") -> DataFrame:
    """One row per nested event whose ``name`` is listed."""
    return unnest_items(df, events_col, alias).filter(F.col(f"{alias}.name").isin(*names))


def has_event(events: Column, names: Iterable[str]) -> Column:
    """True where any nested event is listed: the filter without row growth."""
    return F.arrays_overlap(events.getField("name"), F.array(*[F.lit(n) for n in names]))


def has_tag(tags: Column, substring: str, ignore_case: bool = False) -> Column:
    """True where the comma-joined tags contain ``substring``."""
    joined = F.array_join(tags, ",")
    return (F.lower(joined) if ignore_case else joined).contains(substring)


def tag_filter(df: DataFrame, tags: str | Column, substring: str) -> DataFrame:
    """Rows whose comma-joined tags contain ``substring``; null and empty arrays go."""
    return df.filter(has_tag(F.col(tags) if isinstance(tags, str) else tags, substring))


def store_filter(df: DataFrame, node_col: str, stores: Iterable[str] | DataFrame, key: str = "node_id") -> DataFrame:
    """Rows of the listed stores: a list in code, or the ``key`` column of a stores table.

    A table becomes a semi join on the column itself. Spark broadcasts it if its size allows
    and otherwise shuffles both; on a fact that is partitioned by the column, it prunes folders at run time.
    """
    if not isinstance(stores, DataFrame):
        return df.filter(F.col(node_col).isin(*stores))
    kept = stores.select(F.col(key).alias("__store")).distinct()
    return df.join(kept, F.col(node_col) == F.col("__store"), "left_semi")


def store_filter_cast(df: DataFrame, id_col: str, ids: Iterable[str]) -> DataFrame:
    """Like ``store_filter`` on an id that is compared as text."""
    return df.filter(F.col(id_col).cast("string").isin(*ids))


def status_filter(df: DataFrame, status_col: str, excluded: Iterable[str] = (CANCELLED, INVALID)) -> DataFrame:
    """Rows whose status is known and not excluded."""
    return df.filter(~F.col(status_col).isin(*excluded))


def flag_filter(df: DataFrame, col: str, want: bool = True) -> DataFrame:
    """``IS TRUE`` when ``want``, else ``IS NOT TRUE`` (false and null)."""
    is_true = F.col(col).eqNullSafe(F.lit(True))
    return df.filter(is_true if want else ~is_true)


def equality_filter(df: DataFrame, **eq) -> DataFrame:
    return reduce(lambda d, kv: d.filter(F.col(kv[0]) == kv[1]), eq.items(), df)


#: A column of a partitioned table that holds the day, week or month of a date, and which of them.
Partition = tuple[str, str]


def from_day(df: DataFrame, date_col: str, first: Column, partition: Partition | None = None) -> DataFrame:
    """Rows from the day ``first`` on. With ``partition``, such as ``("month", "month")``, the table's folders
    are pruned too, not only its row groups."""
    kept = df.filter(F.col(date_col) >= first)
    return kept if partition is None else kept.filter(F.col(partition[0]) >= to_period(first, partition[1]))


def lookback_filter(df: DataFrame, date_col: str, as_of: DateLike, days: int = LOOKBACK_DAYS,
                    partition: Partition | None = None) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of`` (and later ones)."""
    return from_day(df, date_col, F.date_sub(as_date(as_of), days), partition)


def start_date_filter(df: DataFrame, date_col: str, start: DateLike | None, partition: Partition | None = None) -> DataFrame:
    return df if start is None else from_day(df, date_col, as_date(start), partition)


def like_filter(df: DataFrame, col: str, text: str) -> DataFrame:
    return df.filter(F.col(col).contains(text))


def not_null_filter(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


def value_set_filter(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def between_filter(df: DataFrame, date_col: str, lo, hi) -> DataFrame:
    """Closed date window; bounds are dates, ISO texts or columns."""
    return df.filter(F.col(date_col).between(as_date(lo), as_date(hi)))


def cutoff_filter(df: DataFrame, period_col: str, as_of: DateLike, grain: str) -> DataFrame:
    """Closed periods only: days up to the day before ``as_of``, weeks and months
    that start by the end of the previous month."""
    limit = day_before(as_of) if grain == "day" else previous_month_end(as_of)
    return df.filter(F.col(period_col) <= limit)


def ytd_filter(df: DataFrame, period_col: str, as_of: DateLike) -> DataFrame:
    """Periods from 1 January of the year of ``as_of``."""
    return df.filter(F.col(period_col) >= F.trunc(as_date(as_of), "year"))


def store_label(df: DataFrame, node_col: str, stores: Mapping[str, str] | DataFrame, name: str = "Tienda",
                key: str = "node_id", label: str = "store_name") -> DataFrame:
    """Add the store name of a node id; null when the id is not listed.

    A mapping becomes a CASE expression; a stores table is joined, and Spark
    broadcasts it only if its size allows.
    """
    if isinstance(stores, Mapping):
        return df.withColumn(name, store_label_expr(F.col(node_col), stores))
    lookup = stores.select(F.col(key).cast("string").alias("__node"), F.col(label).alias(name))
    return (df.withColumn("__id", F.col(node_col).cast("string"))
            .join(lookup, F.col("__id") == F.col("__node"), "left").drop("__node", "__id"))
