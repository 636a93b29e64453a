"""Distinct counts that add up: a state per day and group, united to any period.

A distinct count of months can't be had from those of days, a union of sets can. Exact
states are bitmaps of numbered ids, 32,768 numbers to a row, so that a group of any size is
many small rows; approximate ones are one sketch of a few kilobytes. Both are computed from
the facts once and stored; months, years, rolling windows and store totals read only them.

``by`` maps output names to expressions over the states' columns (empty for one total).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Columns of an exact state beside its keys: the range of numbers, and which of them occur.
STATE = ["chunk", "bits"]


def number_ids(ids: DataFrame, col: str, known: DataFrame | None = None, parts: int = 256) -> DataFrame:
    """Dense numbers from 1 for the distinct ids of ``col``: ``(id, number)``; null has none.

    Ids of ``known`` (an earlier result) keep their numbers, and new ones follow, so stored
    states stay valid. Numbers depend on the ids alone: they are counted inside ``parts`` hash
    parts, and only one row per part is looked at together.
    """
    new = ids.select(F.col(col).alias("id")).where("id is not null").distinct()
    base = F.lit(0)
    if known is not None:
        new = new.join(known.select("id"), "id", "left_anti")
        base = F.coalesce(known.agg(F.max("number")).scalar(), F.lit(0))
    dealt = new.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
    sizes = dealt.groupBy("part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("id"))
    numbered = dealt.withColumn("place", place).join(offsets, "part").select(
        "id", (base + F.col("offset") + F.col("place")).cast("bigint").alias("number"))
    return numbered if known is None else known.select("id", "number").unionByName(numbered)


def distinct_states(df: DataFrame, by: Mapping[str, Column], numbers: DataFrame, col: str) -> DataFrame:
    """Exact states of the ids of ``col`` per ``by`` group: the keys, ``chunk`` and ``bits``.

    ``numbers`` comes from ``number_ids``. Ids without a number, and nulls, don't count. Rows
    are first reduced to distinct (group, id) pairs with map-side combining.
    """
    keyed = df.select(*[e.alias(k) for k, e in by.items()], F.col(col).alias("id")).where("id is not null").distinct()
    numbered = keyed.join(numbers, "id")
    return numbered.groupBy(*by, F.bitmap_bucket_number("number").alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def unite_states(states: DataFrame, by: Mapping[str, Column]) -> DataFrame:
    """States of the groups ``by`` from finer ones."""
    return states.groupBy(*[e.alias(k) for k, e in by.items()], "chunk").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_states(states: DataFrame, by: Mapping[str, Column], name: str) -> DataFrame:
    """Distinct ids per ``by`` group, exactly."""
    return unite_states(states, by).groupBy(*by).agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias(name))


def spread_states(states: DataFrame, date_col: str, last: Column) -> DataFrame:
    """Each state once for every date of the states from its own to ``last``: the input of running counts.

    Copies are made of states, not of facts; unite the states per period first.
    """
    dates = states.select(F.col(date_col).alias("__until")).distinct()
    first = states.select(F.col(date_col).alias("__from"), last.alias("__last")).distinct()
    # pairs of dates, a table of the calendar's size; equal years and months keep the join on keys
    reach = first.select("__from", F.explode(F.sequence("__from", F.greatest("__from", "__last"))).alias("__until"))
    pairs = reach.join(dates, "__until")
    return states.join(pairs, F.col(date_col) == F.col("__from")).drop(date_col, "__from").withColumnRenamed("__until", date_col)


def ytd_counts(states: DataFrame, date_col: str, name: str, by: Mapping[str, Column] | None = None) -> DataFrame:
    """Distinct ids from 1 January to each date of ``states``; dates are days or first days of months."""
    by = by or {}
    spread = spread_states(states, date_col, F.make_date(F.year(date_col), F.lit(12), F.lit(31)))
    return count_states(spread, {date_col: F.col(date_col), **by}, name)


def trailing_counts(states: DataFrame, date_col: str, days: int, name: str, by: Mapping[str, Column] | None = None) -> DataFrame:
    """Distinct ids of the ``days`` days up to each date of ``states``."""
    by = by or {}
    spread = spread_states(states, date_col, F.date_add(date_col, days - 1))
    return count_states(spread, {date_col: F.col(date_col), **by}, name)


def sketch_states(df: DataFrame, by: Mapping[str, Column], col: str, lg_k: int = 12) -> DataFrame:
    """Approximate states: one sketch per group, of ids of any type, without numbers.

    The relative standard error of a count is about 1.04 / sqrt(2 ** lg_k), 1.6 % by default,
    and that of a union no larger.
    """
    return df.groupBy(*[e.alias(k) for k, e in by.items()]).agg(F.hll_sketch_agg(col, lg_k).alias("sketch"))


def unite_sketches(states: DataFrame, by: Mapping[str, Column]) -> DataFrame:
    return states.groupBy(*[e.alias(k) for k, e in by.items()]).agg(F.hll_union_agg("sketch").alias("sketch"))


def count_sketches(states: DataFrame, by: Mapping[str, Column], name: str) -> DataFrame:
    """Distinct ids per ``by`` group, approximately."""
    return unite_sketches(states, by).select(*by, F.hll_sketch_estimate("sketch").alias(name))
