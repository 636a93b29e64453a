"""Positional spreadsheet exports (CSV without a usable header).

A sheet is a DataFrame ``(row_no, cells)``: the 0-based row number over all files of
the path in name order, and all cells of the row as an array of strings, null where
empty.

A cell that begins with a quote may hold commas, doubled quotes and line breaks up to the
quote that closes it; what follows that quote is kept as it is. A quote elsewhere is a character
like any other, so ``5" screen`` is one cell. A quoted cell that nothing closes ends with its file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: The inside of a quoted cell, and a cell after a comma. Rows get a comma in front.
QUOTED = r'[^"]*+(?:""[^"]*+)*+'
CELL = rf',("{QUOTED}(?:"[^,]*+|\z)|[^,]*+)'
SPLIT = ["file", "split_start"]


def _before_split(lines: DataFrame, *sums: Column) -> DataFrame:
    """Totals of each input split, and their running sums over the splits before it.

    One row per split passes through one task, not one per line.
    """
    totals = lines.groupBy(*SPLIT).agg(*sums)
    earlier = Window.orderBy(*SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    names = [c for c in totals.columns if c not in SPLIT]
    return totals.select(*SPLIT, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in names])


def _open_after(text: Column) -> Column:
    """Whether a line, with a comma in front, ends inside a quoted cell."""
    return F.element_at(F.regexp_extract_all(text, F.lit(CELL), 1), -1).rlike(rf'^"{QUOTED}\z')


def _odd(count: Column) -> Column:
    return count % 2 == 1


def _flip(value: Column, count: Column) -> Column:
    return value != _odd(count)


def _opened(lines: DataFrame) -> DataFrame:
    """``opened``: whether a line begins inside a quoted cell.

    A line either settles whether the next one does (``settles``), or leaves it as it was, or turns
    it round (``turns``). So what holds before a line follows from the last one that settles it and the
    number of turns since: first for each split as a whole, then inside the splits.
    """
    closed, inside = _open_after(F.concat(F.lit(","), "value")), _open_after(F.concat(F.lit(',"'), "value"))
    quoted = F.contains("value", F.lit('"'))
    told = lines.select("*", F.when(quoted, closed).otherwise(False).alias("closed"), F.when(quoted, inside).otherwise(True).alias("inside"))
    steps = told.select(*lines.columns, F.when(F.col("closed") == F.col("inside"), F.col("closed")).alias("settles"),
                        F.when(F.col("closed") & ~F.col("inside"), 1).otherwise(0).alias("turns"))

    def before(df: DataFrame, keys: list[str], order: str) -> DataFrame:
        """The value settled before each row, null where there is none, and the turns since."""
        rows = Window.partitionBy(*keys).orderBy(order)
        counted = df.withColumn("turned", F.sum("turns").over(rows))
        last = F.last(F.when(F.col("settles").isNotNull(), F.struct("settles", "turned")), ignorenulls=True).over(
            rows.rowsBetween(Window.unboundedPreceding, -1))
        since = F.col("turned") - F.col("turns") - F.coalesce("last.turned", F.lit(0))
        return counted.withColumn("last", last).select(*df.columns, F.col("last.settles").alias("settled"), since.alias("since"))

    inner = before(steps, SPLIT, "pos")
    final = F.max_by(F.struct("settles", "settled", "since", "turns"), "pos").alias("e")
    ends = inner.groupBy(*SPLIT).agg(final).select(
        *SPLIT, F.coalesce("e.settles", _flip(F.col("e.settled"), F.col("e.since") + F.col("e.turns"))).alias("settles"),
        F.when(_odd(F.col("e.since") + F.col("e.turns")), 1).otherwise(0).alias("turns"))
    # one row per split, each file from its own beginning
    starts = before(ends, ["file"], "split_start").select(
        *SPLIT, _flip(F.coalesce("settled", F.lit(False)), F.col("since")).alias("start"))
    return inner.join(starts, SPLIT).select(
        *lines.columns, _flip(F.coalesce("settled", "start"), F.col("since")).alias("opened"))


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows with a dense number, without reading a file in one task."""
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("pos"), F.regexp_replace("value", "\r$", "").alias("value"))
    within = Window.partitionBy(*SPLIT).orderBy("pos")
    begun = _opened(lines).withColumn("begins", F.when(F.col("opened"), 0).otherwise(1))
    numbered = begun.join(_before_split(begun, F.sum("begins").alias("rows_before")), SPLIT).withColumn(
        "row_no", (F.col("rows_before") + F.sum("begins").over(within) - 1).cast("bigint"))
    parts = F.array_sort(F.collect_list(F.struct("file", "split_start", "pos", "value")))
    return numbered.groupBy("row_no").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))


def _cell(text: Column) -> Column:
    quoted = F.regexp_extract(text, rf'^"({QUOTED})', 1)
    rest = F.substring(text, F.length(quoted) + 3, F.length(text))
    return F.when(text.startswith('"'), F.concat(F.replace(quoted, F.lit('""'), F.lit('"')), rest)).when(text != "", text)


def _sheet(spark: SparkSession, path: str) -> DataFrame:
    cells = F.regexp_extract_all(F.concat(F.lit(","), "value"), F.lit(CELL), 1)
    return _rows(spark, path).select("row_no", F.transform(cells, _cell).alias("cells"))


def scan_plan_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The plan sheet: fixed row and column positions."""
    return _sheet(spark, path)


def scan_block_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The assortment sheet: one block of rows per store, stacked."""
    return _sheet(spark, path)
