"""Mixing sources to target weights by capped water-filling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN

#: Cells of the draw per source, and copies of the source table that spread a hot source's join.
CELLS, SALTS = 4096, 16


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, share: float = 1.0, most_epochs: int = 3) -> DataFrame:
    """Targets of ``sources`` (source, source_size, weight).

    All sources together are to give ``share`` of the total size. A target stops at
    ``most_epochs`` times its source; what is cut is dealt to the others by weight until
    none is above. With the sources ordered by cap over weight this is one running sum: the
    clamped ones come first, and the level of the others is the highest that a split gives.
    One row per source passes through one task: a table of names, not of documents.
    """
    cap = F.col("source_size") * most_epochs
    ratio = cap / F.col("weight")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    levels = sources.select(
        "*",
        (F.sum("source_size").over(Window.partitionBy()) * F.lit(share)
         - F.coalesce(F.sum(cap).over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(Window.partitionBy())
         - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("rest"))
    # clamping a source whose cap lies below the level raises it, clamping a further one lowers it
    level = F.max(F.col("left") / F.col("rest")).over(Window.partitionBy())
    return levels.select("source", "source_size", F.coalesce(F.least(cap.cast("double"), F.col("weight") * level),
                                                             cap.cast("double")).alias("target"))


def draw(doc_id: Column, seed: int) -> Column:
    """Cell 0..CELLS-1 of a document, from a digest of the seed and its id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")


def mix(docs: DataFrame, share: float = 1.0, most_epochs: int = 3, seed: int = 7, carry: bool = False) -> DataFrame:
    """How often each document of ``docs`` (doc_id, text, source) goes into the mix.

    Sources by code point, null last, weigh 1, 2, 3, repeating. A source whose target is
    r times its size takes every document floor(r) times, and once more those in the
    cells of a seeded draw that bring its words nearest to the target. Null and empty
    texts have size 0. Returns doc_id, size, source_size, target, taken (words, repeats
    counted), repeats, source; one row per row of ``docs``. Rows that repeat an id share its draw.
    With ``carry`` a struct ``row`` holds the document's own columns, whatever their names.
    """
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                        draw(F.col("doc_id"), seed).alias("cell"), *([F.struct("*").alias("row")] if carry else []))
    cells = sized.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    sources = cells.groupBy("source").agg(F.sum("words").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    plan = water_fill(sources.select("*", (place % 3 + 1).alias("weight")), share, most_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.select("*", whole.cast("int").alias("whole"),
                       (F.col("target") - whole * F.col("source_size")).alias("want"))
    left, right = cells.alias("c"), plan.alias("p")
    reached = left.join(right, F.col("c.source").eqNullSafe(F.col("p.source"))).select(
        F.col("p.source"), "source_size", "target", "whole", "want", "cell", "words",
        F.sum("words").over(Window.partitionBy("p.source").orderBy("cell")).alias("upto"))
    # a cell is in if the target lies past its middle
    limit = F.coalesce(F.max(F.when(F.col("upto") - F.col("words") / 2 <= F.col("want"), F.col("cell"))), F.lit(-1))
    plan = reached.groupBy("source", "source_size", "target", "whole").agg(limit.alias("last_cell"))
    salted = plan.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")).alias("p")
    rows = sized.select("*", F.pmod(F.xxhash64("doc_id", "cell"), F.lit(SALTS)).cast("int").alias("salt")).alias("d")
    repeats = F.col("whole") + F.when((F.col("cell") <= F.col("last_cell"))
                                      & (F.col("whole") < most_epochs), 1).otherwise(0)
    return rows.join(salted, F.col("d.source").eqNullSafe(F.col("p.source"))
                     & (F.col("d.salt") == F.col("p.salt"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * repeats).cast("long").alias("taken"),
        repeats.cast("int").alias("repeats"), F.col("d.source").alias("source"), *(["row"] if carry else []))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 3))::INT AS cell
  FROM documents),
c AS (SELECT source, cell, sum(size) AS words FROM d GROUP BY source, cell),
s AS (SELECT source, sum(words) AS source_size,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM c GROUP BY source),
l AS (SELECT *, 3 * source_size / weight AS ratio FROM s),
r AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
      FROM l WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, coalesce(least(3.0 * source_size,
               weight * (SELECT max(level) FROM r)), 3.0 * source_size)::DOUBLE AS target FROM r),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::INT ELSE 0 END AS whole FROM t),
u AS (SELECT c.source, cell, words, sum(words) OVER (PARTITION BY c.source ORDER BY cell) AS upto FROM c),
e AS (SELECT p.source, p.source_size, p.target, p.whole,
             coalesce(max(cell) FILTER (WHERE upto - words / 2 <= target - whole * source_size), -1) AS last_cell
      FROM p JOIN u ON u.source IS NOT DISTINCT FROM p.source GROUP BY ALL)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN cell <= last_cell AND whole < 3 THEN 1 ELSE 0 END))::BIGINT AS taken,
       (whole + CASE WHEN cell <= last_cell AND whole < 3 THEN 1 ELSE 0 END)::INT AS repeats, d.source
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
"""
