"""A training corpus from raw documents: stages that each apply one operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. Each stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from kpiloom.llm.common import stored, table

#: The draw of a mixture depends on its rows: SQL can't express the near-duplicate stage before it.
ORACLE_SQL = None


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not among ``rejected``: for ids that name one row each."""
    gone = rejected.select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def ids_name_rows(docs: DataFrame) -> bool:
    """Whether every row has an id of its own. Ids alone are looked at, with map-side combining."""
    return docs.groupBy("doc_id").agg(F.count("*").alias("rows")).where("doc_id is null or rows > 1").isEmpty()


def text_key(doc_id: Column, sha: Column) -> Column:
    """One text for an id, null too, and the digest of a normalised text."""
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("none")), sha).cast("binary"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts in no language: those without a letter, not those for which no language was learned."""
    found = language_id.language_of(docs, carry=True)
    lettered = F.coalesce(F.col("row.text").rlike(r"\p{L}"), F.lit(False))
    return found.where((F.col("lang_pred") != "und") | lettered).select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of equal texts: of rows that also share an id, or have none, the longest.

    Where an id is null or names several rows, decisions are joined by id and text, so that another text under
    a rejected row's id stays. Equal rows are one before that shuffle, however many there are.
    """
    found = exact_dedup.exact_duplicates(docs)
    if ids_name_rows(docs):
        return without(docs, found.where("not kept"))
    kept = found.where("kept").select(text_key(F.col("doc_id"), F.col("text_sha256")).alias("kept_key")).distinct()
    text = F.coalesce("text", F.lit(""))
    bare = F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]", ""), 256)
    rows = docs.select(F.struct("*").alias("row"), text_key(F.col("doc_id"), bare).alias("key"),
                       F.struct(F.length(text), text).alias("size"))
    longest = rows.groupBy("key").agg(F.max_by("row", "size").alias("row"))
    return longest.join(kept, longest["key"] == kept["kept_key"], "left_semi").select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component of near duplicates.

    Where an id is null or names several rows, rows are numbered for this stage and each is judged by itself.
    """
    if ids_name_rows(docs):
        return without(docs, jaccard_join.near_duplicates(docs).where("doc_id <> component_id"))
    numbered = stored(docs.select(F.struct("*").alias("row"), "text", F.monotonically_increasing_id().alias("doc_id")), "near-rows")
    found = jaccard_join.near_duplicates(numbered)
    return without(numbered, found.where("doc_id <> component_id")).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources reach their targets; rows that share an id share their draw."""
    mixed = mixing.mix(docs, carry=True)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), F.col("repeats")))).select("row.*")


def packs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place all words in training sequences, each row as often as it comes; see ``packing.pack``."""
    return packing.pack(docs)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixture),
          ("packing", packs)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
