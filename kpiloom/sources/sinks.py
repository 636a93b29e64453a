"""CSV and JSON sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kpiloom.sources.tables import union_sources


def write_csv(df: DataFrame, path: str) -> str:
    """Overwrite ``path`` with header CSV part files; returns ``path``."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def _values(df: DataFrame, keys: list[str]) -> Column:
    measures = [c for c in df.columns if c not in keys]
    return F.to_json(F.struct(*measures), {"ignoreNullFields": "false"})


def json_records(marts: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """One row per mart row: mart name, key texts and the measures as JSON.

    ``marts`` maps a name to ``(mart, key columns)``. Nothing is gathered, so this
    form has no size limit.
    """
    return union_sources(*[
        df.select(F.lit(name).alias("mart"),
                  F.array(*[F.col(k).cast("string") for k in keys]).alias("keys"),
                  _values(df, keys).alias("values"))
        for name, (df, keys) in marts.items()])


def _key_text(keys: Column) -> Column:
    """Key parts joined by ``/``; ``~`` and ``/`` inside are ``~0`` and ``~1``, null is ``~n``."""
    plain = lambda k: F.replace(F.replace(k, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
    return F.array_join(F.transform(keys, lambda k: F.coalesce(plain(k), F.lit("~n"))), "/")


def _quoted(text: Column) -> Column:
    return F.regexp_extract(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", 1)


def write_json_doc(marts: dict[str, tuple[DataFrame, list[str]]], path: str) -> str:
    """Write one JSON document per mart and period, ``{"period": .., "rows": {key: {measures}}}``.

    A mart's first key is its period; the others name the rows of a document, so only one
    period's rows are ever gathered. Documents are lines of text under ``path/mart=<name>``;
    measures keep the text they have in ``json_records``. Returns ``path``.
    """
    records = json_records(marts)
    member = F.concat(_quoted(_key_text(F.slice("keys", 2, F.greatest(F.size("keys") - 1, F.lit(0))))), F.lit(":"), "values")
    documents = records.groupBy("mart", F.get("keys", F.lit(0)).alias("period")).agg(
        F.array_join(F.array_sort(F.collect_list(member)), ",").alias("members"))
    period = F.coalesce(_quoted(F.col("period")), F.lit("null"))
    value = F.concat(F.lit('{"period":'), F.when(F.col("period").isNull(), "null").otherwise(period),
                     F.lit(',"rows":{'), "members", F.lit("}}"))
    documents.select("mart", value.alias("value")).write.mode("overwrite").partitionBy("mart").text(path)
    return path
