"""Table and CSV sources."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from kpiloom.functions.dates import try_date
from kpiloom.sources.batch import Drops


def scan_table(spark: SparkSession, name: str, path: str | None = None,
               schema: StructType | str | None = None) -> DataFrame:
    """A parquet table under ``path``, or the catalog table ``name``.

    A declared schema saves the footer reads of schema inference.
    """
    if path is None:
        return spark.table(name)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/{name}.parquet")


def scan_csv(spark: SparkSession, path: str, schema: StructType | str, encoding: str = "UTF-8",
             null_value: str = "") -> DataFrame:
    """Header CSV with a declared schema; pass ``ISO-8859-1`` for latin-1 files."""
    return (spark.read.schema(schema)
            .option("header", True).option("encoding", encoding).option("nullValue", null_value)
            .csv(path))


def coerce_dates(df: DataFrame, cols: list[str], fmt: str | None = None, drops: Drops | None = None) -> DataFrame:
    """Columns to date; rows with an unreadable date are dropped, and counted by ``drops``."""
    parsed = df.withColumns({c: try_date(F.col(c).cast("string"), fmt) for c in cols})
    if drops is None:
        return parsed.dropna(subset=cols)
    return reduce(lambda d, c: drops.keep(d, f"unreadable {c}", F.col(c).isNotNull()), cols, parsed)


def optional_source(spark: SparkSession, path: str, schema: StructType | str, encoding: str = "UTF-8") -> DataFrame:
    """``scan_csv``, or no rows of the same schema when there is no file."""
    try:
        return scan_csv(spark, path, schema, encoding)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def source_fallback(primary: DataFrame | None, secondary: DataFrame) -> DataFrame:
    """The primary source if it has rows, else the secondary one.

    The test reads at most one row of ``primary``; give it the source itself
    rather than an aggregate of it.
    """
    return secondary if primary is None or primary.isEmpty() else primary


def category_census(df: DataFrame, *cols: str) -> DataFrame:
    """Row count of every combination of ``cols``."""
    return df.groupBy(*cols).agg(F.count("*").alias("rows_count"))


def union_sources(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
