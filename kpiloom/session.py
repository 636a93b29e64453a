"""Recommended settings and shared folders. Nothing here changes a session."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Settings to start a session with. Skew joins are forced because a join on a hot order
#: id is often followed by an aggregate that could reuse the join's partitioning; without
#: the flag AQE would keep the hot partition whole. The number of shuffle partitions is
#: the cluster's to set: AQE merges those that turn out small.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: For sessions that read bucketed facts: a join on an order's id and more keys may then use
#: buckets of the id alone. Leave it out where one id may hold a large share of the rows.
BUCKETED_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


#: Rows of a fact that one task sorts or groups at a time.
TASK_ROWS = 1_000_000


def parts_for(rows: int, least: int = 1) -> int:
    """How many buckets or partitions ``rows`` take, ``TASK_ROWS`` each, so that a task stays as small as they grow.

    Facts that are joined by their buckets take one number for all, from the largest.
    """
    return max(least, -(-rows // TASK_ROWS))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables, under the folder of ``spark.checkpoint.dir``.

    Executors write there and read each other's files, so it must be shared; a session
    without one is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, path: str, by: list[str] = ()) -> DataFrame:
    """Write ``df`` to ``path``, partitioned by ``by``, and return the stored table.

    For results that several plans read: they are computed once, when this is called. The
    caller owns ``path`` and removes it.
    """
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_all(spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]], paths: Mapping[str, str],
                    parallel: int = 4) -> dict[str, DataFrame]:
    """``materialise`` of every table at its path, ``parallel`` at a time, so that small jobs use what large ones leave free."""
    run = inheritable_thread_target(spark)(lambda name: materialise(tables[name](), paths[name]))
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(zip(tables, pool.map(run, tables)))


def bucketed(df: DataFrame, path: str, name: str, cols: list[str], buckets: int, by: Iterable[str] = (),
             most_rows: int | None = 1_000_000) -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` of equal ``cols``, as catalog table ``name``, and return it.

    For facts that are joined or grouped by an order id again and again: joins and aggregates on the
    bucket columns need no shuffle. Rows are dealt to buckets before they are written, so each
    bucket is one sorted file per partition of ``by``. A bucket is read by one task: choose so
    many that each fits one (``parts_for``). A key of more than ``most_rows`` rows is an error (None: not
    looked at), since its bucket can't be split; leave such facts unbucketed and to AQE.
    The caller owns the table and its files.
    """
    dealt = df.repartition(buckets, *cols)
    (dealt.write.format("parquet").option("path", path).partitionBy(*by).bucketBy(buckets, *cols).sortBy(*cols)
     .saveAsTable(name))
    table = df.sparkSession.table(name)
    if most_rows is not None:
        hot = table.groupBy(*cols).agg(F.count("*").alias("rows")).agg(F.max("rows")).first()[0]
        if (hot or 0) > most_rows:
            raise ValueError(f"{name}: a key of {', '.join(cols)} has {hot} rows, over {most_rows}")
    return table


def open_bucketed(spark: SparkSession, path: str, name: str, schema: str, cols: list[str], buckets: int,
                  by: Iterable[str] = ()) -> DataFrame:
    """A table that ``bucketed`` wrote in another session. ``schema`` ends with the columns of ``by``."""
    by = list(by)
    parts = f"PARTITIONED BY ({', '.join(by)})" if by else ""
    keys = ", ".join(cols)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet {parts} "
              f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    if by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)
