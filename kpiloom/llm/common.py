"""What the operators share: tables, stored intermediates, word rules, components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word and text rules: space, tab, line feed, vertical tab, form feed, return.
SPACE = b" \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; set to a local one only where it is unset and Spark is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like ``stored``, in hash buckets of ``key``: grouping by it needs no shuffle of these rows."""
    spark = df.sparkSession
    mark = f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).option("path", f"{shared_dir(spark)}/{mark}").saveAsTable(mark, format="parquet")
    return spark.table(mark)


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id is in fold 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(column.cast("string")), F.lit(parts)), F.lit(0)).cast("int")


def share(column: Column, salt: int = 0) -> Column:
    """A value in [0, 1) drawn from the hash of ``column``; the same in every run."""
    return F.pmod(F.xxhash64(column, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a limit."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def slices(batches, most_bytes: int = 4 << 20):
    """Batches cut to about ``most_bytes`` of their last column, so that a task's arrays stay small."""
    for batch in batches:
        at, held = 0, 0
        for k, raw in enumerate(batch.column(batch.num_columns - 1)):
            held += len(raw.as_buffer() or b"") if raw.is_valid else 0
            if held > most_bytes:
                yield batch.slice(at, k + 1 - at)
                at, held = k + 1, 0
        if at < batch.num_rows:
            yield batch.slice(at)


def components(edges: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): one row (id, root) per end of an edge.

    Alternating large and small stars: every round hangs neighbours under the smallest
    neighbour by joins with a minimum per node, so no neighbourhood is gathered in one
    task; a hot node's rows can be split by the join. Roots are the smallest ids. Rounds grow
    with the logarithm of the longest path; if ``most_rounds`` are not enough, that is an error.
    """
    links = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   name)
    seen = None
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        links = stored(small.where("a <> b").distinct(), name)
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = links.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("root"))
    return links.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(roots)
