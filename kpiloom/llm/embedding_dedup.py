"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Equal vectors are one row with a count. Rows are dealt to tiles by hash; each pair of tiles
is one group. There, the integer product of the quantised vectors, widened by the two
quantisation errors, leaves few pairs whose cosine is then taken in double precision. A
group gives out per vector its number of links and one link to the smallest vector it is
connected with there, never the pairs themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, stored

#: Vectors of a tile at most on average, rows of a tile that one product takes, and tiles at least.
TILE, SLAB, LEAST_TILES = 8192, 1024, 8
#: Integer products up to this many components are exact in single precision.
EXACT_DIM = 1024


def packed_vectors(batches):
    """Vectors as bytes of doubles, null where a vector links with nothing; -0 becomes 0."""
    for batch in batches:
        ids, vectors = batch.columns
        out = []
        for v in vectors.to_pylist():
            x = np.array([np.nan if c is None else c for c in v], np.float64) if v else np.zeros(0)
            out.append((x + 0.0).tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
        yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.binary())], names=["vec_id", "vector"])


def quantised(x: np.ndarray):
    """Int8 values, scales and error norms of unit rows; the errors are rounded up."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.sqrt(((x - scale[:, None] * q) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-12
    return q.astype(np.float32), scale, error


def int_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.shape[1] <= EXACT_DIM:
        return a @ b.T
    return sum((a[:, k:k + EXACT_DIM] @ b[:, k:k + EXACT_DIM].T).astype(np.float64)
               for k in range(0, a.shape[1], EXACT_DIM))


def possible_pairs(q, scale, error, rows, columns, threshold):
    """Index pairs of two slabs whose cosine may reach the threshold."""
    product = int_product(q[rows], q[columns])
    product *= scale[rows].astype(np.float32)[:, None]
    product *= scale[columns].astype(np.float32)[None, :]
    # |x.y - s q.t p| <= |ex| + (1 + |ex|) |ey|; 1e-5 covers rounding of the scaled product
    room = error[rows] + (1 + error[rows]) * error[columns].max() + 1e-5
    i, j = np.nonzero(product >= (threshold - room)[:, None])
    ex, ey = error[rows][i], error[columns][j]
    sure = product[i, j] >= threshold - ex - (1 + ex) * ey - 1e-5
    return rows.start + i[sure], columns.start + j[sure]


def joined_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after connecting i with j: the smallest index of each connected set."""
    while len(i):
        a, b = label[i], label[j]
        differ = a != b
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further
    return label


def tile_links(key, table: pa.Table, threshold: float) -> pa.Table:
    """Links between the two tiles of a group, or inside its one tile."""
    left, right = key[1].as_py(), key[2].as_py()
    table = table.sort_by([("tile", "ascending"), ("node", "ascending")])
    nodes = np.array(table["node"].to_pylist(), np.int64)
    copies = np.array(table["copies"].to_pylist(), np.int64)
    x = np.frombuffer(b"".join(table["vector"].to_pylist()), np.float64).reshape(len(nodes), -1)
    largest = np.abs(x).max(axis=1, keepdims=True)
    x = x / largest
    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    q, scale, error = quantised(x)
    border = int(np.searchsorted(np.array(table["tile"].to_pylist()), right))
    n = len(nodes)
    links, label = np.zeros(n, np.int64), np.arange(n)
    first = range(0, n, SLAB) if left == right else range(0, border, SLAB)
    for a in first:
        rows = slice(a, min(a + SLAB, n if left == right else border))
        for b in range(a if left == right else border, n, SLAB):
            i, j = possible_pairs(q, scale, error, rows, slice(b, min(b + SLAB, n)), threshold)
            if left == right:
                i, j = i[i < j], j[i < j]
            linked = np.concatenate([np.einsum("ij,ij->i", x[i[k:k + 65536]], x[j[k:k + 65536]]) >= threshold
                                     for k in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
            i, j = i[linked], j[linked]
            links += np.bincount(i, weights=copies[j], minlength=n).astype(np.int64)
            links += np.bincount(j, weights=copies[i], minlength=n).astype(np.int64)
            label = joined_labels(label, i, j)
    some = links > 0
    return pa.table({"node": nodes[some], "links": links[some], "root": nodes[label[some]]})


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Links between embeddings with a cosine of ``threshold`` or more, and their components.

    ``vectors`` needs vec_id (long) and embedding (array). Vectors that are null, empty or
    zero, or hold a null or non-finite component link with nothing; vectors of different
    lengths don't link. Every row counts as a vector with links of its own, also one that
    repeats an id or has none; components take the smallest id there is. Returns one row per row: vec_id, n_links, component_id (smallest linked vec_id, own one
    included), kept. Work grows with the square of the number of distinct vectors, in
    tiles; rows are copied to as many groups as there are tiles.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast(T.ArrayType(T.DoubleType()))).mapInArrow(
        packed_vectors, "vec_id long, vector binary")
    distinct = stored(rows.where("vector is not null").groupBy("vector").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies")).withColumn("node", F.monotonically_increasing_id()), "vectors")
    tiles = max(LEAST_TILES, -(-distinct.count() // TILE))
    tile = F.pmod(F.xxhash64("vector"), F.lit(tiles)).cast("int")
    dealt = distinct.select(
        "node", "copies", "vector", F.octet_length("vector").alias("size"), tile.alias("tile"),
        F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("other"))
    found = stored(
        dealt.select("node", "copies", "vector", "size", "tile", F.least("tile", "other").alias("i"),
                     F.greatest("tile", "other").alias("j")).groupBy("size", "i", "j").applyInArrow(
            lambda key, t: tile_links(key, t, threshold), "node long, links long, root long"), "tile-links")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-components")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = (distinct.join(counted, "node", "left").join(roots, F.col("node") == roots.id, "left")
              .select("vector", "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
                      F.coalesce("root", "node").alias("root")).where("n > 0"))
    names = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    known = linked.select("vector", "n", "root").join(names, "root").drop("root")
    out = rows.join(known, "vector", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_cosine_similarity(a.e, b.e) >= 0.9),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) k ON k.a = c.vec_id
"""
