"""Hard negatives by exact integer products in a residue number system.

Component matrices are multiplied modulo a few small primes in single precision, where every
partial sum is exact; Chinese remaindering gives back the signed scores. Vectors are dealt
to tiles by hash, and each pair of an anchor tile with a row tile is one group. A first round
finds the best rows of an anchor's own label, a second one the best rows of other labels
inside the window that each positive's score opens; a group gives out a few rows per anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Moduli: the largest primes up to 1021. Residues within +-510, so 64 products stay below 2^24.
PRIMES = [p for p in range(1021, 900, -1) if all(p % d for d in range(2, 32))]
BLOCK = 64

#: Vectors and anchors of a tile at most on average, row tiles at least, anchors that one product takes.
ROW_TILE, ANCHOR_TILE, LEAST_TILES, SLAB = 16384, 16384, 8, 128

#: A vector's inner product with itself stays below 2^56: all scores, and 100 times them, fit 64 bits.
MOST_NORM = float(1 << 56)

FOUND = "anchor long, anchor_id long, label int, other_id long, score long"
PICKED = "anchor long, anchor_id long, slot int, positive_id long, positive_score long, negative_id long, negative_score long"
NEVER = np.iinfo(np.int64).min


def moduli(most: int) -> list[int]:
    """So many primes that scores up to ``most`` in size are told apart."""
    out, product = [], 1
    for p in PRIMES:
        if product > 2 * most:
            break
        out.append(p)
        product *= p
    return out


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Values modulo ``p``, as close to 0 as possible, in single precision."""
    r = x % p
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def product_modulo(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a b^T modulo ``p`` of residues, as integers 0..p-1."""
    total = np.zeros((len(a), len(b)), np.float32)
    for k in range(0, a.shape[1], BLOCK):
        part = a[:, k:k + BLOCK] @ b[:, k:k + BLOCK].T
        total += part
        total -= np.float32(p) * np.rint(total / np.float32(p))
    return total.astype(np.int64) % p


def reconstructed(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Signed values from their remainders, digit by digit in the mixed radix of the primes."""
    value, radix = parts[0].copy(), primes[0]
    for part, p in zip(parts[1:], primes[1:]):
        digit = (part - value) % p * pow(radix, -1, p) % p
        value += digit * radix
        radix *= p
    return np.where(value > radix // 2, value - radix, value)


def best(scores: np.ndarray, n: int):
    """Row and column of the ``n`` largest scores of each row, NEVER aside; of equals, the first columns. Spoils ``scores``."""
    at = np.arange(len(scores))
    for _ in range(n if scores.shape[1] else 0):
        column = scores.argmax(axis=1)
        value = scores[at, column]
        some = value > NEVER
        if not some.any():
            break
        yield at[some], column[some], value[some]
        scores[at, column] = NEVER


class Tile:
    """The anchors and rows of a group, rows in order of their ids (null last)."""

    def __init__(self, table: pa.Table, primes: list[int]):
        table = table.sort_by([("id", "ascending")])
        self.ids, self.primes = table["id"], primes
        is_anchor = table["is_anchor"].to_numpy(zero_copy_only=False)
        self.anchor_at, self.row_at = np.nonzero(is_anchor)[0], np.nonzero(~is_anchor)[0]
        self.anchors = table.take(self.anchor_at)
        self.labels = table["label"].to_numpy()
        # the key of an id, for "another row": null has one of its own
        self.known = ~np.array(table["id"].is_null())
        self.keys = table["id"].fill_null(0).to_numpy()
        vectors = table["vector"].combine_chunks()
        flat = (pa.concat_arrays(vectors.chunks) if isinstance(vectors, pa.ChunkedArray) else vectors).flatten()
        x = flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(table.num_rows, -1)
        self.residues = [residues(x, p) for p in primes]

    def scores(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if not self.residues[0].shape[1]:
            return np.zeros((len(anchors), len(rows)), np.int64)
        return reconstructed([product_modulo(r[anchors], r[rows], p) for r, p in zip(self.residues, self.primes)],
                             self.primes)

    def same_row(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return (self.keys[anchors][:, None] == self.keys[rows][None, :]) & self.known[rows][None, :]


def empty(columns: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    return pa.table({name: pa.array([], kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))})


def positives_of(table: pa.Table, primes: list[int], n: int) -> pa.Table:
    """The ``n`` best other rows of its label for each anchor of a group."""
    tile = Tile(table, primes)
    key, out = tile.anchors["anchor"].to_numpy(), []
    label = tile.labels[tile.anchor_at]
    row_label = tile.labels[tile.row_at]
    for value in np.unique(label):
        mine, rows = np.nonzero(label == value)[0], tile.row_at[row_label == value]
        for k in range(0, len(mine), SLAB):
            part = mine[k:k + SLAB]
            anchors = tile.anchor_at[part]
            scores = tile.scores(anchors, rows)
            scores[tile.same_row(anchors, rows)] = NEVER
            for i, j, score in best(scores, n):
                out.append((key[part[i]], tile.keys[anchors[i]], np.full(len(i), value, np.int32), rows[j], score))
    if not out:
        return empty(FOUND)
    anchor, anchor_id, labels, rows, score = (np.concatenate(c) for c in zip(*out))
    return pa.table({"anchor": anchor, "anchor_id": anchor_id, "label": labels.astype(np.int32),
                     "other_id": tile.ids.take(rows), "score": score})


def negatives_of(table: pa.Table, primes: list[int], n: int) -> pa.Table:
    """The ``n`` best rows of other labels in the window of each positive, for each anchor of a group."""
    tile = Tile(table, primes)
    key, out = tile.anchors["anchor"].to_numpy(), []
    positives = tile.anchors["positives"].to_pylist()
    most = max((len(p) for p in positives), default=0)
    limits = np.full((len(positives), most), NEVER, np.int64)
    for k, found in enumerate(positives):
        limits[k, :len(found)] = [p["score"] for p in found]
    row_label = tile.labels[tile.row_at]
    for k in range(0, len(key), SLAB):
        anchors, limit = tile.anchor_at[k:k + SLAB], limits[k:k + SLAB]
        scores = tile.scores(anchors, tile.row_at)
        scores[(tile.labels[anchors][:, None] == row_label[None, :]) | tile.same_row(anchors, tile.row_at)] = NEVER
        for slot in range(most):
            # 50 p <= 100 s <= 95 p in whole numbers; no score lies in the window of a negative p
            p = limit[:, slot]
            positive = p >= 0
            low = np.where(positive, -(-np.where(positive, p, 0) // 2), 1)[:, None]
            high = np.where(positive, np.where(positive, p, 0) * 95 // 100, 0)[:, None]
            inside = np.where((scores >= low) & (scores <= high), scores, NEVER)
            for i, j, score in best(inside, n):
                out.append((k + i, np.full(len(i), slot, np.int32), tile.row_at[j], score))
    if not out:
        return empty(PICKED)
    at, slot, rows, score = (np.concatenate(c) for c in zip(*out))
    chosen = [positives[i][s] for i, s in zip(at.tolist(), slot.tolist())]
    return pa.table({"anchor": key[at], "anchor_id": tile.keys[tile.anchor_at[at]], "slot": slot,
                     "positive_id": pa.array([c["other_id"] for c in chosen], pa.int64()),
                     "positive_score": pa.array([c["score"] for c in chosen], pa.int64()),
                     "negative_id": tile.ids.take(rows), "negative_score": score})


def quantised(vectors: DataFrame, scale: int, relabel_every: int, labels: int) -> DataFrame:
    """Rows that take part, with whole components and their label; exact repeats are one row."""
    x = F.col("embedding").cast("array<double>")
    usable = F.col("label").isNotNull() & F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float(1 << 28)))
    moved = F.coalesce(F.pmod(F.col("vec_id").cast("long"), F.lit(relabel_every)) == 0, F.lit(False))
    label = F.col("label").cast("int")
    whole = F.transform(x, lambda c: F.floor(c * scale))
    norm = F.aggregate("whole", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
    return (vectors.where(usable).select(
        F.col("vec_id").cast("long").alias("id"),
        F.when(moved, ((label.cast("long") + 1) % labels).cast("int")).otherwise(label).alias("label"), whole.alias("whole"))
        .where(norm < MOST_NORM)
        .select("id", "label", F.transform("whole", lambda c: c.cast("int")).alias("vector"), norm.alias("norm"))
        .distinct().select("*", F.xxhash64("id", "label", "vector").alias("anchor"), F.size("vector").alias("dim")))


def dealt(rows: DataFrame, anchors: DataFrame, row_tiles: int, anchor_tiles: int) -> DataFrame:
    """Each row beside each tile of anchors, each anchor beside each tile of rows.

    ``anchors`` has the columns of ``rows`` and may have ``positives``.
    """
    no_positives = F.lit(None).cast("array<struct<score: bigint, other_id: bigint>>")

    def tile(n: int) -> Column:
        return F.pmod(F.xxhash64("anchor", F.lit(5)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = F.col("positives") if "positives" in anchors.columns else no_positives
    columns = ["anchor", "id", "label", "vector", "dim", "is_anchor"]
    return (anchors.select("*", F.lit(True).alias("is_anchor"), asked.alias("asked"))
            .select(*columns, F.col("asked").alias("positives"), tile(anchor_tiles).alias("i"), every(row_tiles).alias("j"))
            .unionByName(rows.select("*", F.lit(False).alias("is_anchor"))
                         .select(*columns, no_positives.alias("positives"), every(anchor_tiles).alias("i"),
                                 tile(row_tiles).alias("j"))))


def hard_negatives(vectors: DataFrame, anchor_every: int = 50, n_positives: int = 5, n_negatives: int = 3,
                   scale: int = 256, relabel_every: int = 7, labels: int = 10) -> DataFrame:
    """For each anchor and each of its positives, the best rows of other labels in the positive's window.

    ``vectors`` needs vec_id (long), embedding (array) and label (int). Rows with a null
    label, a null vector or a null or non-finite component take no part; neither do rows
    whose inner product with themselves reaches 2^56 (components of 10^5 and more), since scores
    must fit 64 bits. Where vec_id is divisible by ``relabel_every``, the label first becomes
    (label + 1) % ``labels``. Components become floor(scale * x). Anchors are the rows
    whose vec_id is divisible by ``anchor_every``; a null id is none, but its row can be
    found. Rows equal in id, label and vector are one row; rows that share an id only are rows
    of their own and no "other rows" of each other. Vectors of different lengths don't meet.
    Ties go by vec_id, null last.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Work grows
    with the product of anchors and rows, in tiles; no anchor and no label is one task.
    """
    rows = stored(quantised(vectors, scale, relabel_every, labels), "negatives-rows")
    size = rows.agg(F.count("*"), F.max("norm"), F.count_if(F.pmod("id", F.lit(anchor_every)) == 0)).first()
    primes = moduli(int((size[1] or 0) * (1 + 1e-9)) + 1)
    row_tiles, anchor_tiles = max(LEAST_TILES, -(-size[0] // ROW_TILE)), max(1, -(-size[2] // ANCHOR_TILE))
    rows = rows.drop("norm")
    anchors = rows.where(F.pmod("id", F.lit(anchor_every)) == 0)

    def first(by: list[str], order: list[Column], n: int, df: DataFrame) -> DataFrame:
        return df.select("*", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).alias("rank")).where(F.col("rank") <= n)

    found = dealt(rows, anchors, row_tiles, anchor_tiles).groupBy("dim", "i", "j").applyInArrow(
        lambda table: positives_of(table, primes, n_positives), FOUND)
    found = first(["anchor", "anchor_id", "label"], [F.col("score").desc(), F.col("other_id").asc_nulls_last()], n_positives, found)
    # the order in the list does not matter: slots only tell an anchor's positives apart
    lists = stored(found.groupBy("anchor", F.col("anchor_id").alias("id"), "label").agg(
        F.sort_array(F.collect_list(F.struct("score", "other_id"))).alias("positives")), "negatives-positives")
    asking = anchors.join(lists, ["anchor", "id", "label"])
    picked = dealt(rows, asking, row_tiles, anchor_tiles).groupBy("dim", "i", "j").applyInArrow(
        lambda table: negatives_of(table, primes, n_negatives), PICKED)
    picked = first(["anchor", "anchor_id", "slot"], [F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last()],
                   n_negatives, picked)
    return picked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda c: floor(256 * c)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
             CASE WHEN len(a.e) = 0 THEN 0 ELSE list_inner_product(a.e, b.e) END::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id IS DISTINCT FROM a.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id NULLS LAST) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id NULLS LAST)::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
