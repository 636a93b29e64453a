"""Exact duplicates through Patricia tries owned by length-and-content-hash partitions.

Every map task folds equal texts it holds together, so a text of any number of copies
reaches its owner as a few rows. An owner partition gets its byte strings in byte order
(Spark's sort spills to disk) and inserts them into a radix trie; a subtree that later
keys can't reach any more is given out and freed, so an owner holds one path at a time.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE

#: Bytes of distinct texts a map task folds before it passes them on.
FOLD_BYTES = 16 << 20


class Node:
    __slots__ = ("label", "kids", "value")

    def __init__(self, label: bytes, value=None):
        self.label, self.kids, self.value = label, {}, value


def first_difference(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low + (a[low] == b[low])


def better(x, y):
    """Fold two candidates (-code points, no id, id, rows, ...): the smaller stays, rows add up."""
    low = x if precedes(x, y) else y
    return (*low[:3], x[3] + y[3], *x[4:])


def precedes(x, y) -> bool:
    return x[:2] < y[:2] or x[:2] == y[:2] and (x[1] or x[2] <= y[2])


class PatriciaTrie:
    """Compressed radix trie over keys that arrive in byte order; ``done`` gets finished terminals."""

    def __init__(self, done):
        self.root, self.done = Node(b""), done

    def insert(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while at < len(key):
            kid = node.kids.get(key[at])
            if kid is None:
                self.release(node)
                node.kids[key[at]] = Node(key[at:], value)
                return
            if key.startswith(kid.label, at):
                node, at = kid, at + len(kid.label)
                continue
            split = first_difference(kid.label, key[at:])
            fork = Node(kid.label[:split])
            kid.label = kid.label[split:]
            fork.kids[kid.label[0]] = kid
            node.kids[key[at]] = fork
            node, at = fork, at + split
        node.value = value if node.value is None else better(node.value, value)

    def release(self, node: Node) -> None:
        """Give out and free what hangs under ``node``: in byte order it is complete."""
        waiting = list(node.kids.values())
        node.kids = {}
        while waiting:
            kid = waiting.pop()
            waiting.extend(kid.kids.values())
            if kid.value is not None:
                self.done(kid.value)

    def close(self) -> None:
        self.release(self.root)
        if self.root.value is not None:
            self.done(self.root.value)


FOLDED = pa.schema([("n_bytes", pa.int64()), ("sha", pa.binary()), ("norm", pa.binary()), ("cp", pa.int64()),
                    ("doc_id", pa.int64()), ("rows", pa.int64())])


def fold_texts(batches):
    held, size = {}, 0

    def flush():
        return pa.RecordBatch.from_pylist(
            [{"n_bytes": len(norm), "sha": sha, "norm": norm, "cp": -best[0], "doc_id": best[2], "rows": best[3]}
             for sha, (norm, best) in held.items()], schema=FOLDED)

    for batch in batches:
        for doc_id, raw, cp in zip(*(c.to_pylist() for c in batch.columns)):
            norm = (raw or b"").translate(None, SPACE)
            sha = hashlib.sha256(norm).digest()
            value = (-cp, doc_id is None, doc_id, 1)
            known = held.get(sha)
            if known is None:
                held[sha] = (norm, value)
                size += len(norm) + 100
            else:
                held[sha] = (norm, better(known[1], value))
        if size > FOLD_BYTES:
            yield flush()
            held, size = {}, 0
    if held:
        yield flush()


OWNED = pa.schema([("sha", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def own_texts(batches):
    out = []
    trie = PatriciaTrie(out.append)

    def drain():
        rows = pa.RecordBatch.from_arrays(
            [pa.array([v[4] for v in out], pa.binary()), pa.array([v[2] for v in out], pa.int64()),
             pa.array([v[3] for v in out], pa.int64())], schema=OWNED)
        out.clear()
        return rows

    for batch in batches:
        for sha, norm, cp, doc_id, rows in zip(*(c.to_pylist() for c in batch.columns)):
            trie.insert(norm, (-cp, doc_id is None, doc_id, rows, sha))
        yield drain()
    trie.close()
    yield drain()


def hashed_rows(batches):
    for batch in batches:
        ids, raws = batch.columns
        shas = [hashlib.sha256((raw or b"").translate(None, SPACE)).digest() for raw in raws.to_pylist()]
        yield pa.RecordBatch.from_arrays([ids, pa.array(shas, pa.binary())], names=["doc_id", "sha"])


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Which row of each group of equal texts stays.

    ``docs`` needs doc_id (long) and text. Texts are equal when identical without white
    space; null counts as empty, and all empty texts are one group. The row with the most
    code points, then the smallest doc_id (a null id last) stays. Returns one row per row
    of ``docs``: doc_id, keep_id, group_size, kept, text_sha256. Rows that repeat a doc_id
    with an equal text get the same answer each.
    """
    raw = F.col("text").cast("binary")
    folded = docs.select("doc_id", raw, F.coalesce(F.length("text"), F.lit(0)).cast("long")).mapInArrow(
        fold_texts, "n_bytes long, sha binary, norm binary, cp long, doc_id long, rows long")
    owned = (folded.repartition("n_bytes", "sha").sortWithinPartitions("norm")
             .select("sha", "norm", "cp", "doc_id", "rows")
             .mapInArrow(own_texts, "sha binary, keep_id long, group_size long")
             .where("group_size > 1"))
    rows = docs.select("doc_id", raw).mapInArrow(hashed_rows, "doc_id long, sha binary")
    joined = rows.join(owned, "sha", "left")
    return joined.select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("group_size").isNull(), F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY cp DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""
