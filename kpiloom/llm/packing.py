"""Conflict-constrained best-fit packing of documents into bins of equal length.

Documents are dealt by hash to groups of bounded size, each packed by one task. Open bins
are ordered by what is left in them and carry bitmaps of their sources and duplicate
clusters; from the first bin that is large enough the search goes on to the tightest
one that shares no bit with the document.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE

#: Words of a bin, and rows of a packing group on average.
CAPACITY, GROUP_ROWS = 2048, 8000

SIZED = "doc_id long, source string, size long, cluster long"
PLACED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("n_words", pa.int64()),
                    ("bin_id", pa.int64()), ("source", pa.string()), ("cluster", pa.int64())])


def sized_rows(batches):
    """Words of each text, and the cluster of texts that are equal without white space."""
    for batch in batches:
        ids, sources, raws = batch.columns
        raws = [r or b"" for r in raws.to_pylist()]
        marks = [int.from_bytes(hashlib.sha256(r.translate(None, SPACE)).digest()[:8], "big", signed=True) for r in raws]
        yield pa.RecordBatch.from_arrays(
            [ids, sources, pa.array([len(r.split()) for r in raws], pa.int64()), pa.array(marks, pa.int64())],
            names=["doc_id", "source", "size", "cluster"])


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("source").cast("string"), F.col("text").cast("binary")).mapInArrow(
        sized_rows, SIZED)


class OpenBins:
    """Bins with room, by (what is left, number)."""

    def __init__(self, capacity: int):
        self.capacity, self.order, self.sources, self.clusters = capacity, [], [], []

    def place(self, size: int, source: int, cluster: int) -> int:
        """Number of the tightest bin with room and without a common bit; a new one where there is none."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            left, number = self.order[at]
            if not (self.sources[number] & source or self.clusters[number] & cluster):
                del self.order[at]
                break
            at += 1
        else:
            left, number = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[number] |= source
        self.clusters[number] |= cluster
        if left > size:
            insort(self.order, (left - size, number))
        return number


def pack_group(group: int, rows: list[tuple], capacity: int, source_once: bool) -> pa.RecordBatch:
    """Rows (doc_id, source, size, cluster) of one group, placed."""
    pieces, out = [], []
    for doc_id, source, size, cluster in rows:
        if not size:
            out.append((doc_id, 0, 0, 0, None, source, cluster))
        for piece, start in enumerate(range(0, size, capacity)):
            pieces.append((min(capacity, size - start), doc_id, piece, start, source, cluster))
    pieces.sort(key=lambda p: (-p[0], p[1] is None, p[1] or 0, p[2], p[5]))
    marks, counts = np.unique(np.array([p[5] for p in pieces], np.int64), return_counts=True)
    repeated = {int(m): 1 << k for k, m in enumerate(marks[counts > 1])}
    bit_of, bins = {}, OpenBins(capacity)
    for size, doc_id, piece, start, source, cluster in pieces:
        bit = 1 << bit_of.setdefault(source, len(bit_of)) if source_once else 0
        number = bins.place(size, bit, repeated.get(cluster, 0))
        out.append((doc_id, piece, start, size, group << 32 | number, source, cluster))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [[]] * 7, PLACED)],
                                      schema=PLACED)


def packed(batches, capacity: int, source_once: bool):
    current, rows = None, []
    for batch in batches:
        for group, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if group != current and rows:
                yield pack_group(current, rows, capacity, source_once)
                rows = []
            current = group
            rows.append(tuple(row))
    if rows:
        yield pack_group(current, rows, capacity, source_once)


def pack(docs: DataFrame, capacity: int = CAPACITY, source_once: bool = True, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Place every word of ``docs`` (doc_id, text, source) in a bin of ``capacity`` words.

    Texts longer than a bin are cut into pieces of ``capacity`` words and a rest. No two
    pieces of equal texts (white space apart) share a bin, and with ``source_once`` no
    two of one source; a null source is a source. Within a group, pieces go in by
    falling size, then doc_id. Returns one row per piece: doc_id, piece, start (first
    word), n_words, bin_id, source, cluster. Texts without words are one row without a
    bin. Repeated rows are packed as often as they occur. Groups are dealt by id and text, so
    rows without an id spread as well.
    """
    groups = max(1, -(-docs.count() // group_rows))
    rows = sized(docs).withColumn("grp", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(groups)).cast("int"))
    return (rows.repartition("grp").sortWithinPartitions("grp").select("grp", "doc_id", "source", "size", "cluster")
            .mapInArrow(lambda batches: packed(batches, capacity, source_once),
                        "doc_id long, piece int, start long, n_words long, bin_id long, source string, cluster long"))
