"""Ranked lexical search in reverse: the documents stream past an index of the queries.

The index of the items' terms is small: term -> items that hold it, and how often. It is
broadcast in blocks of bounded size. A first pass counts documents and how many hold each
indexed term; a second one turns a document's term counts into scores of all items that
share a term with it. A task keeps the best documents of each item in a bounded heap; heaps
are merged in two steps.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored

#: Entries (term, item) of an index at most, unless a single item has more distinct terms.
INDEX_ENTRIES = 1 << 20
#: Cells of the table of scores that one step fills, entries it expands at most on average, and groups of the first merge.
CELLS, ENTRIES, MERGES = 1 << 19, 1 << 20, 64

#: ASCII digits and letters, in lower case, and all bytes of other characters; the rest parts terms.
TERM_BYTES = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
                   for b in range(256))

COUNTED = "term long, docs long, terms long"
HEAPS = "item long, doc_id long, score long"


def terms_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(TERM_BYTES).split()


def item_terms(batches):
    """Terms of items with their number of occurrences."""
    for batch in batches:
        items, raws = (c.to_pylist() for c in batch.columns)
        rows = [(item, term, n) for item, raw in zip(items, raws) for term, n in Counter(terms_of(raw)).items()]
        columns = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int64()))],
                                         names=["item", "term", "n"])


class Index:
    """Items by term: for term number t, entries ``start[t]`` to ``start[t + 1]`` of ``item`` and ``times``."""

    def __init__(self, rows: list[tuple[int, bytes, int]]):
        rows = sorted(rows, key=lambda r: (r[1], r[0]))
        self.number = {}
        starts = []
        for at, (_, term, _) in enumerate(rows):
            if term not in self.number:
                self.number[term] = len(starts)
                starts.append(at)
        self.keys = np.unique(np.array([r[0] for r in rows], np.int64))
        self.item = np.searchsorted(self.keys, np.array([r[0] for r in rows], np.int64))
        self.times = np.array([r[2] for r in rows], np.int64)
        self.start = np.array([*starts, len(rows)], np.int64)


def document_frequencies(batches, index):
    """Per task: documents that hold each indexed term; under term -1, documents with a term and all their terms."""
    number = index.value.number
    held, docs, total = Counter(), 0, 0
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            terms = terms_of(raw)
            docs += bool(terms)
            total += len(terms)
            held.update(number.keys() & set(terms))
    rows = [(-1, docs, total), *((number[term], n, 0) for term, n in held.items())]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["term", "docs", "terms"])


class Heaps:
    """The ``n`` best documents of each item: highest score, then smallest id, null last."""

    def __init__(self, n: int):
        self.n = n
        self.item, self.doc, self.null, self.score = (np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))

    def add(self, item, doc, null, score) -> None:
        item, doc, null, score = (np.concatenate(c) for c in zip(
            (self.item, self.doc, self.null, self.score), (item, doc, null, score)))
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = place < self.n
        self.item, (self.doc, self.null, self.score) = item[keep], (c[order][keep] for c in (doc, null, score))

    def floors(self, items: int) -> np.ndarray:
        """The score that a further document needs at least, per item."""
        full = np.bincount(self.item, minlength=items) >= self.n
        least = np.full(items, np.iinfo(np.int64).max)
        np.minimum.at(least, self.item, self.score)
        return np.where(full, least, 1)


class Search:
    """Scores documents against an index."""

    def __init__(self, index: Index, weight: np.ndarray, docs: int, terms: int, n: int):
        self.index, self.weight, self.docs, self.terms, self.heaps = index, weight, docs, terms, Heaps(n)

    def score(self, ids: list, raws: list) -> None:
        """Look at some documents."""
        number, doc, term, tf, size = self.index.number, [], [], [], []
        for k, raw in enumerate(raws):
            words = terms_of(raw)
            size.append(len(words))
            counts = Counter(words)
            found = number.keys() & counts.keys()
            doc.extend([k] * len(found))
            term.extend([number[w] for w in found])
            tf.extend([counts[w] for w in found])
        if not doc:
            return
        doc, term, tf = (np.array(c, np.int64) for c in (doc, term, tf))
        length = 75 + 25 * np.array(size, np.int64) * self.docs // max(self.terms, 1)
        value = self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * length[doc]))
        width = self.index.start[term + 1] - self.index.start[term]
        items = len(self.index.keys)
        total = np.zeros((len(raws), items), np.int64)
        # entries of the index of all terms found, so many at a time
        parts = np.searchsorted(np.cumsum(width), np.arange(ENTRIES, width.sum(), ENTRIES))
        for part in np.split(np.arange(len(doc)), parts):
            wide = width[part]
            entry = np.repeat(self.index.start[term[part]] - np.cumsum(wide) + wide, wide) + np.arange(wide.sum())
            np.add.at(total, (np.repeat(doc[part], wide), self.index.item[entry]),
                      np.repeat(value[part], wide) * self.index.times[entry])
        row, item = np.nonzero(total >= self.heaps.floors(items)[None, :])
        if len(row):
            null = np.array([i is None for i in ids])
            known = np.array([i or 0 for i in ids], np.int64)
            self.heaps.add(item, known[row], null[row], total[row, item])


def searched(batches, index, weight, docs, terms, n):
    """Heaps of a task's documents."""
    search = Search(index.value, weight.value, docs, terms, n)
    step = max(1, CELLS // max(1, len(index.value.keys)))
    for batch in slices(batches):
        ids, raws = (c.to_pylist() for c in batch.columns)
        for k in range(0, len(ids), step):
            search.score(ids[k:k + step], raws[k:k + step])
    heaps = search.heaps
    yield pa.RecordBatch.from_arrays(
        [pa.array(index.value.keys[heaps.item]), pa.array(heaps.doc, mask=heaps.null), pa.array(heaps.score)],
        names=["item", "doc_id", "score"])


def blocks(entries: DataFrame, most: int) -> tuple[DataFrame, list[int]]:
    """Entries (item, term, n) with a ``block`` of at most ``most`` entries, and the blocks.

    Items are dealt by hash; the number of blocks doubles until each is small enough or is
    one item.
    """
    n = max(1, -(-entries.count() // most))
    while True:
        dealt = entries.select("*", F.pmod(F.xxhash64("item"), F.lit(n)).cast("int").alias("block"))
        sizes = dealt.groupBy("block").agg(F.count("*").alias("size"), F.min("item").alias("a"), F.max("item").alias("b"))
        if sizes.where((F.col("size") > most) & (F.col("a") < F.col("b"))).isEmpty():
            return dealt, sorted(r[0] for r in sizes.select("block").collect())
        n *= 2


def search(docs: DataFrame, items: DataFrame, n: int = 20, index_entries: int = INDEX_ENTRIES) -> DataFrame:
    """The ``n`` highest-scoring documents of ``docs`` (doc_id, text) for each of ``items`` (item_id, text).

    Terms are runs of characters other than ASCII ones that are no digit or letter, A-Z
    lower-cased; a null or empty text has none and is found by no item, nor finds any. With N
    documents that have a term, L terms in all, n of a document, df documents with a term
    and tf occurrences: w = floor(1000 ln((2 N + 2) / (2 df + 1))), m = 75 + 25 n N div L,
    and a score sums w * (10^9 tf div (1000 tf + 12 m)) over the item's terms, repeats
    included, in 64-bit integers. Scores are above 0; ties go by doc_id, null last.

    Every row is a document, also one that repeats an id. Items that repeat id and text
    are one; those that share an id only get a list each. Returns item_id, rank, doc_id,
    score. The index is broadcast in blocks of ``index_entries`` entries, each of which
    reads the documents twice; only an item with more distinct terms makes a larger one.
    """
    spark = docs.sparkSession
    asked = stored(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("raw"))
                   .distinct().select("*", F.monotonically_increasing_id().alias("item")), "search-items")
    entries = stored(asked.select("item", "raw").mapInArrow(item_terms, "item long, term binary, n long"), "search-entries")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw"))
    dealt, numbers = blocks(entries, index_entries)
    heaps = None
    for block in numbers:
        found = block_heaps(texts, dealt.where(F.col("block") == block), n)
        heaps = found if heaps is None else heaps.unionByName(found)
    if heaps is None:
        heaps = spark.createDataFrame([], HEAPS)
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    some = Window.partitionBy("item", "salt").orderBy(*order)
    heaps = (heaps.select("*", F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("salt"))
             .select("*", F.row_number().over(some).alias("place")).where(F.col("place") <= n))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    ranked = heaps.select("item", "doc_id", "score", rank.alias("rank")).where(F.col("rank") <= n)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def block_heaps(texts: DataFrame, entries: DataFrame, n: int) -> DataFrame:
    """Heaps of all tasks for the items of one block."""
    context = texts.sparkSession.sparkContext
    index = Index([(r[0], bytes(r[1]), r[2]) for r in entries.select("item", "term", "n").collect()])
    shared = context.broadcast(index)
    counted = texts.select("raw").mapInArrow(lambda batches: document_frequencies(batches, shared), COUNTED)
    held = np.zeros(len(index.number), np.int64)
    docs = terms = 0
    # one row per term of the index
    for term, with_it, size in counted.groupBy("term").agg(F.sum("docs"), F.sum("terms")).collect():
        if term < 0:
            docs, terms = with_it, size
        else:
            held[term] = with_it
    weight = context.broadcast(np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1))) for df in held.tolist()],
                                        np.int64))
    return texts.mapInArrow(lambda batches: searched(batches, shared, weight, docs, terms, n), HEAPS)


ORACLE = r"""
WITH c AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower,
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS term),
d AS (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(text, upper, lower), term) AS terms
      FROM documents, c WHERE text IS NOT NULL),
z AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
t AS (SELECT doc_id, row, len(terms) AS n, unnest(terms) AS term FROM d),
f AS (SELECT doc_id, row, n, term, count(*) AS tf FROM t GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, z GROUP BY term, n_docs),
i AS (SELECT item_id, text, unnest(regexp_extract_all(translate(text, upper, lower), term)) AS term
      FROM (SELECT DISTINCT item_id, text FROM benchmark), c),
q AS (SELECT item_id, text, term, count(*) AS times FROM i GROUP BY ALL),
s AS (SELECT item_id, q.text, doc_id, row,
             sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN f USING (term), z GROUP BY item_id, q.text, doc_id, row)
SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY rank <= 20
"""
