"""Document fingerprints by a threshold-scaled sketch, in DataFrame functions only.

A sketch is the sorted list of a text's shingle hashes below a fixed fraction of all hash
values. Which hashes stay does not depend on the text's size, so the sketch of two texts
together is the union of their sketches, and shares of common hashes estimate likeness and
containment also where one text is far longer. A text with words none of whose hashes lies
below keeps its smallest one, which holds for unions as well.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, stored

#: Words of a shingle, share of the hashes that a sketch keeps, hexadecimal digits of a hash.
WORDS, FRACTION, DIGITS = 5, 0.125, 12

#: Copies of a row that one step of its expansion makes.
CHUNK = 4096

KEY = ("z", "o", "h")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often it is named."""
    return F.transform(F.array(value), use)[0]


def limit(fraction: float) -> str:
    """Hashes that are less, as text, are the kept ones."""
    return f"{min(int(fraction * 16 ** DIGITS), 16 ** DIGITS - 1):0{DIGITS}x}"


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """A hash per run of ``words`` words, A-Z lower-cased; of all words where there are fewer, of none none."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    found = F.regexp_extract_all(lowered, F.lit(WORD_PATTERN), F.lit(0))
    return bound(found, lambda w: F.when(F.size(w) > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - (words - 1), F.lit(1))),
        lambda i: F.substring(F.md5(F.array_join(F.slice(w, i, F.lit(words)), " ").cast("binary")), 1, DIGITS)))
        .otherwise(F.array().cast("array<string>")))


def sketch(text: Column, words: int = WORDS, fraction: float = FRACTION) -> Column:
    """Sorted distinct shingle hashes below ``fraction``, or the smallest where there is none; null is empty."""
    return reduced(shingle_hashes(F.coalesce(text, F.lit("")), words), fraction)


def reduced(hashes: Column, fraction: float) -> Column:
    """A sketch, or any hashes, at ``fraction``: to compare sketches, reduce both to the smaller one."""
    return bound(hashes, lambda h: bound(
        F.filter(h, lambda x: x < limit(fraction)),
        lambda low: F.when(F.size(low) > 0, F.array_sort(F.array_distinct(low)))
        .when(F.size(h) > 0, F.array(F.array_min(h))).otherwise(low)))


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Sketch of two texts' shingles together."""
    return reduced(F.array_union(a, b), fraction)


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all of both, an estimate of the Jaccard similarity; two empty sketches are alike."""
    return bound(common(a, b), lambda n: share_of_all(a, b, n))


def common(a: Column, b: Column) -> Column:
    """Number of hashes that both have."""
    return F.size(F.array_intersect(a, b))


def share_of_all(a: Column, b: Column, n: Column) -> Column:
    """``likeness`` of two sketches with ``n`` common hashes."""
    return F.when(F.size(a) + F.size(b) > 0, n / (F.size(a) + F.size(b) - n)).otherwise(F.lit(1.0))


def share_of_one(a: Column, n: Column) -> Column:
    """``containment`` of a sketch of which another has ``n`` hashes."""
    return F.when(F.size(a) > 0, n / F.size(a)).otherwise(F.lit(1.0))


def containment(a: Column, b: Column) -> Column:
    """Share of ``a``'s hashes that ``b`` has: how much of one text is in another of any length. Nothing is in all."""
    return share_of_one(a, common(a, b))


def as_text(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def from_binary(packed: Column) -> Column:
    """The hashes of a sketch that was stored as bytes."""
    return F.regexp_extract_all(F.lower(F.hex(packed)), F.lit(f".{{{DIGITS}}}"), F.lit(0))


def keyed(docs: DataFrame) -> DataFrame:
    """Texts under a key that sorts by descending id, null last, then by digest."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").isNull().cast("int").alias("z"),
                       F.bitwise_not(F.coalesce(F.col("doc_id").cast("long"), F.lit(0))).alias("o"),
                       F.md5(text.cast("binary")).alias("h"), text.alias("text"))


def successions(keys: DataFrame) -> DataFrame:
    """The key that follows each key of ``keys`` (z, o, h, n_chars, copies), the first after the last.

    Rows are range-partitioned and followed inside a partition; only one row per partition
    is looked at together, to lead from one partition to the next. Of equal rows, all but
    one are followed by themselves: one result row each for both kinds, with their number ``times``.
    """
    ranged = stored(keys.repartitionByRange(*KEY).select("*", F.spark_partition_id().alias("part")), "fingerprint-keys")
    heads = ranged.groupBy("part").agg(F.min(F.struct(*KEY)).alias("head"))
    after = heads.select("part", F.coalesce(F.lead("head").over(Window.orderBy("part")),
                                            F.min("head").over(Window.partitionBy())).alias("after"))
    inside = ranged.select("*", F.lead(F.struct(*KEY)).over(Window.partitionBy("part").orderBy(*KEY)).alias("next"))
    both = F.array(F.struct(F.coalesce("next", "after").alias("to"), F.lit(1).cast("long").alias("times")),
                   F.struct(F.struct(*KEY).alias("to"), (F.col("copies") - 1).alias("times")))
    return (inside.join(after, "part").select(*KEY, "n_chars", F.explode(F.filter(both, lambda b: b["times"] > 0)).alias("b"))
            .select(*KEY, "n_chars", F.col("b.times").alias("times"), *(F.col(f"b.to.{k}").alias(f"to_{k}") for k in KEY)))


def fingerprints(docs: DataFrame, words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text) and of their edited texts, and their likeness.

    A document's edited text has its last floor(n_chars / 3) code points replaced by the
    first as many (or all) of the next document's, in descending order of ids, null last,
    equal ids by digest of the text; after the last document comes the first. Null texts
    count as empty; an empty text has an empty fingerprint, as like as can be to another
    empty one and 0 to others. Rows that repeat id and text follow each other. One row per
    row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, in_edited and in_next (containment of the document in either).

    Texts are shuffled once, by key, and a third of them once more, to their predecessors.
    """
    rows = keyed(docs)
    keys = rows.groupBy(*KEY).agg(F.max(F.length("text")).cast("long").alias("n_chars"), F.count("*").alias("copies"))
    # used twice with the same columns, so that its shuffle is done once
    texts = (rows.select(*KEY, "text", F.unhex(as_text(sketch(F.col("text"), words, fraction))).alias("packed"))
             .groupBy(*KEY).agg(F.first("text").alias("text"), F.first("packed").alias("packed")))
    to = successions(keys).alias("s")
    begun = texts.alias("t").join(to, [F.col(f"t.{k}") == F.col(f"s.to_{k}") for k in KEY]).select(
        *(F.col(f"s.{k}").alias(k) for k in KEY), "times",
        F.substring(F.col("text"), F.lit(1), F.floor(F.col("n_chars") / 3).cast("int")).alias("begin"),
        F.col("packed").alias("next_packed"))
    n = F.length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (n - F.floor(n / 3)).cast("int")), F.col("begin"))
    found = texts.join(begun, list(KEY)).select(
        *KEY, "times", n.cast("long").alias("n_chars"), edited.alias("edited"), from_binary(F.col("packed")).alias("own"),
        from_binary(F.col("next_packed")).alias("next"))
    found = found.select("*", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited"), words, fraction).alias("new"))
    own, new, follower = F.col("own"), F.col("new"), F.col("next")
    # counted once, for both shares
    found = found.select("*", common(own, new).alias("n_new"), common(own, follower).alias("n_next"))
    steps = F.sequence(F.lit(0), ((F.col("times") - 1) / CHUNK).cast("long"))
    out = found.select(
        F.when(F.col("z") == 0, F.bitwise_not("o")).alias("doc_id"), "n_chars", "edited_sha256",
        as_text(own).alias("fingerprint"), as_text(new).alias("edited_fingerprint"),
        share_of_all(own, new, F.col("n_new")).alias("near_edited"), share_of_all(own, follower, F.col("n_next")).alias("near_next"),
        share_of_one(own, F.col("n_new")).alias("in_edited"), share_of_one(own, F.col("n_next")).alias("in_next"),
        "times", F.explode(steps).alias("step"))
    more = F.least(F.lit(CHUNK), F.col("times") - F.col("step") * CHUNK).cast("int")
    return out.select("*", F.explode(F.array_repeat(F.lit(1), more)).alias("one")).drop("times", "step", "one")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         row_number() OVER (ORDER BY doc_id DESC NULLS LAST, md5(coalesce(text, ''))) AS at, count(*) OVER () AS n
  FROM documents),
p AS (SELECT a.doc_id, a.text, b.text AS follower,
             left(a.text, length(a.text) - length(a.text) // 3) || left(b.text, length(a.text) // 3) AS edited
      FROM d a JOIN d b ON b.at = a.at % a.n + 1),
t AS (SELECT text FROM d UNION SELECT edited FROM p),
w AS (SELECT text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM t),
h AS (SELECT text, CASE WHEN len(w) = 0 THEN []::VARCHAR[] ELSE
               list_transform(range(1, greatest(len(w) - 4, 1) + 1),
                              lambda i: substr(md5(array_to_string(w[i:i + 4], ' ')), 1, 12)) END AS h FROM w),
k AS (SELECT text, h, list_sort(list_distinct(list_filter(h, lambda x: x < '200000000000'))) AS low FROM h),
s AS (SELECT text, CASE WHEN len(low) > 0 THEN low WHEN len(h) > 0 THEN [list_min(h)] ELSE []::VARCHAR[] END AS s FROM k),
x AS (SELECT p.doc_id, p.text, p.edited, a.s AS own, b.s AS new, len(list_intersect(a.s, b.s)) AS same,
             c.s AS next, len(list_intersect(a.s, c.s)) AS common
      FROM p JOIN s a ON a.text = p.text JOIN s b ON b.text = p.edited JOIN s c ON c.text = p.follower)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
       coalesce(array_to_string(own, ''), '') AS fingerprint, coalesce(array_to_string(new, ''), '') AS edited_fingerprint,
       CASE WHEN len(own) + len(new) > 0 THEN same / (len(own) + len(new) - same) ELSE 1 END::DOUBLE AS near_edited,
       CASE WHEN len(own) + len(next) > 0 THEN common / (len(own) + len(next) - common) ELSE 1 END::DOUBLE AS near_next,
       CASE WHEN len(own) > 0 THEN same / len(own) ELSE 1 END::DOUBLE AS in_edited,
       CASE WHEN len(own) > 0 THEN common / len(own) ELSE 1 END::DOUBLE AS in_next
FROM x
"""
