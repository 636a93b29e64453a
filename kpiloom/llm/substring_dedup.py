"""Repeated substrings of 100 bytes through a sparse, range-partitioned suffix array.

Only suffixes at anchors are sorted: of every 100 bytes the run of GRAM bytes with the least
hash. Equal 100-byte strings have the same anchor, so it is enough to compare strings that
own an anchor with equal leading bytes. Anchors whose leading bytes occur once in the corpus drop
out first. The suffixes at the others, with what their strings reach to the left, are
dealt to ranges of leading bytes by sampled splitters; all with the same leading bytes meet, so
only neighbours inside a range need comparing: each range is sorted by multikey quicksort
in eight-byte symbols, the longest common prefixes of neighbours rule strings out, and
the rest are matched by hash. Copies that one task holds are folded before they travel.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, share, slices, stored

LENGTH, GRAM = 100, 16
#: Starts of grams in a string; the most bytes that the strings of one anchor span.
WINDOW = LENGTH - GRAM + 1
REACH = LENGTH + WINDOW - 1
#: Text bytes of a slice, anchors of a hash bucket and bytes of a range on average, bytes of the splitters' sample.
SLICE_BYTES, BUCKET_ANCHORS, RANGE_BYTES, SAMPLE_BYTES = 1 << 20, 350_000, 8 << 20, 4 << 20
LOW48 = np.uint64((1 << 48) - 1)


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data), ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)


def anchors(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Anchors of texts laid end to end: gram hash, position, first and last string start, text number."""
    n = len(data)
    if not (sizes >= LENGTH).any():
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4)
    words = words_at(data)
    later = np.concatenate([words[8:], np.zeros(8, np.uint64)])
    grams = mixed(words * np.uint64(0x9E3779B97F4A7C15) + mixed(later))
    # hash above, position below: the least is the leftmost gram of the least hash
    ranked = (grams & np.uint64(0xFFFFFFFFFF000000)) | np.arange(n, dtype=np.uint64)
    blocks = np.concatenate([ranked, np.full(-n % WINDOW + WINDOW, np.iinfo(np.uint64).max)]).reshape(-1, WINDOW)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    least = np.minimum(ahead[:n], behind[WINDOW - 1:WINDOW - 1 + n])
    place = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    valid = np.arange(n) + LENGTH <= (starts + sizes)[text]
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh)
    run = np.cumsum(fresh) - 1
    last = np.full(len(first), -1, np.int64)
    inside = np.flatnonzero(valid)
    np.maximum.at(last, run[inside], inside)
    return grams[place[first]], place[first], first, last, text[first]


def laid_out(ids, raws):
    parts = [r or b"" for r in raws.to_pylist()]
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.array(ids.to_pylist(), np.int64), np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes


ASKED = "bucket int, known boolean, grams binary, docs binary, counts binary, places binary"


def ask_grams(batches, buckets: int):
    """Anchors by the bucket of their gram; those repeated in the slice only echo, after one entry that says so."""
    for ids, data, starts, sizes, offset in bounded(batches):
        grams, place, first, last, text = anchors(data, starts, sizes)
        if not len(grams):
            continue
        # anchors have small hashes: scrambled again, they spread evenly over the buckets
        grams = mixed(grams ^ np.uint64(0x5851F42D4C957F2D))
        base = starts[text] - offset
        places = np.stack([place - base, first - base, last - base], axis=1).astype(np.uint32)
        order = np.argsort(grams, kind="stable")
        grams, places, docs = grams[order], places[order], ids[text[order]]
        fresh = np.concatenate([[True], grams[1:] != grams[:-1]])
        held = np.repeat(np.diff(np.append(np.flatnonzero(fresh), len(grams))), np.diff(np.append(np.flatnonzero(fresh), len(grams))))
        home = ((grams >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.int64)
        out = []

        def add(bucket, known, rows):
            rows = rows[np.argsort(docs[rows], kind="stable")]
            who, counts = np.unique(docs[rows], return_counts=True)
            out.append((bucket, known, (grams[rows] & LOW48).astype(np.uint64).tobytes() if not known else b"",
                        who.tobytes(), counts.astype(np.uint32).tobytes(), places[rows].tobytes()))

        for known, rows in ((False, np.flatnonzero(held == 1)), (True, np.flatnonzero(held > 1))):
            where = home[rows] if not known else (mixed(docs[rows].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(where, kind="stable")
            edges = np.searchsorted(where[by], np.arange(buckets + 1))
            for b in range(buckets):
                if edges[b] < edges[b + 1]:
                    add(b, known, rows[by[edges[b]:edges[b + 1]]])
        # of a gram that the slice repeats, its bucket only needs to know that it occurs
        several = np.flatnonzero(fresh & (held > 1))
        for b in np.unique(home[several]):
            rows = several[home[several] == b]
            out.append((int(b), False, (grams[rows] & LOW48).tobytes(), b"", b"", b""))
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.bool_()),
             *(pa.array(c, pa.binary()) for c in columns[2:])],
            names=["bucket", "known", "grams", "docs", "counts", "places"])


def bounded(batches, most: int = 1 << 23):
    """Texts laid end to end per slice, with an offset; a text too long for 24-bit positions goes in overlapping stretches."""
    for batch in slices(batches, SLICE_BYTES):
        ids, data, starts, sizes = laid_out(batch.column(0), batch.column(batch.num_columns - 1))
        if len(data) <= most:
            yield ids, data, starts, sizes, 0
            continue
        for doc, start, size in zip(ids, starts, sizes):
            for offset in range(0, max(1, size - LENGTH + 1), most):
                part = data[start + offset:start + min(size, offset + most + LENGTH - 1)]
                yield np.array([doc]), part, np.zeros(1, np.int64), np.array([len(part)]), offset


def by_part(docs: np.ndarray, values: np.ndarray, parts: int, name: str):
    """Rows of documents dealt to parts, packed."""
    part = (mixed(docs.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    rows = [(k, docs[order[a:b]].tobytes(), values[order[a:b]].tobytes())
            for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if a < b]
    columns = list(zip(*rows)) or [[]] * 3
    return pa.table({"part": pa.array(columns[0], pa.int32()), "docs": pa.array(columns[1], pa.binary()),
                     name: pa.array(columns[2], pa.binary())})


def repeated_grams(table: pa.Table, parts: int) -> pa.Table:
    """Of one bucket the anchors whose gram occurs more than once, by parts of the documents."""
    grams, docs, places, echo_docs, echo_places, others = [], [], [], [], [], []
    for known, g, d, c, p in zip(*(table[x].to_pylist() for x in ("known", "grams", "docs", "counts", "places"))):
        d = np.repeat(np.frombuffer(d, np.int64), np.frombuffer(c, np.uint32))
        p = np.frombuffer(p, np.uint32).reshape(-1, 3)
        if known:
            echo_docs.append(d)
            echo_places.append(p)
        elif len(d):
            grams.append(np.frombuffer(g, np.uint64))
            docs.append(d)
            places.append(p)
        else:
            others.append(np.frombuffer(g, np.uint64))
    if grams:
        grams = np.concatenate(grams)
        every, counts = np.unique(np.concatenate([grams, *others, *others]), return_counts=True)
        several = counts[np.searchsorted(every, grams)] > 1
        echo_docs.append(np.concatenate(docs)[several])
        echo_places.append(np.concatenate(places)[several])
    docs = np.concatenate(echo_docs) if echo_docs else np.zeros(0, np.int64)
    return by_part(docs, np.concatenate(echo_places) if echo_places else np.zeros((0, 3), np.uint32), parts, "places")


def by_document(table: pa.Table, name: str, width: int) -> pa.Table:
    """One row per document key of a part."""
    docs = np.concatenate([np.frombuffer(x, np.int64) for x in table["docs"].to_pylist()])
    values = np.concatenate([np.frombuffer(x, np.uint32).reshape(-1, width) for x in table[name].to_pylist()])
    order = np.lexsort((values[:, 1], values[:, 0], docs))
    docs, values = docs[order], values[order]
    # repeated rows tell the same twice
    new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (values[1:] != values[:-1]).any(axis=1)])[:len(docs)]
    docs, values = docs[new], values[new]
    starts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]])) if len(docs) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(docs))
    return pa.table({"key": pa.array(docs[starts]),
                     name: pa.array([values[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())})


def sampled_leads(batches):
    """Leading bytes of the anchors of sampled texts."""
    for _, data, starts, sizes, _ in bounded(batches):
        place = anchors(data, starts, sizes)[1]
        yield pa.RecordBatch.from_arrays([pa.array(words_at(data)[place].view(np.int64) if len(place) else [], pa.int64())],
                                         names=["lead"])


SUFFIXES = "range int, known boolean, docs binary, keys binary, firsts binary, shape binary, text binary"


def suffixes(batches, splitters: np.ndarray):
    """Anchors' stretches of text by range of their leading bytes; of equal ones in a slice the earliest.

    Equal stretches at the same start of texts that share an id are all the earliest.
    """
    ranges = len(splitters) + 1
    held, size = [], 0

    def flush():
        seen, entries, echo = {}, [], []
        for doc, first, lead, rows, key in sorted(held, key=lambda h: h[:2]):
            at, keys = seen.setdefault((lead, rows), ((doc, first), set()))
            if at != (doc, first):
                echo.append((key, first, first + len(rows)))
            elif key not in keys:
                keys.add(key)
                entries.append((doc, first, lead, rows, key))
        out = []
        if entries:
            leads = np.array([int.from_bytes(rows[lead:lead + 8], "big") for _, _, lead, rows, _ in entries], np.uint64)
            place = np.searchsorted(splitters, leads, side="right")
            for k in np.unique(place):
                own = [entries[i] for i in np.flatnonzero(place == k)]
                out.append((int(k), False, np.array([e[0] for e in own], np.int64).tobytes(),
                            np.array([e[4] for e in own], np.int64).tobytes(),
                            np.array([e[1] for e in own], np.uint32).tobytes(),
                            np.array([(e[2], len(e[3])) for e in own], np.uint8).tobytes(),
                            # neighbouring stretches overlap; the shuffle's own codec makes less of that
                            pa.compress(b"".join(e[3] for e in own), "zstd", asbytes=True)))
        if echo:
            docs = np.array([e[0] for e in echo], np.int64)
            spans = np.array([e[1:] for e in echo], np.uint32)
            out.append((int(mixed(docs[:1].view(np.uint64))[0] % np.uint64(ranges)), True, b"", docs.tobytes(), spans.tobytes(),
                        b"", b""))
        columns = list(zip(*out)) or [[]] * 7
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.bool_()),
             *(pa.array(c, pa.binary()) for c in columns[2:])],
            names=["range", "known", "docs", "keys", "firsts", "shape", "text"])

    for batch in batches:
        for doc, key, raw, places in zip(*(c.to_pylist() for c in batch.columns)):
            for place, first, last in np.frombuffer(places, np.uint32).reshape(-1, 3).tolist():
                if last + LENGTH <= len(raw):
                    held.append((doc, first, place - first, raw[first:last + LENGTH], key))
                    size += last - first + LENGTH + 150
            if size > 4 * SLICE_BYTES:
                yield flush()
                held.clear()
                size = 0
    if held:
        yield flush()


def multikey_groups(symbols, rows: np.ndarray, depth: int):
    """Vectorised multikey quicksort: rows sorted by up to ``depth`` symbols, with the symbols shared by neighbours.

    ``symbols(rows, k)`` gives symbol k. Each round sorts only rows that tie so far; ``shared[i]``
    is how many whole symbols row i has in common with the row before it.
    """
    order, group = rows.copy(), np.zeros(len(rows), np.int64)
    shared = np.zeros(len(rows), np.int64)
    active = np.arange(len(rows))
    for k in range(depth):
        if not len(active):
            break
        value = symbols(order[active], k)
        by = np.lexsort((value, group[active]))
        order[active] = order[active][by]
        value, same = value[by], group[active]
        tied = np.concatenate([[False], (same[1:] == same[:-1]) & (value[1:] == value[:-1])])
        shared[active[tied]] = k + 1
        number = np.cumsum(~tied)
        # new group numbers keep the order of the old ones
        group[active] = active[np.flatnonzero(~tied)][number - 1]
        size = np.bincount(number)[number]
        active = active[size > 1]
    return order, shared


def matched(table: pa.Table, parts: int) -> pa.Table:
    """Spans of one range's strings that occur earlier, by parts of the documents."""
    docs, keys, firsts, shape, texts, found_docs, found = [], [], [], [], [], [], []
    for known, d, i, f, s, t in zip(*(table[x].to_pylist() for x in ("known", "docs", "keys", "firsts", "shape", "text"))):
        if known:
            found_docs.append(np.frombuffer(i, np.int64))
            found.append(np.frombuffer(f, np.uint32).reshape(-1, 2))
        else:
            docs.append(np.frombuffer(d, np.int64))
            keys.append(np.frombuffer(i, np.int64))
            firsts.append(np.frombuffer(f, np.uint32))
            shape.append(np.frombuffer(s, np.uint8).reshape(-1, 2))
            texts.append(pa.decompress(t, int(shape[-1][:, 1].sum(dtype=np.int64)), "zstd", asbytes=True))
    if docs:
        docs, firsts, shape = np.concatenate(docs), np.concatenate(firsts).astype(np.int64), np.concatenate(shape).astype(np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin = np.cumsum(shape[:, 1]) - shape[:, 1]
        order = np.lexsort((firsts, docs))
        docs, keys, firsts, shape, begin = docs[order], np.concatenate(keys)[order], firsts[order], shape[order], begin[order]
        number = np.cumsum(np.concatenate([[False], docs[1:] != docs[:-1]])).astype(np.uint64)
        words = words_at(data)
        room = shape[:, 1] - shape[:, 0]

        def symbols(rows, k):
            # beyond a stretch a symbol is zero; what it holds there belongs to the next one
            left = np.clip(room[rows] - 8 * k, 0, 8)
            value = words[np.minimum(begin[rows] + shape[rows, 0] + 8 * k, len(words) - 1)]
            cut = (np.uint64(64) - (left * 8).astype(np.uint64)) & np.uint64(63)
            return np.where(left == 0, np.uint64(0), value >> cut << cut)

        rank, shared = multikey_groups(symbols, np.arange(len(docs)), -(-LENGTH // 8))
        after = np.append(shared[1:], 0)
        reach = np.zeros(len(docs), np.int64)
        reach[rank] = np.maximum(shared, after) * 8 + 8
        alike = np.zeros(len(docs), bool)
        alike[rank] = np.maximum(shared, after) * 8 >= GRAM
        hits = [repeats(data, begin[rows], shape[rows], reach[rows], rows, number[rows] << np.uint64(32) | firsts[rows].astype(np.uint64))
                for rows in alike_chunks(rank, shared, alike)]
        rows, low, high = (np.concatenate(x) for x in zip(*hits)) if hits else [np.zeros(0, np.int64)] * 3
        found_docs.append(keys[rows])
        found.append(np.stack([firsts[rows] + low, firsts[rows] + high + LENGTH], axis=1).astype(np.uint32))
    all_docs = np.concatenate(found_docs) if found_docs else np.zeros(0, np.int64)
    spans = np.concatenate(found) if found else np.zeros((0, 2), np.uint32)
    return by_part(all_docs, spans, parts, "spans")


def alike_chunks(rank, shared, alike, most: int = 15_000):
    """Rows that share their gram with another one, in chunks that don't part such rows."""
    cuts = np.flatnonzero(shared * 8 < GRAM)
    rows_of = np.append(cuts, len(rank))
    start = 0
    for k in range(len(cuts)):
        if rows_of[k + 1] - start >= most or k == len(cuts) - 1:
            rows = np.sort(rank[start:rows_of[k + 1]])
            rows = rows[alike[rows]]
            if len(rows):
                yield rows
            start = rows_of[k + 1]


def repeats(data, begin, shape, reach, rows, at):
    """Of entries in the order of their documents: those with strings seen before, and the first and last such string.

    ``at`` has the document's number above and the first start below: only a string with a smaller one was seen before.
    """
    base = np.uint64(0x9E3779B97F4A7C15)
    power = np.cumprod(np.full(REACH + 1, base, np.uint64))
    inverse = np.cumprod(np.full(REACH + 1, np.uint64(pow(int(base), -1, 1 << 64)), np.uint64))
    keys, entries, offsets = [], [], []
    for a in range(0, len(rows), 4096):
        b = min(a + 4096, len(rows))
        column = np.arange(REACH)
        cells = data[np.minimum(begin[a:b, None] + column, len(data) - 1)].astype(np.uint64) + np.uint64(1)
        cells *= power[:REACH]
        run = np.zeros((b - a, REACH + 1), np.uint64)
        np.cumsum(cells, axis=1, out=run[:, 1:])
        j = np.arange(REACH - LENGTH + 1)
        # a string's part right of the anchor must fit in what a neighbour shares
        use = (j + LENGTH <= shape[a:b, 1:2]) & (j + LENGTH - shape[a:b, :1] <= reach[a:b, None])
        value = (run[:, LENGTH:] - run[:, :-LENGTH]) * inverse[:REACH - LENGTH + 1]
        e, o = np.nonzero(use)
        keys.append(mixed(value[e, o]))
        entries.append(e + a)
        offsets.append(o)
    keys, entries, offsets = np.concatenate(keys), np.concatenate(entries), np.concatenate(offsets)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    fresh = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])[:len(keys)])
    places = (at[entries] + offsets.astype(np.uint64))[order]
    earliest = np.minimum.reduceat(places, fresh) if len(keys) else places
    seen = np.sort(order[places > np.repeat(earliest, np.diff(np.append(fresh, len(keys))))])
    entries, offsets = entries[seen], offsets[seen]
    first = np.flatnonzero(np.concatenate([[True], entries[1:] != entries[:-1]])) if len(entries) else np.zeros(0, np.int64)
    last = (np.append(first[1:], len(entries)) - 1)[:len(first)]
    return rows[entries[first]], offsets[first], offsets[last]


def removed(batches):
    """Texts without their spans."""
    for batch in batches:
        out = []
        for doc, raw, spans in zip(*(c.to_pylist() for c in batch.columns)):
            raw = raw or b""
            kept, at, cut, runs = hashlib.sha256(), 0, 0, 0
            begin = end = -1
            for start, stop in (np.frombuffer(spans, np.uint32).reshape(-1, 2).tolist() if spans else ()):
                stop = min(stop, len(raw))
                if start >= stop:
                    continue
                if start > end:
                    if end > begin:
                        kept.update(raw[at:begin])
                        at, cut, runs = end, cut + end - begin, runs + 1
                    begin, end = start, stop
                else:
                    end = max(end, stop)
            if end > begin:
                kept.update(raw[at:begin])
                at, cut, runs = end, cut + end - begin, runs + 1
            kept.update(raw[at:])
            out.append((doc, len(raw), cut, runs, kept.hexdigest()))
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string())],
                                         names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


#: Stands for a null doc_id inside; such rows count as the first document, each with its own spans.
NO_ID = -(1 << 63)


def repeated_substrings(docs: DataFrame) -> DataFrame:
    """What is left of each text of ``docs`` (doc_id, text) without 100-byte strings that occur earlier.

    Texts are bytes of UTF-8; null is empty. A string is earlier in a smaller doc_id, or at
    an earlier start of the same one; a null id comes first. Texts that share an id, or have
    none, are one document whose equal starts don't count as earlier; each loses its own spans
    only. Rows that repeat an id and a text get equal results.
    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row per row.
    """
    raw = F.col("text").cast("binary")
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("doc_id", raw).alias("key"), raw.alias("raw"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(32768, max(8, -(-total * 2 // WINDOW // BUCKET_ANCHORS))))
    ranges = int(min(32768, max(8, -(-total // RANGE_BYTES))))
    asked = rows.select("key", "raw").mapInArrow(lambda b: ask_grams(b, buckets), ASKED)
    echoed = (asked.repartition(buckets, "bucket").groupBy("bucket")
              .applyInArrow(lambda t: repeated_grams(t, buckets), "part int, docs binary, places binary"))
    places = stored(echoed.repartition(buckets, "part").groupBy("part").applyInArrow(
        lambda t: by_document(t, "places", 3), "key long, places binary"), "anchors")
    sample = rows.where(share(F.col("id"), 11) < min(1.0, SAMPLE_BYTES / max(1, total))).select("key", "raw")
    leads = np.sort(np.array([r[0] for r in sample.mapInArrow(sampled_leads, "lead long").collect()], np.int64).view(np.uint64))
    splitters = np.unique(leads[np.arange(1, ranges) * len(leads) // ranges]) if len(leads) else leads
    cut = (rows.join(places, "key").select("id", "key", "raw", "places").mapInArrow(lambda b: suffixes(b, splitters), SUFFIXES))
    spans = (cut.repartition(len(splitters) + 1, "range").groupBy("range")
             .applyInArrow(lambda t: matched(t, buckets), "part int, docs binary, spans binary"))
    spans = stored(spans.repartition(buckets, "part").groupBy("part").applyInArrow(
        lambda t: by_document(t, "spans", 2), "key long, spans binary"), "spans")
    out = rows.join(spans, "key", "left").select("id", "raw", "spans").mapInArrow(
        removed, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
