"""Near-duplicate texts: a Jaccard join of word shingles filtered under several token orders.

Texts with equal shingle sets are one vertex. Tokens travel to hash buckets in packed
arrays; a bucket learns which tokens occur in several sets, and how often. A pair can
only reach the threshold if it shares a token in both prefixes under any one global order, so
a set whose unshared tokens alone fill its prefix has no partner and leaves. The others
meet in the posting lists of a rare-first order; a candidate must also share prefix tokens
under a second order before its overlap is counted. A list is first compared with a few
members; only members that are then still in another component than most of the list are
compared with the rest of it. No link between components can be missed, and a group of
near copies costs a few comparisons a member.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, components, mixed, slices, stored

WORDS = 5
#: Tokens of one bucket on average; a token in one of RARITY sets or more is common.
BUCKET_TOKENS, RARITY = 2_000_000, 100
#: Members that every other one of a posting list is compared with at first.
LEADERS = 4
LOW48 = np.uint64((1 << 48) - 1)


def shingles(raw: bytes, hashes: WordHashes) -> np.ndarray:
    """Distinct hashed shingles of a text, ascending; fewer words than WORDS are one."""
    words = raw.lower().split()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    k = min(WORDS, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i]
    return np.unique(mixed(out))


def signature(tokens: np.ndarray) -> int:
    """64 bits that stand for a whole set."""
    if not len(tokens):
        return 0
    total = np.add.reduce(mixed(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5))) + np.uint64(len(tokens))
    return int(mixed(np.array([total], np.uint64)).view(np.int64)[0])


def set_rows(batches):
    """Of every text the size and signature of its set; and the tokens that are common in the batch."""
    hashes = WordHashes()
    for batch in slices(batches):
        ids, raws = batch.columns
        sizes, marks, seen = [], [], {}
        for raw in raws.to_pylist():
            tokens = shingles(raw or b"", hashes)
            mark = signature(tokens)
            sizes.append(len(tokens))
            marks.append(mark)
            if len(tokens) and mark not in seen:
                seen[mark] = tokens
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), pa.array(marks, pa.int64()), pa.array([None] * len(sizes), pa.int64())],
            names=["doc_id", "n", "sid", "token"])
        if seen:
            tokens, counts = np.unique(np.concatenate(list(seen.values())), return_counts=True)
            often = counts >= max(4, len(seen) // (2 * RARITY))
            tokens, counts = tokens[often], counts[often]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(tokens), pa.int64()), pa.array(counts, pa.int64()), pa.nulls(len(tokens), pa.int64()),
                 pa.array(tokens.view(np.int64))], names=["doc_id", "n", "sid", "token"])


PACKED = "bucket int, common boolean, sids binary, sizes binary, counts binary, low binary, high binary"


def packed_rows(batches, buckets: int, common: np.ndarray):
    """Tokens of each batch's sets by bucket: a row holds the tokens of many sets, six bytes each."""
    hashes = WordHashes()
    for batch in slices(batches):
        sets = {}
        for raw in batch.column(0).to_pylist():
            tokens = shingles(raw or b"", hashes)
            if len(tokens):
                sets.setdefault(signature(tokens), tokens)
        if not sets:
            continue
        sids = np.fromiter(sets, np.int64, len(sets))
        sizes = np.fromiter(map(len, sets.values()), np.uint32, len(sets))
        tokens = np.concatenate(list(sets.values()))
        owner = np.repeat(np.arange(len(sids), dtype=np.uint32), sizes)
        place = ((tokens >> np.uint64(48)) * np.uint64(buckets)) >> np.uint64(16)
        usual = ~np.isin(tokens, common) if len(common) else np.ones(len(tokens), bool)
        place = np.where(usual, place.astype(np.int32), np.int32(buckets))
        order = np.argsort(place, kind="stable")
        edges = np.searchsorted(place[order], np.arange(buckets + 2))
        out = []
        for b in range(buckets + 1):
            part = order[edges[b]:edges[b + 1]]
            if len(part):
                who, count = np.unique(owner[part], return_counts=True)
                bits = tokens[part] if b == buckets else tokens[part] & LOW48
                out.append((int(sids[0]) % buckets if b == buckets else b, b == buckets, sids[who].tobytes(),
                            sizes[who].tobytes(), count.astype(np.uint32).tobytes(),
                            (bits & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                            (bits >> np.uint64(32)).astype(np.uint32 if b == buckets else np.uint16).tobytes()))
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.bool_()),
             *(pa.array(c, pa.binary()) for c in columns[2:])],
            names=["bucket", "common", "sids", "sizes", "counts", "low", "high"])


SHARED = "part int, sids binary, sizes binary, tokens binary, often binary"


def by_part(sids, sizes, tokens, often, parts: int):
    """The rows of a bucket dealt to parts by set, packed."""
    part = (mixed(sids.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    out = []
    for k in range(parts):
        rows = order[edges[k]:edges[k + 1]]
        if len(rows):
            out.append((k, sids[rows].tobytes(), sizes[rows].tobytes(), tokens[rows].tobytes(), often[rows].tobytes()))
    columns = list(zip(*out)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                                      names=["part", "sids", "sizes", "tokens", "often"])


def shared_tokens(table: pa.Table, parts: int, common: np.ndarray, common_counts: np.ndarray) -> pa.Table:
    """Of one bucket: the tokens that several sets hold, by parts of the sets, with the number of their holders."""
    out = []
    usual, frequent = [], []
    for row in table.to_batches():
        columns = [c.to_pylist() for c in row.columns]
        for bucket, is_common, sids, sizes, counts, low, high in zip(*columns):
            counts = np.frombuffer(counts, np.uint32)
            high = np.frombuffer(high, np.uint32 if is_common else np.uint16).astype(np.uint64)
            bits = np.frombuffer(low, np.uint32) | high << np.uint64(32)
            if not is_common:
                bits = bits | np.uint64(bucket) << np.uint64(48)
            (frequent if is_common else usual).append(
                (np.repeat(np.frombuffer(sids, np.int64), counts), np.repeat(np.frombuffer(sizes, np.uint32), counts),
                 bits))
    if usual:
        sids, sizes, tokens = (np.concatenate(x) for x in zip(*usual))
        usual.clear()
        order = np.argsort(tokens)
        sids, sizes, tokens = sids[order], sizes[order], tokens[order]
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        held = np.diff(np.append(starts, len(tokens)))
        several = np.minimum.reduceat(sids, starts) != np.maximum.reduceat(sids, starts)
        kept = np.repeat(several, held)
        if kept.any():
            out.append(by_part(sids[kept], sizes[kept], tokens[kept].view(np.int64),
                               np.repeat(held, held)[kept].astype(np.int32), parts))
    if frequent:
        sids, sizes, tokens = (np.concatenate(x) for x in zip(*frequent))
        often = common_counts[np.searchsorted(common, tokens)]
        # above every bucket's tokens, so that the two kinds can't meet
        out.append(by_part(sids, sizes, (tokens | np.uint64(1 << 63)).view(np.int64), often.astype(np.int32), parts))
    schema = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("sids", "sizes", "tokens", "often"))])
    return pa.Table.from_batches(out, schema=schema)


RECORD = ("sid long, n long, shared long, tokens binary, first array<long>, second binary")


def records(table: pa.Table) -> pa.Table:
    """Sets of one part that can have a partner: their shared tokens and their prefixes under two orders."""
    kinds = (("sids", np.int64), ("sizes", np.uint32), ("tokens", np.int64), ("often", np.int32))
    sids, sizes, tokens, often = (np.concatenate([np.frombuffer(x, kind) for x in table[name].to_pylist()])
                                  for name, kind in kinds)
    order = np.lexsort((tokens, sids))
    sids, tokens = sids[order], tokens[order]
    once = np.concatenate([[True], (sids[1:] != sids[:-1]) | (tokens[1:] != tokens[:-1])])
    sids, sizes, tokens, often = sids[once], sizes[order][once].astype(np.int64), tokens[once], often[order][once]
    starts = np.flatnonzero(np.concatenate([[True], sids[1:] != sids[:-1]]))
    out = []
    for a, b in zip(starts, np.append(starts[1:], len(sids))):
        n = int(sizes[a])
        prefix = n - (4 * n + 4) // 5 + 1 - (n - (b - a))
        if prefix > 0:
            own, held = tokens[a:b], often[a:b]
            scrambled = mixed(own.view(np.uint64))
            first = own[np.lexsort((scrambled, held))[:prefix]]
            grade = np.log2(held).astype(np.int8)
            second = own[np.lexsort((scrambled ^ np.uint64((1 << 64) - 1), grade))[:prefix]]
            out.append((int(sids[a]), n, int(b - a), own.tobytes(), first.tolist(), np.sort(second).tobytes()))
    columns = list(zip(*out)) or [[]] * 6
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                names=["sid", "n", "shared", "tokens", "first", "second"])


def overlap_check(batches):
    """Links among candidate pairs that meet in the second prefixes as well."""
    for batch in batches:
        a, b = [], []
        for x, y, nx, ny, tx, ty, px, py in zip(*(c.to_pylist() for c in batch.columns)):
            if not len(np.intersect1d(np.frombuffer(px, np.int64), np.frombuffer(py, np.int64), True)):
                continue
            both = len(np.intersect1d(np.frombuffer(tx, np.int64), np.frombuffer(ty, np.int64), True))
            if 5 * both >= 4 * (nx + ny - both):
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = sets.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"),
                      F.col("second").alias("pa"))
    two = sets.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"),
                      F.col("second").alias("pb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ta", "tb", "pa", "pb").mapInArrow(
        overlap_check, "a long, b long")


def fits(n1, rest1, n2, rest2):
    """Whether a pair's first common token leaves both enough tokens for the overlap that their sizes ask for."""
    return 9 * F.least(rest1, rest2) >= 4 * (n1 + n2)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Components of texts whose word shingles have a Jaccard similarity of 0.8 or more.

    ``docs`` needs doc_id (long) and text. Returns doc_id, n_shingles, component_id, one row
    per row. Null texts and texts without words have no shingle and are their own
    component; texts with equal sets are linked. A component is named by its smallest doc_id.
    """
    raw = F.col("text").cast("binary").alias("raw")
    scanned = stored(docs.select("doc_id", raw).mapInArrow(set_rows, "doc_id long, n long, sid long, token long"),
                     "shingle-sets")
    members = scanned.where("token is null").select("doc_id", "n", "sid")
    many = members.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    total = many[1] or 0
    buckets = int(min(32768, max(8, -(-total // BUCKET_TOKENS))))
    # at most RARITY times the mean set size of them
    common = (scanned.where("token is not null").groupBy("token").agg(F.sum("n").alias("often"))
              .where(F.col("often") >= max(50, many[0] // RARITY)).collect())
    common_tokens = np.array([r[0] for r in common], np.int64).view(np.uint64)
    order = np.argsort(common_tokens)
    common_tokens, counts = common_tokens[order], np.array([r[1] for r in common], np.int64)[order]
    packed = docs.select(raw).mapInArrow(lambda batches: packed_rows(batches, buckets, common_tokens), PACKED)
    shared = (packed.repartition(buckets, "bucket").groupBy("bucket")
              .applyInArrow(lambda t: shared_tokens(t, buckets, common_tokens, counts), SHARED))
    sets = stored(shared.repartition(buckets, "part").groupBy("part").applyInArrow(records, RECORD), "shingle-records")
    # rest: shared tokens from this one on, in the first order
    postings = sets.select("sid", "n", "shared", F.posexplode("first").alias("at", "token")).select(
        "token", "sid", "n", (F.col("n") - F.col("shared")).alias("alone"), (F.col("shared") - F.col("at")).alias("rest"))

    member = F.struct("alone", "sid", "n", "rest")
    lead = [F.min(F.when(F.pmod(F.xxhash64("sid"), F.lit(LEADERS)) == k, member)) for k in range(LEADERS)]
    lists = postings.groupBy("token").agg(F.array_compact(F.array(*lead)).alias("l"), F.count("*").alias("m")).where(
        "m > 1").select("token", F.explode("l").alias("l"))
    met = postings.join(lists, "token").where(F.col("sid") != F.col("l.sid")).where(
        fits(F.col("n"), F.col("rest"), F.col("l.n"), F.col("l.rest")))
    pairs = met.select(F.least("sid", "l.sid").alias("a"), F.greatest("sid", "l.sid").alias("b")).distinct()
    links = stored(verified(pairs, sets), "leader-links")

    roots = components(links, "leader-components")
    placed = postings.join(roots, postings.sid == roots.id, "left").select(
        "token", "sid", "n", "rest", F.coalesce("root", "sid").alias("root"))
    placed = stored(placed, "postings")
    tops = (placed.groupBy("token", "root").agg(F.count("*").alias("m")).groupBy("token")
            .agg(F.max_by("root", "m").alias("top"), F.count("*").alias("parts")).where("parts > 1"))
    apart = placed.join(tops, "token").where("root <> top").select(
        "token", *(F.col(c).alias(f"{c}_1") for c in ("sid", "n", "rest", "root")))
    crossed = placed.join(apart, "token").where("root <> root_1").where(
        fits(F.col("n"), F.col("rest"), F.col("n_1"), F.col("rest_1")))
    pairs = crossed.select(F.least("sid", "sid_1").alias("a"), F.greatest("sid", "sid_1").alias("b")).distinct()
    more = stored(verified(pairs, sets).unionByName(links), "links")

    roots = stored(components(more), "components")
    heads = members.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("head"), F.count("*").alias("rows"))
    heads = heads.join(roots, heads.sid == roots.id, "left").where("rows > 1 or root is not null").select(
        "sid", "head", F.coalesce("root", "sid").alias("root"))
    heads = stored(heads, "heads")
    least = heads.groupBy("root").agg(F.min("head").alias("component_id"))
    named = heads.join(least, "root").select("sid", "component_id")
    return members.join(named, (members.sid == named.sid) & (members.n > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT r.a AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a
"""
