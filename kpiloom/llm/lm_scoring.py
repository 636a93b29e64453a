"""Language-model scores from Elias-Fano n-gram tries counted over the whole corpus.

Every n-gram counts, at any corpus size. Documents are tokenised once, into slices of word
numbers. A slice sends each hash bucket the contexts that fall into it with the words that
follow; the bucket packs what the training texts hold of them as a trie: an Elias-Fano
sequence of contexts, monotone pointers to each context's range of words, the words relative
to their context's rank, and quantised discounted probabilities. A context's successor search
gives its range, a word's successor search runs inside that range. Slices meet their replies
and are scored. Contexts that a sample finds frequent are split by the hash of the next word,
so that no bucket is hot. Words that the sample holds travel as two-byte names by falling
frequency, others as the bits of their hash that the trie keeps; a context with such a word
travels as its key. Ascending numbers travel as differences.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, bucketed, fold, mixed, share, slices

#: Highest order.
ORDER = 3
DISCOUNT = 0.75
#: Text bytes of a slice, tokens of a bucket on average, text bytes of the sample that finds frequent contexts and words.
SLICE_BYTES, BUCKET_TOKENS, SAMPLE_BYTES = 6 << 20, 1_500_000, 4 << 20
#: Bits of a context's hash inside its bucket, and of a word's hash inside its context.
CONTEXT_BITS, WORD_BITS = 48, 40
#: Steps of a quantised probability to a factor of two: each is right within a factor of 2 ** (1 / 2048).
STEPS = 1024
SPLIT = np.uint64(0x9E3779B97F4A7C15)
#: Hash of the end of a text.
END = np.uint64(0x454E44)
#: Two-byte name of words that travel by their hash.
OTHER = (1 << 16) - 1


#: Tasks that score at most, as Spark bounds the buckets of a table; a task scores one slice after another.
MOST_TASKS = 100_000


class EliasFano:
    """Ascending integers in about 2 + log2(universe / length) bits each, searched in bulk."""

    def __init__(self, values: np.ndarray, universe: int):
        values = values.astype(np.uint64)
        self.length = len(values)
        self.low_bits = max(0, (universe // max(1, self.length)).bit_length() - 1)
        low = values & np.uint64((1 << self.low_bits) - 1)
        self.low = pack_bits(low, self.low_bits)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        self.buckets = (universe >> self.low_bits) + 1
        # one bit per value, one zero per bucket, in words of 16 bits
        bits = np.zeros(self.length + self.buckets + 1, np.uint8)
        bits[high + np.arange(self.length)] = 1
        bits = np.pad(bits, (0, -len(bits) % 16 + 80))
        self.high = np.packbits(bits, bitorder="little").view(np.uint16)
        zeros = 16 - np.bitwise_count(self.high).astype(np.int64)
        self.zeros_before = np.concatenate([[0], np.cumsum(zeros)]).astype(np.uint32)
        self.ones_before = np.arange(len(self.zeros_before)) * 16 - self.zeros_before
        self.zero_of = self.one_of = None

    def get(self, index: np.ndarray) -> np.ndarray:
        """The values at positions."""
        if self.one_of is None:
            self.one_of = places(1)
        word = np.searchsorted(self.ones_before, index, side="right") - 1
        bit = word * 16 + self.one_of[self.high[word], index - self.ones_before[word]]
        return (bit - index).astype(np.uint64) << np.uint64(self.low_bits) | unpack_bits(self.low, self.low_bits, index)

    def bucket_start(self, bucket: np.ndarray) -> np.ndarray:
        """The bit after the zero that ends the bucket before."""
        if self.zero_of is None:
            self.zero_of = places(0)
        k = bucket - 1
        zero = np.maximum(k, 0)
        word = np.searchsorted(self.zeros_before, zero.astype(np.uint32), side="right") - 1
        place = self.zero_of[self.high[word], zero - self.zeros_before[word]]
        return np.where(k < 0, 0, word * 16 + place + 1)

    def range_of(self, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First value of each bucket and the one after its last."""
        start = self.bucket_start(bucket)
        word, shift = start >> 4, (start & 15).astype(np.uint64)
        ahead = (self.high[word].astype(np.uint64) | self.high[word + 1].astype(np.uint64) << np.uint64(16)
                 | self.high[word + 2].astype(np.uint64) << np.uint64(32)) >> shift
        free = ~ahead & np.uint64((1 << 32) - 1)
        run = np.bitwise_count((free & (~free + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        first = start - bucket
        long = np.flatnonzero(free == 0)
        if len(long):
            run[long] = self.bucket_start(bucket[long] + 1) - (bucket[long] + 1) - first[long]
        return first, first + run

    def successor(self, keys: np.ndarray, start: np.ndarray | int = 0, stop: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Position in [start, stop) of the first value >= each key, stop if none, and whether it equals the key."""
        stop = self.length if stop is None else stop
        high = (keys >> np.uint64(self.low_bits)).astype(np.int64)
        low = keys & np.uint64((1 << self.low_bits) - 1)
        inside = high < self.buckets
        first, end = self.range_of(np.minimum(high, self.buckets - 1))
        first, end = np.where(inside, first, self.length), np.where(inside, end, self.length)
        first, end = np.clip(first, start, stop), np.clip(end, start, stop)
        last = end.copy()
        # a frequent context fills whole buckets: halve the ranges
        open_ = np.flatnonzero(first < last)
        while len(open_):
            middle = (first[open_] + last[open_]) >> 1
            smaller = unpack_bits(self.low, self.low_bits, middle) < low[open_]
            first[open_] = np.where(smaller, middle + 1, first[open_])
            last[open_] = np.where(smaller, last[open_], middle)
            open_ = open_[first[open_] < last[open_]]
        same = first < end
        same[same] = unpack_bits(self.low, self.low_bits, first[same]) == low[same]
        return first, same


@cache
def places(bit: int) -> np.ndarray:
    """Place of the k-th zero, or one, in every word of 16 bits."""
    bits = (np.arange(1 << 16)[:, None] >> np.arange(16)) & 1
    return np.argsort(bits != bit, axis=1, kind="stable").astype(np.uint8)


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    if not width or not len(values):
        return np.zeros(0, np.uint64)
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    start = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
    word, shift = (start >> np.uint64(6)).astype(np.int64), start & np.uint64(63)
    # values are narrower than a word: one begins in each, and one at most reaches into the next
    firsts = -(-64 * np.arange(word[-1] + 1) // width)
    out[:len(firsts)] = np.bitwise_or.reduceat(values << shift, firsts)
    over = np.flatnonzero(shift + np.uint64(width) > np.uint64(64))
    out[word[over] + 1] |= values[over] >> (np.uint64(64) - shift[over])
    return out


def unpack_bits(packed: np.ndarray, width: int, index: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(index), np.uint64)
    start = index.astype(np.uint64) * np.uint64(width)
    word, shift = (start >> np.uint64(6)).astype(np.int64), start & np.uint64(63)
    value = packed[word] >> shift
    over = shift + np.uint64(width) > np.uint64(64)
    value[over] |= packed[word[over] + 1] << (np.uint64(64) - shift[over])
    return value & np.uint64((1 << width) - 1)


def ordered(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (0 to ``most``) in ascending order and their places.

    Where key and place fit one number, that is sorted, which is several times faster than sorting
    places, and of equal keys the first place comes first. Keys in order stay as they are.
    """
    bits = len(keys).bit_length()
    if (keys[1:] >= keys[:-1]).all():
        return keys, np.arange(len(keys))
    if int(most).bit_length() + bits > 64:
        order = np.argsort(keys)
        return keys[order], order
    both = keys.astype(np.uint64) << np.uint64(bits)
    both |= np.arange(len(keys), dtype=np.uint64)
    both.sort()
    order = (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    both >>= np.uint64(bits)
    return both.astype(keys.dtype, copy=False), order


def grouped(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys (0 to ``most``) in ascending order, a place of each, and the number of each place's key."""
    keys, order = ordered(keys, most)
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(first) - 1
    return keys[first], order[first], number


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes as the largest needs, byte by byte of all of them, compressed."""
    most = int(values.max()) if len(values) else 0
    values = values.astype("u1" if most < 1 << 8 else "u2" if most < 1 << 16 else "u4" if most < 1 << 32 else "u8")
    raw = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return bytes([values.itemsize]) + len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(block: bytes) -> np.ndarray:
    size, length = block[0], int.from_bytes(block[1:9], "little")
    raw = np.frombuffer(pa.decompress(block[9:], length, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(f"u{size}").ravel()


def steps(values: np.ndarray) -> bytes:
    """Ascending numbers as their differences."""
    values = values.astype(np.uint64)
    return packed(np.diff(values, prepend=np.zeros(1, np.uint64)))


def climbed(block: bytes) -> np.ndarray:
    """The numbers of ``steps``."""
    return np.cumsum(unpacked(block), dtype=np.uint64)


def joined(first: bytes, second: bytes) -> bytes:
    return len(first).to_bytes(8, "little") + first + second


def parted(block: bytes) -> tuple[bytes, bytes]:
    end = 8 + int.from_bytes(block[:8], "little")
    return block[8:end], block[end:]


def names_of(words: np.ndarray, common: np.ndarray, by_hash: np.ndarray) -> np.ndarray:
    """Two-byte names of words: their place in ``common``, OTHER without one."""
    if not len(common):
        return np.full(len(words), OTHER, np.uint16)
    at = by_hash[np.minimum(np.searchsorted(common, words, sorter=by_hash), len(common) - 1)]
    return np.where(common[at] == words, at, OTHER).astype(np.uint16)


def followers_of(codes: np.ndarray, hashes: np.ndarray) -> bytes:
    """Next words as two-byte names; those without one add the bits of their hash that a trie keeps."""
    return joined(packed(codes), packed(hashes[codes == OTHER] & np.uint64((1 << WORD_BITS) - 1)))


def low_hashes(block: bytes, common: np.ndarray) -> np.ndarray:
    """The words of ``followers_of`` as the low bits of their hashes."""
    codes, other = map(unpacked, parted(block))
    codes = codes.astype(np.int64)
    out = np.append(common, END)[np.minimum(codes, len(common))] & np.uint64((1 << WORD_BITS) - 1)
    out[codes == OTHER] = other
    return out


SLICES = "slice long, ids binary, flags binary, sizes binary, words binary, tokens binary, learned long"


def numbered(batches, common: np.ndarray):
    """Documents in numbered slices: ids, whether an id is null and whether the row teaches, token counts, the
    distinct words by name and then by hash, tokens as numbers of these, and the number of training tokens."""
    number = TaskContext.get().partitionId() << 32
    hashes, by_hash = WordHashes(), np.argsort(common)
    for part in slices(batches, SLICE_BYTES):
        ids = part.column(0).to_pylist()
        flags = np.array([[d is None for d in ids], part.column(1).to_pylist()], np.uint8)
        tokens, sizes = tokens_of((r or b"" for r in part.column(2).to_pylist()), hashes)
        words, tokens = np.unique(tokens, return_inverse=True)
        codes = names_of(words, common, by_hash)
        order = np.argsort(codes, kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        codes, words = codes[order], words[order]
        listed = joined(steps(codes[codes != OTHER]), steps(words[codes == OTHER]))
        row = (number, np.array([d or 0 for d in ids], np.int64).tobytes(), flags.tobytes(), packed(sizes), listed,
               packed(place[tokens]), int(sizes[flags[1] > 0].sum()))
        number += 1
        kinds = (pa.int64(), *[pa.binary()] * 5, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)],
                                         names=[f.split()[0] for f in SLICES.split(", ")])


def tokens_of(raws, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of texts, words and then one end of each, and the texts' token counts."""
    parts = []
    for raw in raws:
        words = raw.lower().split()
        h = np.empty(len(words) + 1, np.uint64)
        h[:-1] = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        h[-1] = END
        parts.append(h)
    return np.concatenate(parts), np.array(list(map(len, parts)), np.int64)


def context_keys(before: list[np.ndarray]) -> np.ndarray:
    """Hashes of contexts from the hashes of their words, the nearest word first."""
    scrambled = [mixed(b ^ np.uint64(0x5851F42D4C957F2D)) for b in before]
    key = scrambled[-1]
    for s in reversed(scrambled[:-1]):
        key = mixed(key * SPLIT + s)
    return key


def part_keys(context, part: np.ndarray) -> np.ndarray:
    return mixed(context + (part + np.uint64(1)) * SPLIT)


def home(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


class Slice:
    """Tokens of a slice as numbers of its distinct words, and per level the number of each token's context."""

    def __init__(self, sizes: bytes, words: bytes, tokens: bytes, common: np.ndarray):
        self.sizes = unpacked(sizes).astype(np.int64)
        names, others = map(climbed, parted(words))
        self.words = np.concatenate([common[names.astype(np.int64)], others])
        self.names = np.concatenate([names.astype(np.uint16), np.full(len(others), OTHER, np.uint16)])
        self.tokens = unpacked(tokens).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ends = self.starts + self.sizes - 1
        # texts begin after an end; the token before a text is the end of another one
        self.before = np.concatenate([self.tokens[-1:], self.tokens[:-1]])
        self.place = np.arange(len(self.tokens)) - np.repeat(self.starts, self.sizes)

    def contexts(self, levels: int):
        """Per level the tokens that have so long a context, its number at each, and one token of each number."""
        # every token is before another one, so the nearest words are all words
        number, one = self.before, np.empty(len(self.words), np.int64)
        one[number] = np.arange(len(number))
        rows = np.arange(len(number))
        yield rows, number, one
        for level in range(1, levels):
            whole = np.zeros(len(self.tokens), np.int64)
            whole[rows] = number
            rows = np.flatnonzero(self.place >= level)
            key = whole[rows - 1] * len(self.words) + self.before[rows]
            _, one, number = grouped(key, len(self.tokens) * len(self.words))
            yield rows, number, rows[one]


class Grams:
    """The distinct (context, word) pairs of one level of a slice in the order of their buckets.

    Of a bucket's contexts those of named words come first, by their words from the farthest to the nearest, then
    the others by their keys.

    ``hot`` has the hashes of frequent contexts and their numbers of parts. A part is a context of its own, with
    the words whose hash falls to it; a slice with a frequent context asks for all its parts.
    """

    def __init__(self, part: Slice, level: int, found, hot: tuple[np.ndarray, np.ndarray], buckets: int):
        self.rows, number, one = found
        word = part.tokens[self.rows]
        self.before = [part.before[one - back] for back in range(level + 1)]
        key = context_keys([part.words[b] for b in self.before])
        splits = np.ones(len(key), np.int64)
        if len(hot[0]):
            at = np.minimum(np.searchsorted(hot[0], key), len(hot[0]) - 1)
            splits = np.where(hot[0][at] == key, hot[1][at], 1)
        base = np.cumsum(splits) - splits
        self.context = np.repeat(np.arange(len(key)), splits)
        self.share = np.arange(len(self.context)) - base[self.context]
        split = splits[self.context] > 1
        key = key[self.context]
        key[split] = part_keys(key[split], self.share[split].astype(np.uint64))
        self.share = np.where(split, self.share + 1, 0)
        piece = base[number]
        wide = np.flatnonzero(splits[number] > 1)
        if len(wide):
            low = part.words[word[wide]] & np.uint64((1 << WORD_BITS) - 1)
            piece[wide] += (mixed(low) % splits[number[wide]].astype(np.uint64)).astype(np.int64)
        pair, _, self.entry_of = grouped(piece * len(part.words) + word, len(key) * len(part.words))
        piece, self.word = np.divmod(pair, len(part.words))
        # pieces of contexts and their entries by bucket
        bucket = home(key, buckets)
        keyed = np.zeros(len(one), bool)
        for b in self.before:
            keyed |= part.names[b] == OTHER
        self.keyed, self.key = keyed[self.context], key & np.uint64((1 << CONTEXT_BITS) - 1)
        # named contexts are numbered by their words: their order inside a bucket is that of their places
        many, self.pieces = ordered(bucket * 2 + self.keyed, 2 * buckets)
        many = np.flatnonzero(many & 1)
        at = self.pieces[many]
        self.pieces[many] = at[np.lexsort((self.key[at], bucket[at]))]
        self.piece_of, self.bucket = piece, bucket[self.pieces]
        self.held = np.bincount(piece, minlength=len(key))
        # pairs are in the order of their pieces
        held = self.held[self.pieces]
        self.entries = np.repeat((np.cumsum(self.held) - self.held)[self.pieces] - (np.cumsum(held) - held), held) + np.arange(len(piece))

    def times(self, trained: np.ndarray) -> np.ndarray:
        """How often training texts of the slice hold each pair."""
        return np.bincount(self.entry_of, trained[self.rows], len(self.word)).astype(np.int64)

    def spread(self, shares: np.ndarray, totals: np.ndarray, followers: np.ndarray):
        """Per token the discounted count of its pair, and the context's count and number of different next words."""
        whole = np.zeros((3, max(len(self.word), len(self.pieces))))
        whole[0, self.entries], whole[1, self.pieces], whole[2, self.pieces] = shares, totals, followers
        counts = whole[0, :len(self.word)] * whole[1, self.piece_of]
        totals = np.bincount(self.context, whole[1, :len(self.pieces)])
        followers = np.bincount(self.context, whole[2, :len(self.pieces)])
        context = self.context[self.piece_of]
        return counts[self.entry_of], totals[context][self.entry_of], followers[context][self.entry_of]


def sampled_block(raw: bytes, most: int = 1 << 16) -> bytes:
    """A stretch of ``most`` bytes of a long text, from an offset that its hash draws."""
    if len(raw) <= most:
        return raw
    start = xxhash.xxh3_64_intdigest(raw) % (len(raw) - most + 1)
    return raw[start:start + most]


def sampled_contexts(batches, levels: int):
    """Token hashes of sampled texts as level -1, and the hashes of their contexts per level."""
    hashes = WordHashes()
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            tokens, _ = tokens_of([sampled_block(raw or b"")], hashes)
            rows, padded = [(-1, tokens.tobytes())], np.concatenate([[END], tokens[:-1]])
            for level in range(min(levels, len(tokens))):
                key = context_keys([padded[level - back:len(padded) - back] for back in range(level + 1)])
                rows.append((level, key.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary()))],
                                             names=["level", "contexts"])


def tally(sample, level: int) -> tuple[np.ndarray, np.ndarray]:
    found = [np.frombuffer(r["contexts"], np.uint64) for r in sample if r["level"] == level]
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)


def frequent(sample, levels: int, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level the contexts that would take more than half a bucket, with the parts to split them into."""
    out = []
    for level in range(levels):
        keys, counts = tally(sample, level)
        load = counts * buckets / max(1, counts.sum())
        hot = (load > 0.5) & (counts >= 8)
        out.append((keys[hot], np.ceil(2 * load[hot]).astype(np.int64) + 1))
    return out


def common_words(sample) -> np.ndarray:
    """Hashes of the sample's words by how often they come; a word's place is its two-byte name."""
    words, counts = tally(sample, -1)
    return words[np.lexsort((words, -counts))][:OTHER]


#: Names of a piece of the bitmap of names; hashes that a task holds back to send each once.
PIECE, MOST_KEPT = 1 << 10, 1 << 21


def taught_words(batches, common: np.ndarray, parts: int):
    """Distinct words of training texts: of those without a name the hashes by part, of the others one bitmap a task,
    in pieces with a negative number."""
    seen, kept, held = np.zeros(1 << 16, np.uint8), [], 0
    rows = lambda parts, blocks: pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blocks, pa.binary())],
                                                            names=["part", "words"])

    def sent():
        others = np.unique(np.concatenate([np.zeros(0, np.uint64), *kept]))
        where = home(others, parts)
        edges = np.flatnonzero(np.diff(where, prepend=-1, append=parts))
        return rows(where[edges[:-1]], [steps(others[x:y]) for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())])

    for batch in batches:
        for flags, *columns in zip(*(c.to_pylist() for c in batch.columns)):
            part = Slice(*columns, common)
            teaches = np.repeat(np.frombuffer(flags, np.uint8).reshape(2, -1)[1].astype(bool), part.sizes)
            used = np.bincount(part.tokens[teaches], minlength=len(part.words)) > 0
            seen[part.names[used]] = 1
            kept.append(part.words[used & (part.names == OTHER)])
            held += len(kept[-1])
            if held > MOST_KEPT:
                yield sent()
                kept, held = [], 0
    yield sent()
    seen[OTHER] = 0
    used = np.flatnonzero(seen.reshape(-1, PIECE).any(axis=1))
    yield rows(-1 - used, [np.packbits(seen[k * PIECE:(k + 1) * PIECE]).tobytes() for k in used.tolist()])


def counted(table: pa.Table) -> pa.Table:
    """The number of different words of one part."""
    blocks = table["words"].to_pylist()
    if table["part"][0].as_py() < 0:
        n = int(np.bitwise_count(np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in blocks])).sum())
    else:
        n = len(np.unique(np.concatenate(list(map(climbed, blocks)))))
    return pa.table({"n": pa.array([n], pa.int64())})


REQUEST = "bucket int, slice long, contexts binary, keys binary, parts binary, held binary, words binary, times binary"


def requests(batches, buckets: int, hot: list, common: np.ndarray):
    """Of each slice the distinct n-grams by bucket of their context, with their counts in training texts."""
    for batch in batches:
        for number, flags, *columns in zip(*(c.to_pylist() for c in batch.columns)):
            part = Slice(*columns, common)
            trained = np.repeat(np.frombuffer(flags, np.uint8).reshape(2, -1)[1], part.sizes)
            for level, found in enumerate(part.contexts(len(hot))):
                grams = Grams(part, level, found, hot[level], buckets)
                times = grams.times(trained)[grams.entries]
                word, held = grams.word[grams.entries], grams.held[grams.pieces]
                ends = np.concatenate([[0], np.cumsum(held)])
                edges = np.flatnonzero(np.concatenate([[True], grams.bucket[1:] != grams.bucket[:-1], [True]]))
                out = []
                for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    p, q = ends[x], ends[y]
                    pieces = grams.pieces[x:y]
                    z = int((~grams.keyed[pieces]).sum())
                    whole, keyed = pieces[:z], pieces[z:]
                    *near, far = [part.names[b[grams.context[whole]]] for b in grams.before]
                    names = joined(steps(far), packed(np.concatenate([np.zeros(0, np.uint16), *near])))
                    out.append((level * buckets + int(grams.bucket[x]), number, names, steps(grams.key[keyed]),
                                packed(grams.share[whole]), packed(held[x:y]), followers_of(part.names[word[p:q]], part.words[word[p:q]]),
                                packed(times[p:q])))
                if out:
                    kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 6)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                     names=[f.split()[0] for f in REQUEST.split(", ")])


def quantised(share: np.ndarray) -> np.ndarray:
    """Probabilities as steps below 1; 0 stands for none."""
    return (np.rint(-np.log2(share) * STEPS) + 1).astype(np.uint16)


def probabilities(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, np.exp2((1.0 - codes) / STEPS), 0.0)


class Trie:
    """What training texts hold of one bucket: contexts, pointers to their words, words, quantised probabilities.

    Words of a context lie in [pointer of its rank, pointer of the next rank), so the pointers tell the number of
    different next words as well; words are stored relative to the rank, which keeps the whole level ascending.
    """

    def __init__(self, contexts: np.ndarray, words: np.ndarray, times: np.ndarray):
        names, _, number = grouped(contexts, 1 << CONTEXT_BITS)
        key, order = ordered(number.astype(np.uint64) << np.uint64(WORD_BITS) | words, len(names) << WORD_BITS)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
        counts = np.add.reduceat(times[order], starts) if len(key) else np.zeros(0, np.int64)
        key = key[starts]
        owner = (key >> np.uint64(WORD_BITS)).astype(np.int64)
        self.totals = np.bincount(owner, counts, len(names)).astype(np.int64)
        self.codes = quantised((counts - DISCOUNT) / self.totals[owner])
        self.contexts = EliasFano(names, 1 << CONTEXT_BITS)
        self.pointers = EliasFano(np.searchsorted(owner, np.arange(len(names) + 1)), len(key) + 1)
        self.words = EliasFano(key, max(1, len(names)) << WORD_BITS)

    def look_up(self, contexts: np.ndarray, held: np.ndarray, words: np.ndarray):
        """Codes of n-grams, and of each context its count and its number of different next words."""
        codes = np.zeros(len(words), np.uint16)
        totals, followers = np.zeros((2, len(contexts)), np.int64)
        if self.contexts.length:
            at, known = self.contexts.successor(contexts)
            start, stop = np.zeros((2, len(contexts)), np.int64)
            start[known], stop[known] = self.pointers.get(at[known]), self.pointers.get(at[known] + 1)
            totals[known], followers = self.totals[at[known]], stop - start
            some = np.flatnonzero(np.repeat(known, held))
            rank, start, stop = (np.repeat(x, held)[some] for x in (at, start, stop))
            place, same = self.words.successor(rank.astype(np.uint64) << np.uint64(WORD_BITS) | words[some], start, stop)
            codes[some[same]] = self.codes[place[same]]
        return codes, totals, followers


REPLY = "slice long, bucket int, codes binary, totals binary, followers binary"
#: Code of a pair that makes up all that a context holds.
ONLY = quantised(np.array([1 - DISCOUNT]))[0]


def reply(table: pa.Table, buckets: int, common: np.ndarray) -> pa.Table:
    """Each slice's look-ups in one bucket; what several slices ask is looked up once."""
    bucket = table["bucket"][0].as_py()
    level = bucket // buckets

    def asked(row):
        names, keys, parts, held, words, times = (table[c][row].as_py() for c in ("contexts", "keys", "parts", "held", "words", "times"))
        far, near = parted(names)
        parts = unpacked(parts).astype(np.uint64)
        before = [common[n] for n in unpacked(near).astype(np.int64).reshape(level, len(parts))] + [common[climbed(far).astype(np.int64)]]
        contexts = context_keys(before)
        split = parts > 0
        contexts[split] = part_keys(contexts[split], parts[split] - np.uint64(1))
        return (np.concatenate([contexts & np.uint64((1 << CONTEXT_BITS) - 1), climbed(keys)]), unpacked(held).astype(np.int64),
                low_hashes(words, common), unpacked(times).astype(np.int64))

    parts = [asked(row) for row in range(table.num_rows)]
    pieces, grams = (np.cumsum([0] + [len(p[k]) for p in parts]) for k in (0, 2))
    contexts, held, words, times = (np.concatenate(x) for x in zip(*parts))
    del parts
    contexts, _, context_of = grouped(contexts, 1 << CONTEXT_BITS)
    keys, _, gram_of = grouped(np.repeat(context_of, held).astype(np.uint64) << np.uint64(WORD_BITS) | words, len(contexts) << WORD_BITS)
    del words
    times = np.bincount(gram_of, times, len(keys)).astype(np.int64)
    owner, words = (keys >> np.uint64(WORD_BITS)).astype(np.int64), keys & np.uint64((1 << WORD_BITS) - 1)
    taught = times > 0
    trie = Trie(contexts[owner[taught]], words[taught], times[taught])
    codes, totals, followers = trie.look_up(contexts, np.bincount(owner, minlength=len(contexts)), words)
    out = []
    for row in range(table.num_rows):
        own, pairs = context_of[pieces[row]:pieces[row + 1]], gram_of[grams[row]:grams[row + 1]]
        out.append((table["slice"][row].as_py(), bucket,
                    *told(codes[pairs], totals[own], followers[own], held[pieces[row]:pieces[row + 1]])))
    kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 3)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                names=[f.split()[0] for f in REPLY.split(", ")])


def told(codes: np.ndarray, totals: np.ndarray, followers: np.ndarray, held: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """A reply: all counts, next words of contexts seen twice or more, codes of their pairs, and of pairs of contexts
    seen once whether they are what was seen."""
    total = np.repeat(totals, held)
    return (joined(packed(codes[total > 1]), packed(np.packbits(codes[total == 1] > 0))), packed(totals),
            packed(followers[totals > 1]))


def heard(codes: bytes, totals: bytes, followers: bytes, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``told`` was given, from its bytes and the number of pairs of each context."""
    totals = unpacked(totals).astype(np.int64)
    after = np.minimum(totals, 1)
    after[totals > 1] = unpacked(followers)
    total = np.repeat(totals, held)
    many, once = map(unpacked, parted(codes))
    out = np.zeros(len(total), np.int64)
    out[total > 1] = many
    single = np.flatnonzero(total == 1)
    out[single] = np.unpackbits(once, count=len(single)) * np.int64(ONLY)
    return out, totals, after


SCORES = "id long, n_tokens long, n_known long, base double, total double"


def scored(cut: pa.Table, replies: pa.Table, tokens_in_all: int, distinct: int, hot: list, common: np.ndarray, order: int,
           buckets: int) -> pa.Table:
    """Scores of one slice's documents from the replies of all buckets."""
    row = cut.to_pylist()[0]
    ids, flags = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["flags"], np.uint8).reshape(2, -1)
    part = Slice(row["sizes"], row["words"], row["tokens"], common)
    replies = {r["bucket"]: (r["codes"], r["totals"], r["followers"]) for r in replies.to_pylist()}
    p = known = one = None
    for level, found in enumerate(part.contexts(len(hot))):
        grams = Grams(part, level, found, hot[level], buckets)
        held = grams.held[grams.pieces]
        edges = np.flatnonzero(np.diff(grams.bucket, prepend=-1, append=buckets)).tolist()
        heards = [heard(*replies.pop(level * buckets + int(grams.bucket[x])), held[x:y]) for x, y in zip(edges[:-1], edges[1:])]
        if not heards:
            break
        codes, totals, followers = map(np.concatenate, zip(*heards))
        n, total, after = grams.spread(probabilities(codes), totals, followers)
        if not level:
            # what precedes the next token is this one; before a text's first token is an end
            known = np.append(total[1:], 0)
            known[part.ends] = total[part.starts]
            one = np.log10(known + 1.0)
            p = (known + 1.0) / (tokens_in_all + distinct + 1)
        if level > order - 2:
            break
        seen = total > 0
        rows, total = grams.rows[seen], total[seen]
        p[rows] = n[seen] / total + DISCOUNT * after[seen] / total * p[rows]
    base = np.add.reduceat(one, part.starts) - part.sizes * np.log10(tokens_in_all + distinct + 1)
    return pa.table({"id": pa.array(ids, pa.int64(), mask=flags[0].astype(bool)), "n_tokens": part.sizes,
                     "n_known": np.add.reduceat((known > 0).astype(np.int64), part.starts), "base": base,
                     "total": np.add.reduceat(np.log10(p), part.starts)})


def score_documents(docs: DataFrame, folds: int = 7, held_fold: int = 2, order: int = ORDER) -> DataFrame:
    """Unigram and n-gram log10 probabilities of every text of ``docs`` (doc_id, text).

    Rows outside fold ``held_fold`` teach, with all their n-grams. Tokens are words in ASCII
    lower case, then one end; a null or empty text is its end alone. Returns doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score, one row per row. Without a training
    row, N and V are 0. Rows that repeat an id and a text get equal scores. Quantised
    probabilities move ``score`` by at most 0.00015 a token; ``base_score`` is exact.
    """
    levels = max(1, order - 1)
    rows = docs.select("doc_id", (fold("doc_id", folds) != held_fold).alias("trained"), F.col("text").cast("binary").alias("raw"))
    letters = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(8, -(-letters // (6 * BUCKET_TOKENS))))
    drawn = rows.where(share(F.xxhash64("doc_id", "raw"), 17) < min(1.0, SAMPLE_BYTES / max(1, letters))).select("raw")
    sample = drawn.mapInArrow(lambda b: sampled_contexts(b, levels), "level int, contexts binary").collect()
    hot, common = frequent(sample, levels, buckets), common_words(sample)

    cut = bucketed(rows.mapInArrow(lambda b: numbered(b, common), SLICES), "lm_slices", "slice",
                   int(max(8, min(MOST_TASKS, letters // (2 * SLICE_BYTES)))))
    tokens = cut.agg(F.sum("learned")).first()[0] or 0
    taught = cut.select("flags", "sizes", "words", "tokens").mapInArrow(lambda b: taught_words(b, common, buckets), "part int, words binary")
    distinct = taught.repartition(buckets, "part").groupBy("part").applyInArrow(counted, "n long").agg(F.sum("n")).first()[0] or 0
    asked = cut.select("slice", "flags", "sizes", "words", "tokens").mapInArrow(lambda b: requests(b, buckets, hot, common), REQUEST)
    replies = asked.repartition(levels * buckets, "bucket").groupBy("bucket").applyInArrow(
        lambda t: reply(t, buckets, common), REPLY)
    found = cut.groupBy("slice").cogroup(replies.groupBy("slice")).applyInArrow(
        lambda c, r: scored(c, r, tokens, distinct, hot, common, order, buckets), SCORES)
    return found.select(F.col("id").alias("doc_id"), (fold("id", folds) == held_fold).alias("held_out"), "n_tokens", "n_known",
                        F.lit(int(tokens)).cast("long").alias("train_tokens"), F.col("base").alias("base_score"),
                        F.col("total").alias("score"))
