"""Each operator against plain Python on small tables: brute force, odd rows, empty tables, clashing names."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import (
    embedding_dedup, exact_dedup, html_text, jaccard_join, language_id, lm_scoring, mixing, packing, substring_dedup, toxicity)

from llm_helpers import WORDS, corpus, documents, roots_of, words_of


def test_exact_duplicates(spark):
    rows = corpus() + [(1000, "x  y"), (999, "x y "), (998, "xy"), (998, "xy"), (None, "xy")]
    got = exact_dedup.exact_duplicates(documents(spark, rows)).collect()
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc is None, doc))
    want = []
    for key, members in groups.items():
        keep = min(members)[2]
        want += [(doc, keep, len(members), doc == keep, hashlib.sha256(key.encode()).hexdigest()) for _, _, doc in members]
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_patricia_trie_gives_every_key_once():
    rng = random.Random(1)
    keys = sorted(bytes(rng.choices(b"ab", k=rng.randint(0, 8))) for _ in range(500))
    found = []
    trie = exact_dedup.PatriciaTrie(found.append)
    for i, key in enumerate(keys):
        trie.insert(key, (0, False, i, 1, key))
    trie.close()
    assert sorted((v[4], v[3]) for v in found) == sorted({(k, keys.count(k)) for k in keys})


def test_near_duplicates(spark):
    rows = corpus()
    docs = documents(spark, rows + [(None, "lonely words"), (1, "one two")])
    got = jaccard_join.near_duplicates(docs).collect()
    sets = {}
    for doc, text in rows:
        w = words_of(text)
        sets[doc] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    # the second row of id 1 equals the two-word texts
    two = [d for d, t in rows if words_of(t) == ["one", "two"]]
    roots = roots_of(links + [(1, d) for d in two], ids)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert len(got) == len(rows) + 2 and by_id[None] == {(1, None)}
    for doc in ids:
        assert (len(sets[doc]), roots[doc] if sets[doc] else doc) in by_id[doc], doc
    assert len(links) > 10


def test_substrings(spark):
    rows = corpus() + [(2, "ab" * 300), (5, "x" * 400), (5000, "y" * 99), (5001, "y" * 99)]
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup.repeated_substrings(documents(spark, rows)).collect()}
    seen = set()
    for doc, text in sorted(rows):
        data = (text or "").encode()
        cut = [False] * len(data)
        for k in range(len(data) - 99):
            if data[k:k + 100] in seen:
                cut[k:k + 100] = [True] * 100
            seen.add(data[k:k + 100])
        kept = bytes(b for b, c in zip(data, cut) if not c)
        runs = sum(c and (k == 0 or not cut[k - 1]) for k, c in enumerate(cut))
        assert got[doc] == (len(data), sum(cut), runs, hashlib.sha256(kept).hexdigest()), doc


def test_substrings_of_rows_that_share_an_id(spark):
    rng = random.Random(14)
    text = lambda n: "".join(rng.choices("abcdefgh", k=n))
    shared, own, tail, late = text(150), text(250), text(130), text(140)
    rows = [(1, own), (1, own), (1, own), (None, shared + text(300)), (None, text(40) + shared), (None, text(460)),
            (2, tail + "x"), (2, tail + "y"), (3, own + "z"), (4, late + text(90)), (4, text(60) + late), (None, None)]
    got = substring_dedup.repeated_substrings(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    first = {}
    order = lambda d: -1 if d is None else d
    for d, t in rows:
        for k in range(len(t or "") - 99):
            first[t[k:k + 100]] = min(first.get(t[k:k + 100], (9, 0)), (order(d), k))
    want = []
    for d, t in rows:
        t = t or ""
        cut = {j for k in range(len(t) - 99) if first[t[k:k + 100]] < (order(d), k) for j in range(k, k + 100)}
        kept = "".join(c for j, c in enumerate(t) if j not in cut)
        want.append((order(d), len(t), len(cut), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted((order(r.doc_id), r.n_bytes, r.n_removed, r.kept_sha256) for r in got) == sorted(want)
    assert {w[2] for w in want} == {0, 150, 250, 140}


def test_long_texts_go_in_stretches():
    text = bytes(random.Random(2).choices(b"abc", k=5000))
    import pyarrow as pa
    batch = pa.record_batch([pa.array([1], pa.int64()), pa.array([text], pa.binary())], names=["id", "raw"])
    spans = []
    for ids, data, starts, sizes, offset in substring_dedup.bounded([batch], most=1000):
        _, place, first, last, _ = substring_dedup.anchors(data, starts, sizes)
        spans += [(int(p) + offset, k) for p, f, l in zip(place, first, last) for k in range(f + offset, l + offset + 1)]
    whole = substring_dedup.anchors(np.frombuffer(text, np.uint8), np.array([0]), np.array([5000]))
    assert spans == [(int(p), k) for p, f, l in zip(whole[1], whole[2], whole[3]) for k in range(f, l + 1)]
    assert [k for _, k in spans] == list(range(4901))


@pytest.mark.parametrize("dims", [3, 70])
def test_embeddings(spark, dims):
    rng = np.random.default_rng(4)
    vectors = [rng.normal(size=dims) for _ in range(40)]
    vectors += [v + rng.normal(size=dims) * 0.25 * np.linalg.norm(v) / dims ** 0.5 for v in vectors[:20] for _ in range(3)] + vectors[:5]
    rows = [(7 * i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(vectors)]
    x = np.array([r[1] for r in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    odd = [(9001, None, 0), (9002, [0.0] * dims, 0), (9003, [float("nan")] * dims, 0), (9004, [None] * dims, 0), (9005, [], 0),
           (9006, [float("inf")] * dims, 0), (9007, [1.0] * (dims + 1), 0)]
    got = {r.vec_id: tuple(r)[1:] for r in embedding_dedup.near_duplicates(
        spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")).collect()}
    links = [(7 * i, 7 * j) for i, j in zip(*np.nonzero(near)) if i < j]
    roots = roots_of(links, [r[0] for r in rows])
    for i, (vec, _, _) in enumerate(rows):
        assert got[vec] == (int(near[i].sum()) - 1, roots[vec], roots[vec] == vec)
    assert all(got[o[0]] == (0, o[0], True) for o in odd)


def test_embeddings_that_share_an_id_or_have_none(spark):
    rows = [(1, [1.0, 0.0, 0.0], "x"), (1, [0.0, 1.0, 0.0], "x"), (2, [1.0, 0.01, 0.0], "x"), (3, [0.0, 1.0, 0.01], "x"),
            (None, [0.0, 0.0, 1.0], "x"), (5, [0.0, 0.01, 1.0], "x"), (None, [1.0, 1.0, 1.0], "x"), (2, [1.0, 0.01, 0.0], "x"),
            (None, None, "x"), (8, [-1.0, 0.0, 0.0], "x")]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, vector string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        (1, 2, 1, True), (1, 1, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 1, 1, False), (None, 1, 5, False), (5, 1, 5, True),
        (None, 0, None, False), (None, 0, None, False), (8, 0, 8, True)], key=str)


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 16)) * rng.exponential(size=(300, 16)) ** 3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, scale, error = embedding_dedup.quantised(x)
    off = np.abs((q.astype(float) @ q.T) * scale[:, None] * scale - x @ x.T)
    assert (off <= error[:, None] + (1 + error[:, None]) * error).all()
    i, j = embedding_dedup.possible_pairs(q, scale, error, slice(0, 300), slice(0, 300), 0.9)
    assert set(zip(*np.nonzero(x @ x.T >= 0.9))) <= set(zip(i, j))


def test_mixing(spark):
    rng = random.Random(6)
    sizes = {"a": 4000, "b": 300, "é": 900, "z": 50, None: 700}
    rows, doc = [(0, None, None, "b"), (1, "", None, "z")], 2
    for source, size in sizes.items():
        while size > 0:
            n = min(size, rng.randint(1, 20))
            rows.append((doc, " ".join(["w"] * n), None, source))
            doc, size = doc + 1, size - n
    got = mixing.mix(documents(spark, rows)).collect()
    # rounds of clamping, as the rule says it
    order = ["a", "b", "z", "é", None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            free.discard(s)
    for s in order:
        own = [r for r in got if r.source == s]
        assert own[0].source_size == sizes[s] and own[0].target == pytest.approx(target[s])
        assert abs(sum(r.taken for r in own) - target[s]) <= 20
        assert all(r.taken <= 3 * r.size and r.taken == r.size * r.repeats for r in own)
    again = mixing.mix(documents(spark, rows[::-1])).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_packing(spark):
    rows = [(d, t, None, f"s{d % 7}") for d, t in corpus()] + [(4, "again", None, None), (4, "again", None, None)]
    got = packing.pack(documents(spark, rows), capacity=200, group_rows=40).collect()
    bins = {}
    for r in got:
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    for members in bins.values():
        assert sum(r.n_words for r in members) <= 200
        assert len({r.source for r in members}) == len(members) == len({r.cluster for r in members})
    need = {}
    for d, t, _, _ in rows:
        need[d] = need.get(d, 0) + len(words_of(t))
    have = {}
    for r in got:
        have[r.doc_id] = have.get(r.doc_id, 0) + r.n_words
    assert have == need
    assert all((r.bin_id is None) == (r.n_words == 0) for r in got)


def test_best_fit_takes_the_tightest_compatible_bin():
    bins, rng, plain = packing.OpenBins(100), random.Random(7), []
    for _ in range(400):
        size, source, cluster = rng.randint(1, 60), 1 << rng.randrange(8), 1 << rng.randrange(40)
        fits = [(left, k) for k, (left, s, c) in enumerate(plain) if left >= size and not s & source and not c & cluster]
        number = bins.place(size, source, cluster)
        if fits:
            assert number == min(fits)[1]
            left, s, c = plain[number]
            plain[number] = (left - size, s | source, c | cluster)
        else:
            assert number == len(plain)
            plain.append((100 - size, source, cluster))


def prose(rng, syllables, n):
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def test_language(spark):
    rng = random.Random(8)
    kinds = {"xx": ["ba", "ri", "tok", "um"], "yy": ["sch", "ein", "ge", "lich"], "zz": ["é", "eau", "ois", "que"]}
    rows = [(i, prose(rng, kinds[k], rng.randint(20, 60)), k) for i in range(240) for k in [rng.choice(sorted(kinds))]]
    rows += [(901, None, "xx"), (902, "", None), (903, "12 + 3", "yy"), (904, prose(rng, kinds["yy"], 20000), None), (None, "tok tok", None)]
    got = language_id.language_of(documents(spark, rows)).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert len(held) > 20 and all(r.lang_pred == truth[r.doc_id] for r in held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    odd = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert odd[901] == odd[902] == odd[903] == ("und", 0.0) and odd[904][0] == "yy"
    assert all(0 <= r.score <= 1 for r in got) and len(got) == len(rows)


def test_languages_with_long_rows_only(spark):
    rng = random.Random(9)
    kinds = {"xx": ["ba", "ri", "tok", "um"], "yy": ["sch", "ein", "ge", "lich"], "zz": ["é", "eau", "ois", "que"]}
    rows = [(i, prose(rng, kinds[k], 4000), k) for i in range(30) for k in ["xx", "yy", "zz"][i % 3:i % 3 + 1]]
    rows += [(i, "la li lo lu " * 3000, "ww") for i in range(100, 110)]
    assert all(len(r[1]) > language_id.SAMPLE_BYTES // 8 for r in rows)
    model = language_id.fit(documents(spark, rows))
    assert sorted(model) == ["ww", "xx", "yy", "zz"]
    got = language_id.identify(documents(spark, rows), model).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {r[0]: r[2] for r in rows}
    # copies of one row are drawn together or not at all; the language is learned all the same
    assert all(sorted(language_id.fit(documents(spark, [(k, "same text " * 600, "vv")] * 900), 4800)) == ["vv"] for k in range(4))


def test_suffix_automaton_finds_longest_matches():
    rng = random.Random(9)
    text = rng.choices(range(1, 5), k=300)
    go = language_id.suffix_automaton(text)
    joined = bytes(text)
    for _ in range(200):
        probe = bytes(rng.choices(range(1, 5), k=rng.randint(1, 9)))
        state, read = 0, 0
        while read < len(probe) and probe[read] in go[state]:
            state, read = go[state][probe[read]], read + 1
        assert probe[:read] in joined and (read == len(probe) or probe[:read + 1] not in joined)


def test_toxicity(spark):
    rng = random.Random(10)
    rows, labels = [], []
    for i in range(600):
        words, toxic = prose(rng, ["an", "er", "on", "the", "re"], rng.randint(20, 80)).split(), i % 5 == 0
        for _ in range(3 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["vilest***", "VILER", "rotten"])
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(toxic)))
    rows += [(901, None), (902, ""), (903, "word " * 30000), (None, "viler")]
    table = spark.createDataFrame(labels + [(5, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(documents(spark, rows), table).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    none = toxicity.toxicity(documents(spark, rows[:9]), table.where("toxic = 0")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}


def test_clean_texts_of_any_length_score_alike(spark):
    rng = random.Random(12)
    syllables = ["an", "er", "on", "the", "re", "in", "ou", "st"]
    rows, labels = [], []
    for i in range(800):
        toxic = i % 8 == 0
        words = prose(rng, syllables, rng.choice([30, 100, 300, 1500])).split()
        for _ in range(len(words) // 40 + 1 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["vilest", "viler", "rotten", "foul", "crass"])
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(toxic)))
    got = toxicity.toxicity(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    clean = [(len(rows[r.doc_id][1].split()), r.score) for r in got if r.held_out and r.doc_id % 8]
    by_length = {n: [s for k, s in clean if k == n] for n in (30, 100, 300, 1500)}
    assert all(len(s) > 10 and max(s) < 0.5 and sum(s) / len(s) < 0.1 for s in by_length.values())
    toxic = [r.predicted for r in got if r.held_out and r.doc_id % 8 == 0]
    assert sum(toxic) >= 0.9 * len(toxic)


def kneser_ney(texts, toxic):
    """log P(word | before, class) of plain Kneser-Ney bigrams over distinct texts, lower order shared by the classes."""
    pairs = [{}, {}]
    for text, label in {(t, c) for t, c in zip(texts, toxic)}:
        words = toxicity.words_of(text.encode())
        for pair in set(zip([b"", *words], words)):
            pairs[label][pair] = pairs[label].get(pair, 0) + 1
    before = [{w: sum(x[1] == w for x in p) for w in {x[1] for x in p}} for p in pairs]
    known = {w: tuple(b.get(w, 0) for b in before) for w in {*before[0], *before[1]}}
    assert all(sum(k) >= toxicity.RARE for k in known.values())
    total = [sum(k[c] for k in known.values()) for c in (0, 1)]
    kinds = [sum(k[c] > 0 for k in known.values()) for c in (0, 1)]

    def p(h, w, c):
        k = known[w]
        shared = (sum(k) + 1) / (sum(total) + len(known) + 1)
        lower = (max(k[c] - 0.75, 0) + (0.75 * kinds[c] + 1) * shared) / (total[c] + 1)
        seen = [n for x, n in pairs[c].items() if x[0] == h]
        if any(sum(n for x, n in pairs[d].items() if x[0] == h) < 20 for d in (0, 1)):
            return lower
        return max(pairs[c].get((h, w), 0) - 0.75, 0) / sum(seen) + 0.75 * len(seen) / sum(seen) * lower
    return lambda h, w: np.log(p(h, w, 1) / p(h, w, 0)), [x for x in {*pairs[0], *pairs[1]}
                                                           if sum(q.get(x, 0) for q in pairs) >= toxicity.PAIR_COUNT]


def test_ratios_are_those_of_plain_kneser_ney(spark):
    rng = random.Random(13)
    texts = [" ".join(rng.choices(["aa", "bb", "cc", "dd", "ee", "ff"], k=6)) + (" gg" if k % 3 == 0 else "") for k in range(150)]
    labels = [int(k % 3 == 0) for k in range(150)]
    sample = spark.createDataFrame([(c, bytearray(t.encode())) for t, c in zip(texts, labels)], "toxic int, raw binary")
    ratios, (plain, pairs) = toxicity.fit_ratios(sample), kneser_ney(texts, labels)
    assert len(pairs) > 20
    for h, w in pairs:
        got = ratios.of([h, w])[1] if h else ratios.of([w])[0]
        assert got == pytest.approx(plain(h, w))


def test_scores(spark):
    rows = corpus()
    got = {r.doc_id: r for r in lm_scoring.score_documents(documents(spark, rows)).collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    tokens = {d: [*words_of(t), None] for d, t in rows}
    counts = {}
    for d, ts in tokens.items():
        for t in ts if not held[d] else ():
            counts[t] = counts.get(t, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    for d, ts in tokens.items():
        base = sum(np.log10((counts.get(t, 0) + 1) / (total + distinct + 1)) for t in ts)
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ts), sum(t in counts for t in ts), total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert sum(r.score for r in got.values() if not r.held_out) > sum(r.base_score for r in got.values() if not r.held_out)


def interpolated(tokens, held):
    """log10 probabilities of each document under an interpolated trigram model of the others, by plain counting."""
    counts, after = {}, {}
    for d, ts in tokens.items():
        for i, t in enumerate(ts if not held[d] else ()):
            for context in [(), (None if i == 0 else ts[i - 1],), *([(None if i == 1 else ts[i - 2], ts[i - 1])] if i else [])]:
                counts[context, t] = counts.get((context, t), 0) + 1
                after.setdefault(context, set()).add(t)
    total = {c: sum(counts[c, t] for t in ts) for c, ts in after.items()}
    out = {}
    for d, ts in tokens.items():
        out[d] = 0.0
        for i, t in enumerate(ts):
            p = (counts.get(((), t), 0) + 1) / (total[()] + len(after[()]) + 1)
            for context in [(None if i == 0 else ts[i - 1],), *([(None if i == 1 else ts[i - 2], ts[i - 1])] if i else [])]:
                if context in total:
                    p = (max(counts.get((context, t), 0) - 0.75, 0) + 0.75 * len(after[context]) * p) / total[context]
            out[d] += np.log10(p)
    return out


@pytest.mark.parametrize("filler", [0, 1_300_000])
def test_rare_ngrams_count_at_any_size(spark, filler):
    rows = [r for r in corpus(5) if r[0]] + [(5000 + k, "seldom seen words " + "and more " * (k % 3)) for k in range(14)]
    rows += [(6000, "x y " * (filler // 2))]
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    assert not held[6000]
    want = interpolated({d: [*words_of(t), None] for d, t in rows}, held)
    got = {r.doc_id: (r.score, r.n_tokens) for r in lm_scoring.score_documents(documents(spark, rows)).collect()}
    assert got.keys() == want.keys()
    for d, (score, tokens) in got.items():
        assert score == pytest.approx(want[d], rel=1e-9, abs=tokens * np.log10(2) / 2048)  # the quantisation's bound


def test_splits_and_names_change_no_score(spark, monkeypatch):
    docs = documents(spark, corpus(5))
    score = lambda: {r.doc_id: (r.n_known, r.base_score, r.score) for r in lm_scoring.score_documents(docs).collect()}
    want = score()
    monkeypatch.setattr(lm_scoring, "common_words", lambda sample: np.zeros(0, np.uint64))
    assert score() == want
    monkeypatch.setattr(lm_scoring, "frequent", lambda sample, levels, buckets: [
        (keys, np.full(len(keys), 3)) for keys in (lm_scoring.tally(sample, level)[0][::2] for level in range(levels))])
    for d, (known, base, total) in score().items():
        assert (known, base) == want[d][:2] and total == pytest.approx(want[d][2], rel=1e-3)


@pytest.mark.parametrize("universe,length", [(50, 40), (10 ** 9, 1000), (1 << 40, 5), (7, 0)])
def test_elias_fano(universe, length):
    rng = np.random.default_rng(12)
    values = np.sort(rng.integers(0, universe, length)).astype(np.uint64)
    packed = lm_scoring.EliasFano(values, universe)
    keys = np.concatenate([values, rng.integers(0, universe, 200).astype(np.uint64)])
    at, same = packed.successor(keys)
    assert (at == np.searchsorted(values, keys)).all() and (same == np.isin(keys, values)).all()
    assert (packed.get(np.arange(length)) == values).all()
    start, stop = length // 4, length // 2
    at, same = packed.successor(keys, start, stop)
    assert (at == start + np.searchsorted(values[start:stop], keys)).all() and (same == np.isin(keys, values[start:stop])).all()


@pytest.mark.parametrize("most", [0, 5, 1 << 30, (1 << 64) - 1])
@pytest.mark.parametrize("length", [0, 1, 3000])
def test_keys_are_grouped_as_by_unique(most, length):
    keys = np.random.default_rng(most % 97 + length).integers(0, most, length, np.uint64, endpoint=True)
    for given in (keys, np.sort(keys)):
        found, one, number = lm_scoring.grouped(given, most)
        want, numbers = np.unique(given, return_inverse=True)
        assert np.array_equal(found, want) and np.array_equal(number, numbers) and np.array_equal(given[one], want)


def test_tables_of_places_are_made_once():
    assert lm_scoring.places(0) is lm_scoring.places(0) and lm_scoring.places(1) is lm_scoring.places(1)


def test_bits_are_packed_at_every_width():
    rng = np.random.default_rng(1)
    for width in range(64):
        for length in (0, 1, 2, 63, 64, 65, 1000):
            values = rng.integers(0, 1 << width, length, np.uint64)
            assert np.array_equal(lm_scoring.unpack_bits(lm_scoring.pack_bits(values, width), width, np.arange(length)), values)


def test_trie_pointers_bound_each_context():
    rng = np.random.default_rng(3)
    contexts, words = rng.integers(0, 40, 900).astype(np.uint64), rng.integers(0, 30, 900).astype(np.uint64)
    times = rng.integers(1, 9, 900)
    trie = lm_scoring.Trie(contexts, words, times)
    asked, held = np.arange(50, dtype=np.uint64), np.full(50, 30)
    codes, totals, followers = trie.look_up(asked, held, np.tile(np.arange(30, dtype=np.uint64), 50))
    for c in range(50):
        mine = {w: times[(contexts == c) & (words == w)].sum() for w in set(words[contexts == c].tolist())}
        assert (totals[c], followers[c]) == (sum(mine.values()), len(mine))
        for w, p in enumerate(lm_scoring.probabilities(codes[c * 30:c * 30 + 30])):
            assert p == (pytest.approx((mine[w] - 0.75) / totals[c], rel=4e-4) if w in mine else 0)


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a = "</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice">We use cookies on this page</div>
{body}
<div id=sidebar><p>Popular now</p></div><div class="comments"><p>A reader's remark that is rather long and has many words in it</p></div>
<form><label>Name</label><input><button>Send</button></form><footer>&copy; 2026</footer></body></html>"""


@pytest.mark.parametrize("body,want", [
    ("<article><h1>A &amp; B</h1><p><b>One\n two<br>three<p>Four &#233;<ul><li>x<li>y</ul></article>", "A & B\nOne two three\nFour é\nx\ny"),
    ("<div class=post><h2>T</h2><div><p>Some text here, long enough.</p><p>More of it, as long.</p></div></div>",
     "T\nSome text here, long enough.\nMore of it, as long."),
    ("<main><article><p>Only.</p><!-- no <p>comment --><div class=ad>Buy</div></article></main>", "Only."),
    ("<article></article>", ""),
])
def test_html(body, want):
    assert html_text.main_text(PAGE.format(body=body)) == want


@pytest.mark.parametrize("opening", ["<div id=content class='post with-sidebar'>", "<div class='wrapper no-sidebar'>", "<div class=hasSidebar>"])
def test_html_layout_names_and_headings_stay(opening):
    body = opening + "<h2 id='related-work'>Related work</h2><p>Some text here, long enough.</p><h2 id='search'>Search</h2><p>More of it, as long.</p></div>"
    assert html_text.main_text(PAGE.format(body=body)) == "Related work\nSome text here, long enough.\nSearch\nMore of it, as long."


STORY = "<h1>Head</h1><p>Some text here, long enough.</p><p>More of it, as long.</p>"
TOLD = "Head\nSome text here, long enough.\nMore of it, as long."


@pytest.mark.parametrize("body,want", [
    (f"<div class='market-share-report'>{STORY}</div>", TOLD),
    (f"<div class='search-result-page'>{STORY}</div>", TOLD),
    (f"<div class='post-header-ad-free'>{STORY}</div>", TOLD),
    (f"<div class=market-share><div class=search-page>{STORY}<div class=ad>Buy</div></div></div>", TOLD),
    (f"<article>{STORY}<section id='discussion'><p>Said.</p></section></article>", TOLD + "\nSaid."),
    (f"<article>{STORY}<p title='a hidden gem'>Gem.</p><p hidden>No.</p><p style='display: none'>No.</p></article>", TOLD + "\nGem."),
    (f"<article>{STORY}<p><label>Lab</label>el.</p></article>", TOLD + "\nLabel."),
    (f"<main><article>{STORY}</article><article><p>Second one.</p></article></main>", TOLD + "\nSecond one."),
    (f"<form action=x><input type=hidden><div>{STORY}</div></form>", TOLD),
    (f"<form action=x><input type=hidden><article>{STORY}</article><input type=submit></form>", TOLD),
    (f"<article>{STORY}<div class=comments>{STORY * 9}</div></article>", TOLD),
    (f"<article>{STORY}</article><section class=comments><article>{STORY * 9}</article></section>", TOLD),
])
def test_html_names_count_against_the_page(body, want):
    assert html_text.main_text(PAGE.format(body=body)) == want


def test_html_of_one_form():
    page = f"<html><body><form id=whole><nav>Menu</nav><div>{STORY}</div><input type=hidden><footer>f</footer></form></body></html>"
    assert html_text.main_text(page) == TOLD


@pytest.mark.parametrize("page", ["<b>{n}<p>x", "<div class=ad>{n}x", "<li>", "</b>", "<!--", "<p title='", "<div hidden><p>t</p>"])
def test_html_time_grows_with_length(page):
    def seconds(n):
        parts = page.split("{n}")
        start = time.perf_counter()
        html_text.main_text(parts[0] * n + "".join(parts[1:]) * n)
        return time.perf_counter() - start
    assert seconds(16000) < 12 * max(seconds(4000), 0.05)


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "plain < text", "x"), (3, "u", "<p>" * 3000 + "deep", "x"),
                                   (4, "u", "<p>é " * 50000, "x")], "page_id long, url string, html string, text string")
    got = sorted((r.page_id, r.url, r.text[:12], r.n_chars) for r in html_text.extract(pages).collect() if r.page_id < 4)
    assert got == [(1, "u", "", 0), (2, None, "", 0), (3, "u", "deep", 4), (3, "u", "plain < text", 12)] or got[0] == (1, "u", "", 0)
    assert html_text.extract(pages).where("page_id = 4").first().n_chars == 50000 * 2 - 1


def test_empty_tables(spark):
    docs = documents(spark, [(1, "a")]).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for result in (exact_dedup.exact_duplicates(docs), jaccard_join.near_duplicates(docs), substring_dedup.repeated_substrings(docs),
                   mixing.mix(docs), packing.pack(docs), language_id.language_of(docs), toxicity.toxicity(docs, labels),
                   lm_scoring.score_documents(docs),
                   embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")),
                   html_text.extract(spark.createDataFrame([], "page_id long, url string, html string"))):
        assert result.count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_replies_come_back_whole(seed):
    rng = np.random.default_rng(seed)
    held = rng.integers(1, 5, 200)
    totals = rng.integers(0, 4, 200)
    total = np.repeat(totals, held)
    codes = np.where(total == 1, rng.integers(0, 2, len(total)) * int(lm_scoring.ONLY), np.where(total > 1, rng.integers(0, 9000, len(total)), 0))
    followers = np.where(totals > 1, rng.integers(1, 4, 200), totals)
    for cut in (200, 1, 0):
        pairs = held[:cut].sum()
        got = lm_scoring.heard(*lm_scoring.told(codes[:pairs], totals[:cut], followers[:cut], held[:cut]), held[:cut])
        assert [x.tolist() for x in got] == [codes[:pairs].tolist(), totals[:cut].tolist(), followers[:cut].tolist()]


@pytest.mark.parametrize("named, most", [(0, 1 << 21), (40, 3), (10_000, 1 << 21)])
def test_distinct_training_words_are_counted_once(monkeypatch, named, most):
    monkeypatch.setattr(lm_scoring, "MOST_KEPT", most)
    rows = [(i, i % 7 != 2, (t or "").encode()) for i, t in corpus()]
    words = [(taught, w) for _, taught, raw in rows for w in [*words_of(raw.decode()), None]]
    hashes = lm_scoring.WordHashes()
    common = np.array(sorted({lm_scoring.END if w is None else np.uint64(hashes[w.encode()]) for _, w in words}), np.uint64)[::-1][:named]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[k::3])], names=["id", "taught", "raw"]) for k in range(3)]
    monkeypatch.setattr(lm_scoring.TaskContext, "get", classmethod(lambda cls: type("Task", (), {"partitionId": lambda self: 0})()))
    cut = list(lm_scoring.numbered(batches, common))
    sent = [pa.Table.from_batches(list(lm_scoring.taught_words([b.select(["flags", "sizes", "words", "tokens"])], common, 5))) for b in cut]
    table = pa.concat_tables(sent)
    counts = [lm_scoring.counted(table.filter(pa.compute.equal(table["part"], part)))["n"][0].as_py()
              for part in set(table["part"].to_pylist())]
    assert sum(counts) == len({w for taught, w in words if taught})
    for batch in cut:
        part = lm_scoring.Slice(*(batch.column(c)[0].as_py() for c in ("sizes", "words", "tokens")), common)
        assert (part.names < lm_scoring.OTHER).sum() == np.isin(part.words, common).sum()
    tokens = [lm_scoring.Slice(*(b.column(c)[0].as_py() for c in ("sizes", "words", "tokens")), common) for b in cut]
    for k, part in enumerate(tokens):
        want, _ = lm_scoring.tokens_of([r[2] for r in rows[k::3]], hashes)
        assert part.words[part.tokens].tolist() == want.tolist()
