"""Fingerprints, hard negatives and reversed search against plain Python, with odd rows, ties and empty tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import fingerprints, hard_negatives, reversed_search
from llm_helpers import corpus, documents, words_of


def plain_sketch(text, fraction=0.125):
    w = words_of(text)
    runs = {" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    hashes = {hashlib.md5(r.encode()).hexdigest()[:12] for r in runs}
    low = sorted(h for h in hashes if int(h, 16) < fraction * 16 ** 12)
    return low or sorted(hashes)[:1]


def alike(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_fingerprints(rows):
    rows = [(d, t or "") for d, t in rows]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    out = []
    for (d, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        own, new, other = plain_sketch(text), plain_sketch(edited), plain_sketch(following)
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(own), "".join(new),
                    alike(own, new), alike(own, other),
                    len(set(own) & set(new)) / len(own) if own else 1.0,
                    len(set(own) & set(other)) / len(own) if own else 1.0))
    return out


def by_repr(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("odd", [False, True])
def test_fingerprints(spark, odd):
    rows = corpus() + [(2000, "𝄞 é 𝄞 x " * 30), (-5, "A B C D E F"), (2 ** 63 - 1, "last word of all"), (-2 ** 63, "first")]
    if odd:  # repeated rows, ids and null ids
        rows += [(4, "again and again"), (4, "again and again"), (4, "again and again"), (4, "but not this"), (None, "no id"),
                 (None, "no id"), (None, None), (None, ""), (None, "other")]
    got = fingerprints.fingerprints(documents(spark, rows).repartition(5)).collect()
    assert by_repr(got) == by_repr(plain_fingerprints(rows))


@pytest.mark.parametrize("rows", [[(3, "only one document here it is")], [(3, None)], [(1, "x"), (1, "x")]])
def test_fingerprints_of_tiny_tables(spark, rows):
    assert by_repr(fingerprints.fingerprints(documents(spark, rows)).collect()) == by_repr(plain_fingerprints(rows))


def test_many_equal_rows_are_expanded_in_steps(spark):
    rows = [(5, "copy of a row that comes often")] * (2 * fingerprints.CHUNK + 3) + [(4, "the other one")]
    got = fingerprints.fingerprints(documents(spark, rows))
    assert got.count() == len(rows)
    assert got.where("doc_id = 5 and near_next = 1").count() == len(rows) - 2


def test_succession_leads_through_all_partitions(spark):
    ids = random.Random(2).sample(range(-10 ** 12, 10 ** 12), 3000)
    keys = fingerprints.keyed(documents(spark, [(i, str(i)) for i in ids])).select(
        "z", "o", "h", F.lit(1).alias("n_chars"), F.lit(1).cast("long").alias("copies"))
    got = {~r.o: ~r.to_o for r in fingerprints.successions(keys.repartition(9)).collect()}
    want = sorted(ids, reverse=True)
    assert got == dict(zip(want, want[1:] + want[:1]))


def test_sketches_merge_and_contain(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(4000)]
    long, short = " ".join(words), " ".join(words[1000:1400])
    df = spark.createDataFrame([(long, short, " ".join(words[:2000]), " ".join(words[1996:]))], "a string, b string, c string, d string")
    a, b, c, d = (fingerprints.sketch(F.col(x)) for x in "abcd")
    row = df.select(fingerprints.containment(b, a).alias("inside"), fingerprints.containment(a, b).alias("share"),
                    fingerprints.likeness(a, b).alias("like"), (fingerprints.merged(c, d) == a).alias("union"),
                    (fingerprints.reduced(a, 0.02) == fingerprints.sketch(F.col("a"), fraction=0.02)).alias("coarser"),
                    F.size(a).alias("n")).first()
    assert row.inside == 1.0 and row.union and row.coarser
    assert row.share == pytest.approx(0.1, abs=0.04) and row.like == pytest.approx(0.1, abs=0.04)
    assert 400 < row.n < 600


def test_fingerprints_shuffle_texts_once(spark):
    df = fingerprints.fingerprints(documents(spark, corpus()))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "ReusedExchange" in plan


VECTORS = "vec_id long, embedding array<float>, label int, id long, anchor long, score long, vector string, tile int, rank int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "v", 4, 5) for r in rows], VECTORS)


def plain_negatives(rows, n_positives=5, n_negatives=3):
    seen, out = set(), []
    for i, v, label in rows:
        if label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        seen.add((i, tuple(math.floor(256 * float(np.float32(c))) for c in v), label))
    last = lambda i: (i is None, i or 0)
    for anchor in seen:
        if anchor[0] is None or anchor[0] % 50:
            continue
        others = [(sum(a * b for a, b in zip(anchor[1], o[1])), o) for o in seen if o[0] != anchor[0] and len(o[1]) == len(anchor[1])]
        others.sort(key=lambda r: (-r[0], last(r[1][0])))
        for score, positive in [r for r in others if r[1][2] == anchor[2]][:n_positives]:
            found = [r for r in others if r[1][2] != anchor[2] and 50 * score <= 100 * r[0] <= 95 * score][:n_negatives]
            out += [(anchor[0], positive[0], k + 1, o[0], score, s) for k, (s, o) in enumerate(found)]
    return out


@pytest.mark.parametrize("dim, scale", [(3, 1.0), (70, 0.3), (200, 900.0)])
def test_hard_negatives(spark, dim, scale, monkeypatch):
    rng = np.random.default_rng(dim)
    centre = rng.normal(size=(4, dim))
    rows = []
    for k in range(700):
        label = int(rng.integers(0, 4))
        v = centre[label] * 0.6 + rng.normal(size=dim)
        rows.append((k - 100, [float(np.float32(c)) for c in v * scale], label))
    rows += [(900 + k, rows[k][1], rows[k + 1][2]) for k in range(80)]  # ties
    rows += [rows[100], rows[100], (rows[100][0], rows[7][1], 3), (None, rows[9][1], 1), (None, None, 1), (5000, rows[5][1], None),
             (5050, [float("nan")] * dim, 1), (5100, [float("inf")] + [0.0] * (dim - 1), 1), (5150, [None] + [1.0] * (dim - 1), 1),
             (5200, [], 1), (5201, [], 1), (5202, [], 2), (5250, [0.0] * dim, 2), (5300, [1.0], 2), (5301, [0.9], 3), (5302, [2.0], 2)]
    monkeypatch.setattr(hard_negatives, "SLAB", 3)
    monkeypatch.setattr(hard_negatives, "ROW_TILE", 50)
    got = hard_negatives.hard_negatives(vectors(spark, rows)).collect()
    assert by_repr(got) == by_repr(plain_negatives(rows))


def test_vectors_beyond_64_bit_scores_take_no_part(spark):
    rows = [(50, [1.0, 1.0], 1), (51, [1.0, 0.9], 1), (52, [0.9, 0.6], 2), (53, [1e30, 1.0], 2), (100, [3e6, 3e6], 1)]
    assert [tuple(r) for r in hard_negatives.hard_negatives(vectors(spark, rows)).collect()] == plain_negatives(rows[:3])


@pytest.mark.parametrize("most", [100, 10 ** 6, 2 ** 40, 2 ** 55])
def test_residues_give_exact_products(most):
    rng, dim = np.random.default_rng(1), 150
    side = int((most / dim) ** 0.5)
    a, b = (rng.integers(-side, side + 1, size=(20, dim)) for _ in "ab")
    primes = hard_negatives.moduli(most)
    parts = [hard_negatives.product_modulo(hard_negatives.residues(a, p), hard_negatives.residues(b, p), p) for p in primes]
    assert (hard_negatives.reconstructed(parts, primes) == a @ b.T).all()


TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(rows, items, n=20):
    counts = [(d, Counter(plain_terms(t))) for d, t in rows]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    docs, total = len(counts), sum(size for _, _, size in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in set(items):
        found = []
        for d, c, size in counts:
            m = 75 + 25 * size * docs // total
            score = sum(math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in plain_terms(text) if c[t])
            if score > 0:
                found.append((-score, d is None, d or 0, d, score))
        out += [(item, k + 1, d, score) for k, (*_, d, score) in enumerate(sorted(found, key=lambda r: r[:3])[:n])]
    return out


def items_of(spark, items):
    return spark.createDataFrame([(*i, 1, "t", 2, 3) for i in items], "item_id long, text string, doc_id long, term string, n long, score long")


SEARCHED = [(5000 + k, t) for k, t in enumerate(["É_é ÀB9 x", "x x x x x", "é-é", "\x00a\x7fb", "zz zz", "_-_ !"])]
ASKED = [(1, "a b c é"), (2, "X x"), (3, "bad cab éa a a a"), (3, "another of that id x"), (3, "another of that id x"), (4, None), (5, " ?! "),
         (None, "a x"), (7, "zz zz b 9"), (8, "not there")]


@pytest.mark.parametrize("entries", [10 ** 6, 3])
def test_reversed_search(spark, entries, monkeypatch):
    rows = corpus() + SEARCHED + [(5002, "é-é"), (None, "x"), (None, "x y"), (17, "x"), (16, "x")] + [(6000 - k, "b a c") for k in range(40)]
    monkeypatch.setattr(reversed_search, "ENTRIES", 7)
    got = reversed_search.search(documents(spark, rows).repartition(6), items_of(spark, ASKED), index_entries=entries).collect()
    assert by_repr(got) == by_repr(plain_search(rows, ASKED))


def test_heaps_hold_the_best(spark):
    rng = random.Random(4)
    heaps, seen = reversed_search.Heaps(3), defaultdict(list)
    for _ in range(50):
        rows = [(rng.randrange(5), rng.randrange(100), rng.random() < 0.1, rng.randrange(1, 30)) for _ in range(rng.randint(1, 20))]
        for item, doc, null, score in rows:
            seen[item].append((-score, null, doc))
        heaps.add(*(np.array(c) for c in zip(*rows)))
    for item in range(5):
        mine = heaps.item == item
        assert list(zip(-heaps.score[mine], heaps.null[mine], heaps.doc[mine])) == sorted(seen[item])[:3]
        assert heaps.floors(6)[item] == -sorted(seen[item])[2][0] and heaps.floors(6)[5] == 1


def test_empty_inputs(spark):
    none, some = documents(spark, []), documents(spark, [(1, "a")])
    assert fingerprints.fingerprints(none).collect() == []
    assert hard_negatives.hard_negatives(vectors(spark, [])).collect() == []
    assert reversed_search.search(none, items_of(spark, ASKED)).collect() == []
    assert reversed_search.search(documents(spark, [(1, None)]), items_of(spark, ASKED)).collect() == []
    assert reversed_search.search(some, items_of(spark, [])).collect() == []


def test_very_long_texts(spark):
    rng = random.Random(9)
    rows = [(1, " ".join(rng.choice(["a", "b", "c", "é"]) + str(rng.randrange(5000)) for _ in range(60_000))), (2, "a1 a2 a3")]
    assert by_repr(fingerprints.fingerprints(documents(spark, rows)).collect()) == by_repr(plain_fingerprints(rows))
    items = [(1, "a1 b2 c3 é4")]
    assert by_repr(reversed_search.search(documents(spark, rows), items_of(spark, items)).collect()) == by_repr(plain_search(rows, items))


def test_common_hashes_of_a_document_are_counted_once(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f h"), (3, None)]
    found = fingerprints.fingerprints(documents(spark, rows))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect(") == 2  # with the edited text's, with the next text's
    got = {r.doc_id: r for r in found.collect()}
    assert got[3].in_edited == got[3].near_edited == 1.0 and got[3].near_next == 0.0 and got[3].in_next == 1.0
