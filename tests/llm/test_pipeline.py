"""The pipeline's stages against plain Python, each on what its predecessor kept."""

import re

import corpus_pipeline
from kpiloom.llm.common import stored
from llm_helpers import DOCS, corpus, roots_of, words_of

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows, tmp_path):
    full = [(d, t, "xx" if d % 2 else "yy", f"s{d % 5}" if d % 11 else None, len(t or "")) for d, t in rows]
    spark.createDataFrame(full, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    return full


def near_rows(rows):
    sets = {}
    for row in rows:
        w = words_of(row[1])
        sets[row[0]] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    roots = roots_of(links, ids)
    return [r for r in rows if roots[r[0]] == r[0]]


def test_stages(spark, tmp_path):
    rows = table(spark, corpus() + [(997, "12 34"), (998, "one  two")], tmp_path)
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, str(tmp_path)), f"test-{name}")
        kept[name] = [tuple(r) for r in docs.collect()]
        if name != "packing":
            assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]

    lettered = [r for r in rows if re.search(r"[^\W\d_]", r[1] or "")]
    assert sorted(kept["language_id"]) == sorted(lettered)

    groups = {}
    for r in lettered:
        groups.setdefault(re.sub(r"\s", "", r[1]), []).append(r)
    exact = [min(g, key=lambda r: (-len(r[1]), r[0])) for g in groups.values()]
    assert sorted(kept["exact_dedup"]) == sorted(exact)

    near = near_rows(exact)
    assert sorted(kept["near_dedup"]) == sorted(near) and len(near) < len(exact)

    mixed = kept["mixing"]
    assert set(mixed) <= set(near) and max(mixed.count(r) for r in near) <= 3
    words = lambda rows_: sum(len(words_of(r[1])) for r in rows_)
    most = max(len(words_of(r[1])) for r in near)
    sources = sorted({r[3] for r in near if r[3]}) + [None]
    level = words(near) / sum(k % 3 + 1 for k in range(len(sources)))
    assert abs(words(mixed) - words(near)) <= most * len(sources)
    for k, source in enumerate(sources):
        own, took = words([r for r in near if r[3] == source]), words([r for r in mixed if r[3] == source])
        assert took <= 3 * own and (took >= min(3 * own, level * (k % 3 + 1)) - most)

    bins = {}
    for doc, _, _, n, bin_id, source, cluster in kept["packing"]:
        bins.setdefault(bin_id, []).append((n, source, cluster))
    assert all(sum(n for n, _, _ in b) <= 2048 and len({s for _, s, _ in b}) == len(b) == len({c for _, _, c in b})
               for k, b in bins.items() if k is not None)
    assert sum(n for b in bins.values() for n, _, _ in b) == words(mixed)


def test_run_is_the_stages_in_turn(spark, tmp_path):
    table(spark, corpus(n=12), tmp_path)
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "piece", "start", "n_words", "bin_id", "source", "cluster"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert DOCS


def test_rows_that_repeat_an_id(spark):
    rows = [(1, "aa bb", "x", "s", 5), (1, "aa bb", "x", "s", 5), (1, "aa  bb", "x", "s", 6), (2, "cc", "x", "s", 2), (None, "cc dd", "x", "s", 5)]
    got = corpus_pipeline.exact(spark, spark.createDataFrame(rows, COLUMNS), "")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted([rows[2], rows[3], rows[4]], key=repr)


def test_rows_are_judged_by_themselves(spark, tmp_path):
    text = "one clean text of more than five words that nobody else has"
    near = text + " but for these few"
    rows = [(0, "bbb  ", None, "s", 5), (1, "bbb", None, "s", 3), (1, text, None, "s", 50), (None, "ccc", None, "s", 3), (None, "ccc", None, "s", 3),
            (None, " ccc", None, "s", 4), (None, "ddd", None, "s", 3), (2, "a b c d e f g h i j k l m n o p q r s t u v w x", None, "s", 9),
            (2, "a b c d e f g h i j k l m n o p q r s t u v w y", None, "s", 9), (2, near * 3, None, "s", 9)]
    docs = stored(spark.createDataFrame(rows, COLUMNS).coalesce(1), "odd-ids")
    exact = corpus_pipeline.exact(spark, docs, "")
    assert sorted((tuple(r) for r in exact.collect()), key=repr) == sorted([rows[0], rows[2], *rows[5:]], key=repr)
    left = corpus_pipeline.near(spark, stored(exact.coalesce(1), "odd-exact"), "")
    kept = [tuple(r) for r in left.collect()]
    same = [r for r in kept if r[1].startswith("a b c")]
    assert len(same) == 1 and sorted((r for r in kept if r not in same), key=repr) == sorted([rows[0], rows[2], *rows[5:7], rows[9]], key=repr)


def test_an_empty_table_goes_through(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_language_keeps_texts_without_a_model(spark):
    rows = [(1, "aa bb", None, "s", 5), (2, "12 34", None, "s", 5), (3, None, None, "s", 0)]
    got = corpus_pipeline.language(spark, spark.createDataFrame(rows, COLUMNS), "")
    assert [tuple(r) for r in got.collect()] == rows[:1]
