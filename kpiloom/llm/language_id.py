"""Language of a text by cross-parsing against labelled text.

A suffix automaton per language holds every substring of a bounded labelled sample. A
text is parsed from left to right into phrases, each the longest match in the sample;
the language whose sample needs the fewest phrases, each weighed by the bits of a
position in the sample, is the answer (cross-parsing entropy in bits per byte).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, share

#: Bytes of labelled text per language that the automata hold; longer rows than an eighth of it are drawn in blocks.
SAMPLE_BYTES = 48 << 10
#: Bytes of one parsing block. A long text is parsed in blocks, each starting a phrase.
BLOCK = 256
#: Blocks parsed side by side.
LANES = 32768

#: Byte -> symbol: 0 ends a block, 1 is anything but a letter, letters of any script keep their bytes.
SYMBOL_OF = np.ones(256, np.uint8)
SYMBOL_OF[97:123] = np.arange(2, 28)
SYMBOL_OF[65:91] = np.arange(2, 28)
SYMBOL_OF[128:256] = np.arange(28, 156)
SYMBOL_OF[0] = 0
N_SYMBOLS = 156


def symbols(raw: bytes) -> np.ndarray:
    """Letters of a text as symbols; runs of other bytes are one."""
    s = SYMBOL_OF[np.frombuffer(raw.replace(b"\0", b" "), np.uint8)]
    return s[np.concatenate([[True], (s[1:] != 1) | (s[:-1] != 1)])] if len(s) else s


def suffix_automaton(text) -> list[dict[int, int]]:
    """Transitions of the minimal automaton of all substrings of ``text``; state 0 is the start."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in text:
        now = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = now
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                clone = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
                link[q] = link[now] = clone
        last = now
    return go


def fit(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> dict[str, tuple]:
    """Automata of labelled ``docs`` (doc_id, text, lang): language -> (edges, bits of a position).

    Blocks of at most an eighth of ``sample_bytes`` (a short row is one block) are taken by
    their hash until a language has ``sample_bytes``; the draw's rate comes from each
    language's total, so that a few times that much reaches the driver whatever the input.
    A language of which nothing is drawn gives the block of the least hash.
    """
    most = sample_bytes // 8
    usable = docs.where("lang is not null").select("doc_id", "lang", F.col("text").cast("binary").alias("raw")).where(
        F.length("raw") > 0)
    total = {r[0]: r[1] for r in usable.groupBy("lang").agg(F.sum(F.length("raw").cast("long"))).collect()}
    if not total:
        return {}
    rate = F.create_map(*[x for k, v in total.items() for x in (F.lit(k), F.lit(min(1.0, 3 * sample_bytes / v)))])
    usable = usable.select("lang", "raw", F.xxhash64("doc_id", "raw").alias("place"), rate[F.col("lang")].alias("rate"))
    blocks = F.filter(F.sequence(F.lit(0), ((F.length("raw") - 1) / most).cast("int")),
                      lambda k: share(F.xxhash64("place", k), 6) < F.col("rate"))
    cut = F.transform(blocks, lambda k: F.struct(F.xxhash64("place", k).alias("place"),
                                                 F.substring(F.col("raw"), k * most + 1, F.lit(most)).alias("raw")))
    drawn = usable.select("lang", F.explode(cut).alias("block")).select("lang", "block.*").collect()
    missing = sorted(set(total) - {r["lang"] for r in drawn})
    if missing:
        first = F.struct("place", F.substring("raw", 1, most).alias("raw"))
        drawn += usable.where(F.col("lang").isin(missing)).groupBy("lang").agg(F.min(first).alias("block")).select(
            "lang", "block.*").collect()
    texts: dict[str, list[bytes]] = {k: [] for k in sorted(total)}
    for row in sorted(drawn, key=lambda r: (r["place"], bytes(r["raw"]))):
        if sum(map(len, texts[row["lang"]])) < sample_bytes:
            texts[row["lang"]].append(bytes(row["raw"]))
    model = {}
    for lang, parts in texts.items():
        if parts:
            text = symbols(b"\n".join(parts)).tolist()
            go = suffix_automaton(text)
            edges = np.array([(s, c, t) for s, step in enumerate(go) for c, t in step.items()], np.int32)
            model[lang] = (len(go), edges, float(np.log2(len(text) + 2)))
    return model


def step_table(states: int, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Dense steps over the symbols that occur: row-major next state, -1-next where a phrase ends first."""
    used = np.unique(edges[:, 1])
    column = np.zeros(N_SYMBOLS, np.int32)
    column[used] = np.arange(1, len(used) + 1)
    width = len(used) + 1
    steps = np.full((states, width), -1, np.int32)
    steps[edges[:, 0], column[edges[:, 1]]] = edges[:, 2] * width
    start = np.maximum(steps[0], 0)
    ends = steps < 0
    steps[ends] = (-1 - np.broadcast_to(start, steps.shape))[ends]
    steps[0, 0] = 0
    return steps.ravel(), column, width


def phrases(blocks: np.ndarray, table) -> np.ndarray:
    """Phrases of each block: ``blocks`` has one block per column, ended by symbol 0."""
    steps, column, _ = table
    state = np.zeros(blocks.shape[1], np.int32)
    ended = np.ones(blocks.shape[1], np.int32)
    for here in blocks:
        state += column[here]
        state = steps.take(state)
        cut = state < 0
        state = np.where(cut, -1 - state, state)
        cut &= here > 0
        ended += cut
    return ended


def parsed(batches, model, text_at: int | None = None):
    """Languages of batches of ids, whether there is a letter, and texts or, with ``text_at``, rows that hold theirs there."""
    tables = {lang: (step_table(states, edges), bits) for lang, (states, edges, bits) in model.items()}
    langs = sorted(tables)
    for batch in batches:
        ids, lettered, raws = batch.columns
        carried = [] if text_at is None else [raws]
        raws = raws if text_at is None else raws.field(text_at).cast(pa.binary())
        lettered = lettered.to_pylist()
        best, score = ["und"] * len(raws), np.zeros(len(raws))
        at = 0
        while at < len(raws):
            rows, parts, counts = [], [], []
            held = 0
            while at < len(raws) and held < LANES:
                if lettered[at] and langs:
                    s = symbols(raws[at].as_py())
                    n = -(-len(s) // BLOCK)
                    rows.append(at)
                    parts.append(np.pad(s, (0, n * BLOCK - len(s))))
                    counts.append(n)
                    held += n
                at += 1
            if not rows:
                continue
            blocks = np.ascontiguousarray(np.concatenate(parts).reshape(-1, BLOCK).T)
            firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            bits = np.stack([np.add.reduceat(phrases(blocks, tables[k][0]), firsts) * tables[k][1] for k in langs])
            low = np.argmin(bits, axis=0)
            least = bits[low, np.arange(len(rows))]
            rest = bits.copy()
            rest[low, np.arange(len(rows))] = np.inf
            second = rest.min(axis=0) if len(langs) > 1 else np.full(len(rows), np.inf)
            sure = np.where(np.isinf(second), 1.0, second / (least + np.where(np.isinf(second), 0, second)))
            for k, row in enumerate(rows):
                best[row] = langs[low[k]]
                score[row] = sure[k]
        yield pa.RecordBatch.from_arrays([ids, pa.array(best, pa.string()), pa.array(score), *carried],
                                         names=["doc_id", "lang_pred", "score", "row"][:3 + len(carried)])


def identify(docs: DataFrame, model: dict[str, tuple], carry: bool = False) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs`` (doc_id, text), with ``carry`` also the row as a struct.

    ``und`` with score 0 where the text is null, has no letter, or nothing was learned.
    The score is the second language's entropy over the sum of the best two: 0.5 is a
    draw. A tie goes to the first language by name.
    """
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if not carry:
        asked = docs.select("doc_id", letters.alias("lettered"), F.col("text").cast("binary").alias("raw"))
        return asked.mapInArrow(lambda batches: parsed(batches, model), "doc_id long, lang_pred string, score double")
    asked = docs.select("doc_id", letters.alias("lettered"), F.struct("*").alias("row"))
    text_at = [c.lower() for c in docs.columns].index("text")
    return asked.mapInArrow(lambda batches: parsed(batches, model, text_at),
                            f"doc_id long, lang_pred string, score double, row {asked.schema['row'].dataType.simpleString()}")


def language_of(docs: DataFrame, folds: int = 5, sample_bytes: int = SAMPLE_BYTES, carry: bool = False) -> DataFrame:
    """Fit on the rows of ``docs`` outside fold 0 and label every row.

    Returns doc_id, held_out, lang_pred, score, one row per row; ``carry`` adds the row as a
    struct. Rows without a language teach nothing; an empty table gives an empty result.
    """
    model = fit(docs.where(fold("doc_id", folds) != 0), sample_bytes)
    return identify(docs, model, carry).select("doc_id", (fold("doc_id", folds) == 0).alias("held_out"), "lang_pred", "score",
                                               *(["row"] if carry else []))
