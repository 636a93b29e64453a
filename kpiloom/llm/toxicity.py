"""Toxicity from class-conditional Kneser-Ney language models.

One bigram model per class, learned from a bounded labelled sample. Lower orders count
continuations: a word's distinct predecessors in its class, backing off to the counts of
both classes together; words that are rare in both are known by their first letters.
Both models' log-likelihoods are compared per word: by their mean over the text, and by the
shares of its words that are likelier in toxic text by so many steps. A logistic fit on
labelled rows that the models have not seen turns these comparisons into a score. None of
them grows with the text's length, as the ratio of its most toxic word or stretch would.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, share, stored

#: Bytes of labelled text per class that the models, and that the logistic fit, learn from, about.
SAMPLE_BYTES = 6 << 20
#: Words with fewer predecessors in both classes are known by this many first bytes.
RARE, STEM = 4, 4
#: Pairs of words that the bigram level keeps.
PAIR_COUNT = 5
DISCOUNT = 0.75
#: Log ratios above which the shares of words are taken, and words by which a short text's shares shrink.
STEPS, SHRINK = (1.0, 2.0, 3.0, 4.0, 6.0), 20
NAMES = ("whole", *(f"above{k}" for k in range(len(STEPS))))
KINDS = ", ".join(f"{name} double" for name in NAMES)


#: Letters of any script in lower case; everything else parts words.
LETTERS = bytes(b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(LETTERS).split()


def pair_counts(batches):
    """Texts per class that hold a pair of neighbouring words; a text begins with an empty word."""
    for batch in batches:
        found = {0: Counter(), 1: Counter()}
        for toxic, raw in zip(*(c.to_pylist() for c in batch.columns)):
            words = words_of(raw)
            found[toxic].update(set(zip([b"", *words], words)))
        rows = [(label, h, w, n) for label, pairs in found.items() for (h, w), n in pairs.items()]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary()),
             pa.array(columns[3], pa.int64())], names=["toxic", "h", "w", "n"])


def stem(word: bytes) -> bytes:
    return b"~" + word[:STEM]


class Ratios:
    """Log ratios of the two class models, ready to look up."""

    def __init__(self, words: dict, pairs: dict, contexts: dict, unseen: float):
        self.words, self.pairs, self.contexts, self.unseen = words, pairs, contexts, unseen

    def of(self, words: list[bytes]) -> np.ndarray:
        known, pairs, contexts, before = self.words, self.pairs, self.contexts, b""
        out = []
        for word in words:
            value = known.get(word)
            if value is None:
                value = known.get(stem(word), self.unseen)
            back = contexts.get(before)
            if back is not None:
                value = pairs.get((before, word), value + back)
            out.append(value)
            before = word
        return np.array(out)


def fit_ratios(sample: DataFrame) -> Ratios:
    """Kneser-Ney models of ``sample`` (toxic, raw) as log ratios."""
    counted = (sample.dropDuplicates(["toxic", "raw"]).mapInArrow(pair_counts, "toxic int, h binary, w binary, n long")
               .groupBy("h", "w").agg(F.sum(F.expr("if(toxic = 0, n, 0)")).alias("n0"),
                                      F.sum(F.expr("if(toxic = 1, n, 0)")).alias("n1")))
    words = counted.groupBy("w").agg(F.count_if(F.col("n0") > 0).alias("k0"), F.count_if(F.col("n1") > 0).alias("k1"))
    follow = {}
    for word, *k in words.collect():
        key = bytes(word) if sum(k) >= RARE else stem(bytes(word))
        old = follow.get(key, (0, 0))
        follow[key] = (old[0] + k[0], old[1] + k[1])
    totals = [max(1, sum(v[c] for v in follow.values())) for c in (0, 1)]
    types = [sum(v[c] > 0 for v in follow.values()) for c in (0, 1)]
    both, vocabulary = sum(totals), len(follow) + 1

    def lower(k, c):
        """P(word | class): discounted continuations, then the classes' common ones, then a uniform share."""
        common = (k[0] + k[1] + 1) / (both + vocabulary)
        return (max(k[c] - DISCOUNT, 0) + (DISCOUNT * types[c] + 1) * common) / (totals[c] + 1)

    ratios = {key: math.log(lower(k, 1) / lower(k, 0)) for key, k in follow.items()}
    unseen = math.log(lower((0, 0), 1) / lower((0, 0), 0))
    seen = counted.groupBy("h").agg(F.sum("n0").alias("m0"), F.sum("n1").alias("m1"),
                                    F.count_if(F.col("n0") > 0).alias("t0"), F.count_if(F.col("n1") > 0).alias("t1"))
    context = {bytes(r[0]): tuple(r[1:]) for r in seen.where("m0 >= 20 and m1 >= 20").collect()}
    back = {h: ((DISCOUNT * t0) / m0, (DISCOUNT * t1) / m1) for h, (m0, m1, t0, t1) in context.items()}
    pairs = {}
    for h, w, *n in counted.where(F.col("n0") + F.col("n1") >= PAIR_COUNT).collect():
        h, w = bytes(h), bytes(w)
        if h in context:
            k = follow.get(w) or follow.get(stem(w), (0, 0))
            p = [max(n[c] - DISCOUNT, 0) / context[h][c] + back[h][c] * lower(k, c) for c in (0, 1)]
            pairs[h, w] = math.log(p[1] / p[0])
    return Ratios(ratios, pairs, {h: math.log(b[1] / b[0]) for h, b in back.items()}, unseen)


def features(ratios: np.ndarray) -> tuple[float, ...]:
    """Mean log ratio per word, and the square roots of the shares of words above each step."""
    if not len(ratios):
        return (0.0,) * len(NAMES)
    shares = [(ratios > step).sum() / (len(ratios) + SHRINK) for step in STEPS]
    return float(ratios.mean()), *(math.sqrt(x) for x in shares)


def measured(batches, model):
    for batch in batches:
        ids, raws = batch.columns
        rows = [features(model.value.of(words_of(r))) for r in raws.to_pylist()]
        columns = list(zip(*rows)) or [[]] * len(NAMES)
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.float64()) for c in columns)],
                                         names=["id", *NAMES])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a lightly penalised logistic regression; the last is the constant."""
    spread = np.maximum(x.std(axis=0), 1e-6)
    centre = x.mean(axis=0)
    z = np.hstack([(x - centre) / spread, np.ones((len(x), 1))])
    beta = np.zeros(z.shape[1])
    penalty = np.diag([0.5] * (len(beta) - 1) + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + penalty,
                               z.T @ (weight * (y - p)) - penalty @ beta)
        beta += np.clip(step, -2, 2)
    return np.append(beta[:-1] / spread, beta[-1] - (beta[:-1] * centre / spread).sum())


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text); ``labels`` (doc_id, toxic) teach outside fold 0.

    Returns doc_id, held_out, score, predicted. A null or empty text has no word to compare
    and gets the score of zero comparisons. Where one class has no labelled row, every score
    is 0 (or 1, if only toxic rows are known). Ids with contradictory labels count as toxic.
    """
    spark = docs.sparkSession
    raw = F.col("text").cast("binary").alias("raw")
    label = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = (docs.where(fold("doc_id", folds) != 0)
             .select("doc_id", F.octet_length("text").alias("size"))
             .where("size > 0").join(label, "doc_id")
             .select("doc_id", "toxic", "size", (share(F.col("doc_id"), 21) < 0.25).alias("checks")))
    sizes = {(r[0], r[1]): r[2] for r in known.groupBy("toxic", "checks").agg(F.sum("size")).collect()}
    have = {toxic for toxic, _ in sizes}
    held = (fold("doc_id", folds) == 0).alias("held_out")
    if have != {0, 1}:
        only = 1.0 if have == {1} else 0.0
        return docs.select("doc_id", held, F.lit(only).alias("score"), F.lit(int(only)).alias("predicted"))
    # where a class is too small to be parted, the fit looks at the models' own rows
    parted = all((c, part) in sizes for c in (0, 1) for part in (False, True))
    whole = {c: sizes.get((c, True), 0) + sizes.get((c, False), 0) for c in (0, 1)}
    rate = {(c, part): min(1.0, sample_bytes / (sizes[c, part] if parted else whole[c]))
            for c in (0, 1) for part in (False, True)}
    limit = F.create_map(*[F.lit(x) for (c, part), r in rate.items() for x in (f"{c}{part}".lower(), r)])
    key = F.concat(F.col("toxic").cast("string"), F.col("checks").cast("string"))
    # the ids of the sample are few by its size in bytes, so no text but the sample's moves
    chosen = known.where(share(F.col("doc_id"), 22) < limit[key]).select("doc_id", "toxic", "checks").distinct()
    sample = stored(docs.select("doc_id", raw).join(F.broadcast(chosen), "doc_id"), "toxicity-sample")

    def drawn(checks: bool):
        return sample.where(F.col("checks") == checks) if parted else sample

    model = spark.sparkContext.broadcast(fit_ratios(drawn(False).select("toxic", "raw")))
    seen = drawn(True).select(F.col("toxic").cast("long"), "raw").mapInArrow(
        lambda batches: measured(batches, model), f"toxic long, {KINDS}").collect()
    x = np.array([r[1:] for r in seen], np.float64).reshape(-1, len(NAMES))
    y = np.array([r[0] for r in seen], np.float64)
    order = np.lexsort((*x.T, y))
    beta = logistic(x[order], y[order], np.where(y[order] == 1, 1 / rate[1, True], 1 / rate[0, True]) * min(rate[1, True], rate[0, True]))
    margin = sum((F.col(name) * float(b) for name, b in zip(NAMES, beta)), F.lit(float(beta[-1])))
    scored = docs.select("doc_id", raw).mapInArrow(lambda batches: measured(batches, model), f"doc_id long, {KINDS}")
    out = scored.select("doc_id", held, (1 / (1 + F.exp(-margin))).alias("score"))
    return out.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))
