"""Tables and plain-Python rules that the tests of this folder share."""

import random
import re

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, size long, cell int, sid long, n long, id long, raw string, "
        "mark long, row string, salt int, bucket int")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]), with columns whose names operators use inside."""
    full = [(*r, *[None] * (4 - len(r))) for r in rows]
    extra = (7, 8, 9, 10, 11, 12, "raw", 13, "row", 14, 15)
    return spark.createDataFrame([(*r, *extra) for r in full], DOCS)


def words_of(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def corpus(seed=3, n=60):
    """Texts with copies, near copies, shared passages, blanks and one long text."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(300)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts = [None, "", " \n\t", "one two", "ONE  two", "a b c d e", "a b c d e"]
    base = rng.choices(vocabulary, k=80)
    for k in range(n):
        kind = k % 6
        if kind == 0:
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.randint(1, 90))
        text = " ".join(words) + (f"\n{passage}" if kind == 1 else "")
        texts.append(text)
        if kind == 2:
            texts.append(text.replace(" ", "\n", 1))
    texts.append(" ".join(rng.choices(vocabulary, k=6000)))
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


def roots_of(links, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
