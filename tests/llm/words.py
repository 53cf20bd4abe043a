"""Made-up prose for the tests, the same in every run, and a table of it."""
import random

import pytest


def vocabulary(seed=1, n=900):
    r = random.Random(seed)
    parts = ["an", "the", "ing", "ou", "re", "tion", "ble", "sh", "ea", "wh", "er", "th", "st", "ed", "ly"]
    return ["".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n)]


def prose(seed, words, vocab=None):
    r, vocab = random.Random(seed), vocab or vocabulary()
    out = []
    while len(out) < words:
        sentence = [r.choice(vocab) for _ in range(r.randint(4, 12))]
        sentence[0] = sentence[0].capitalize()
        if len(sentence) > 7:
            sentence[4] += ","
        sentence[-1] += "."
        out += sentence
    text = " ".join(out[:words])
    cut = r.randint(0, 3)
    for _ in range(cut):
        i = text.find(". ", r.randint(0, max(1, len(text) - 2)))
        if i > 0:
            text = text[:i + 1] + "\n" + text[i + 2:]
    return text


DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """documents(rows): rows of (doc_id, text) or (doc_id, text, source)."""
    def make(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) + tuple(v for _, v in extra)
                for r in rows]
        schema = DOC + "".join(f", {name} string" for name, _ in extra)
        return spark.createDataFrame(full, schema)
    return make
