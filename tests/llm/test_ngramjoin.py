import random

import numpy as np
from words import documents, prose  # noqa: F401

from cargolens.llm import ngramjoin
from cargolens.llm.shingles import shingle_set


def sets(text, n=5):
    w = (text or "").lower().split()
    n = min(n, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute(rows, threshold=0.8):
    s = [(i, sets(t)) for i, t in rows]
    links, at = [0] * len(s), list(range(len(s)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x
    for a in range(len(s)):
        for b in range(a + 1, len(s)):
            x, y = s[a][1], s[b][1]
            if x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
                links[a] += 1
                links[b] += 1
                at[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (i, _) in enumerate(s):
        least.setdefault(find(k), []).append(i)
    return {i: (min(least[find(k)]), links[k]) for k, (i, _) in enumerate(s)}


def changed(text, seed, edits):
    r, w = random.Random(seed), text.split(" ")
    for _ in range(edits):
        w[r.randrange(len(w))] = f"edit{r.randrange(999)}"
    return " ".join(w)


def test_groups_and_links_match_brute_force(documents):
    rows = [(i, prose(i, 5 + i * 31 % 300)) for i in range(120)]
    rows += [(200 + k, changed(rows[k][1], k, 1 + k % 4)) for k in range(100)]
    hub = prose(777, 150)
    rows += [(400 + k, changed(hub, k, 2)) for k in range(120)] + [(600 + k, hub) for k in range(50)]
    step = prose(778, 200)
    for k in range(30):                                              # a chain of edits
        step = changed(step, 5000 + k, 2)
        rows.append((700 + k, step))
    rows += [(800, None), (801, ""), (802, " \n"), (803, "two words"), (804, "Two  words"), (805, "x"), (806, "word " * 60_000),
             (807, "word " * 50_000)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngramjoin.similarity_join(
        documents(rows, extra=[("id", "x"), ("text_key", "y"), ("class_id", "z")])).collect()}
    assert got == brute(rows)


def test_large_groups_are_cut_into_blocks(documents, monkeypatch):
    monkeypatch.setattr(ngramjoin, "BLOCK", 6000)
    hub = prose(779, 120)
    rows = [(k, changed(hub, k, 2)) for k in range(130)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngramjoin.similarity_join(documents(rows)).collect()}
    assert got == brute(rows)


def test_overlaps_by_matrix_products(monkeypatch):
    r = np.random.default_rng(1)
    a = [np.unique(r.integers(0, 500, 80).astype(np.uint64)) for _ in range(20)]
    b = [np.unique(r.integers(0, 700, 60).astype(np.uint64)) for _ in range(30)]
    want = np.array([[len(set(x.tolist()) & set(y.tolist())) for y in b] for x in a])
    assert (ngramjoin.overlaps(a, b) == want).all()
    monkeypatch.setattr(ngramjoin, "SPARSE", 0)
    assert (ngramjoin.overlaps(a, b) == want).all()


def test_banding_reaches_the_recall():
    bands = ngramjoin.band_count(0.8, 5, 0.9999)
    r = np.random.default_rng(3)
    found = 0
    for _ in range(300):
        common = r.integers(0, 2**62, 160).astype(np.uint64)
        x = np.unique(np.concatenate([common, r.integers(0, 2**62, 20).astype(np.uint64)]))
        y = np.unique(np.concatenate([common, r.integers(0, 2**62, 20).astype(np.uint64)]))
        found += bool((ngramjoin.band_hashes(x, bands, 5) == ngramjoin.band_hashes(y, bands, 5)).any())
    assert found >= 299


def test_shingle_sets():
    assert len(shingle_set(None)) == len(shingle_set(" \n\t ")) == 0
    assert len(shingle_set("a b c")) == 1 and (shingle_set("a b c") == shingle_set("A  b\nC")).all()
    assert len(shingle_set("a b c d e f")) == 2 and not (shingle_set("ab c") == shingle_set("a bc")).all()
    text = prose(3, 400)
    assert len(shingle_set(text)) == len(sets(text))


def test_null_ids_and_repeated_rows(documents):
    text = prose(1, 60)
    out = ngramjoin.similarity_join(documents([(None, text), (5, text), (5, text), (9, changed(text, 1, 1)), (7, None), (None, "")])).collect()
    assert sorted((r.doc_id or -1, r.class_id or -1, r.n_links) for r in out if r.n_links) == [(-1, 5, 3), (5, 5, 3), (5, 5, 3), (9, 5, 3)]
    assert sorted((r.doc_id or -1, r.class_id or -1) for r in out if not r.n_links) == [(-1, -1), (7, 7)]
    assert ngramjoin.similarity_join(documents([])).count() == 0
