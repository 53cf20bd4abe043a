"""Periodic runs against brute force, and the query on edge rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cargolens.llm import periodic


def brute_runs(words):
    found = {}
    for period in range(1, len(words) // 2 + 1):
        i = 0
        while i + period < len(words):
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            if j > i and j - i + period >= max(12, 2 * period):
                found.setdefault((i, j - i + period), period)      # the smallest period comes first
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def words_of(rng, n):
    """Words with many runs: of few letters, or repetitions of pieces inside each other."""
    letters = rng.choice([1, 2, 2, 3, 5])
    if rng.random() < 0.4:
        return [rng.randrange(letters) for _ in range(n)]
    words = []
    while len(words) < n:
        words += [rng.randrange(letters) for _ in range(rng.randint(1, 40))] * rng.randint(1, 5)
        if rng.random() < 0.3:
            words += words[-rng.randint(1, 60):]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(11)
    runs = 0
    for _ in range(800):
        words = words_of(rng, rng.randint(0, 150))
        got = [tuple(r) for r in periodic.runs_of(np.array(words, np.int64)).tolist()]
        assert got == brute_runs(words)
        runs += len(got)
    assert runs > 800


def test_long_repetitive_sequences():
    assert periodic.runs_of(np.zeros(100_000, np.int64)).tolist() == [[0, 100_000, 1]]
    assert periodic.runs_of(np.arange(60_000) % 20_000).tolist() == [[0, 60_000, 20_000]]
    a, b = [0], [0, 1]
    while len(b) < 3000:                        # Fibonacci words have as many runs as nearly any
        a, b = b, b + a
    assert [tuple(r) for r in periodic.runs_of(np.array(b)).tolist()] == brute_runs(b)


def test_wavelet_tree():
    rng = np.random.default_rng(3)
    values = rng.permutation(300)
    tree = periodic.WaveletTree(values, 300)
    lo = rng.integers(0, 300, 500)
    hi = np.array([rng.integers(a, 301) for a in lo])
    x = rng.integers(0, 700, 500)
    assert tree.below(lo, hi, x).tolist() == [int((values[a:b] < c).sum()) for a, b, c in zip(lo, hi, x)]
    some = hi > lo
    k = np.array([rng.integers(0, b - a) for a, b in zip(lo[some], hi[some])])
    assert tree.nth(lo[some], hi[some], k).tolist() == [
        int(np.sort(values[a:b])[c]) for a, b, c in zip(lo[some], hi[some], k)]


def test_shorter_runs_are_refused():
    with pytest.raises(ValueError):
        periodic.runs_of(np.zeros(4, np.int64), 5)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g, n = zlib.crc32(str(doc_id).encode()) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    s, n, p = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), s, n, p, 1000 * n // p if runs else None,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_query_rows(spark):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "a", "é ü " * 30, "one two three\x0b" * 9, "x " * 4000, "a b\x1cc \x85" * 13]
    texts += [" ".join(f"w{w}" for w in words_of(rng, rng.randint(1, 200))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b " * 10), (None, None), (7, texts[7]), (7, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = periodic.report(periodic.periodic_runs(periodic.planted(df)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr(expected(i, t)) for i, t in rows)


def test_operator_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a b " * 8, "r", "_t"), (2, None, None, None)], "doc_id long, text string, runs string, _text string")
    out = {r["doc_id"]: r for r in periodic.periodic_runs(df).collect()}
    assert out[1]["_text"] == "_t" and out[1]["text"] == "a b " * 8
    assert [tuple(r) for r in out[1]["runs"]] == [(0, 16, 2)] and out[1]["collapsed"] == "a b"
    assert out[2]["runs"] == [] and out[2]["collapsed"] is None
    assert periodic.periodic_runs(df.limit(0)).count() == 0
