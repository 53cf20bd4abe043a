"""Alignment of two tokenizers against brute force over bytes."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from cargolens.llm import alignment

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    from tokenizers import Tokenizer
    import sentencepiece
    a = Tokenizer.from_file(alignment.default_tokenizer())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.default_pieces())


def byte_level():
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in own}
    for b in range(256):
        if b not in own:
            table[chr(256 + len(table) - len(own))] = b
    return table


def groups_of(text, tokenizers):
    """Groups of (A ids, B ids) by walking over the byte offsets; None without tokens."""
    a, b = tokenizers
    if not text:
        return None
    byte_of = byte_level()
    ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
    parts = [["".join([a.id_to_token(i)]) for i in ids[0]], [b.id_to_piece(i) for i in ids[1]]]
    parts[0] = [t.encode() if t == "<|endoftext|>" else bytes(byte_of[c] for c in t) for t in parts[0]]
    parts[1] = [bytes([int(t[3:5], 16)]) if b.is_byte(i) else t.replace("▁", " ").encode() for i, t in zip(ids[1], parts[1])]
    if any(b"".join(p) != (" " + text).encode() for p in parts):
        return None
    ends = [[sum(map(len, p[:k + 1])) for k in range(len(p))] for p in parts]
    shared = sorted(set(ends[0]) & set(ends[1]))
    groups, low = [], 0
    for high in shared:
        groups.append(tuple([i for i, e in zip(ids[k], ends[k]) if low < e <= high] for k in (0, 1)))
        low = high
    return groups


def expected(texts, tokenizers):
    groups = [groups_of(t, tokenizers) for t in texts]
    links = [[(a, b) for x, y in g or [] for a in x for b in y] for g in groups]
    counts = Counter(p for doc in links for p in set(doc))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for g, doc in zip(groups, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        out.append((sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), len(doc),
                    sum(counts[p] == best[p[0]] for p in doc), sum(counts[p] for p in doc),
                    "" if g is None else hashlib.sha256(text.encode()).hexdigest()))
    return out


def texts_of():
    rng = random.Random(13)
    pieces = ["the", "token", "isation", " ", "  ", "\n", "\t", "é", "ü", "日本語", "😀", "🏳️‍🌈", "ﬁ", "<|endoftext|>", "<s>", "<0x41>", "123456", "...",
              "don't", " ", "　", "é", "x" * 20, "=" * 30, "'s", "Wort", "straße", "\r\n", "_", "\x00", "ab", "ing "]
    texts = [None, "", " ", "\n", "▁", "a▁b", "the the the", "<unk>", "a" * 3000, "ab" * 700, "日" * 500, "= " * 400]
    texts += ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randint(1, 40))) for _ in range(150)]
    return texts + ["the the the", "same again", "same again"]


@pytest.mark.parametrize("limit", [alignment.BROADCAST, 40, 1])
def test_rows_equal_brute_force(spark, tokenizers, limit):
    texts = texts_of()
    df = spark.createDataFrame([(i, t, "clash", "p") for i, t in enumerate(texts)],
                               "doc_id long, text string, rid string, n_best string").repartition(4)
    got = alignment.align_tokenizers(df, limit=limit)
    assert got.columns == ["doc_id", "text", "rid", *COLUMNS]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert [tuple(rows[i][c] for c in COLUMNS) for i in range(len(texts))] == expected(texts, tokenizers)


def test_windows_are_remembered_and_forgotten(tokenizers, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 20)
    both = alignment.Aligner(alignment.ByteLevel(alignment.default_tokenizer()), alignment.Pieces(alignment.default_pieces()))
    texts = [t for t in texts_of() if t][:60]
    alone = [both.document(t)[:5] for t in texts]
    for at in range(0, len(texts), 7):
        rows, pairs, times = both.documents(texts[at:at + 7])
        assert [r[:5] for r in rows] == alone[at:at + 7]
        for r, p, n, t in zip(rows, pairs.to_pylist(), times.to_pylist(), texts[at:at + 7]):
            want = Counter((a << alignment.SHIFT) | b for x, y in groups_of(t, tokenizers) or [] for a in x for b in y)
            assert dict(zip(p, n)) == want and len(p) == len(want) and sum(n) == r[3]


def test_broadcast_bound(spark):
    counts = spark.createDataFrame([(i, 1 + i % 9, True) for i in range(90)], "pair long, count long, best boolean")
    for limit in (1, 10, 20, 50, 89, 90, 1000):
        least = alignment.least_broadcast(counts, limit)
        assert counts.filter(f"count >= {least}").count() <= limit or least == 64
        assert least == 1 or counts.filter(f"count >= {least // 2}").count() > limit or least > 9
    assert alignment.least_broadcast(counts.limit(0)) == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokenizers(df).count() == 0
    nothing = spark.createDataFrame([(1, None), (1, None), (None, "")], "doc_id long, text string")
    assert {tuple(r)[2:] for r in alignment.align_tokenizers(nothing).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_words_seen_are_not_tokenised_again():
    both = alignment.aligner(alignment.default_tokenizer(), alignment.default_pieces())
    texts = ["ein Haus am See", "am See, ein Haus", "a\nb c", "x́y z", " ́a b", "a ́b", "a  b", " a", "a­b c", "ª b", "1/2 ½ x",
             "<s> a </s>", "a <|endoftext|> b", "don't we'll 's x", "--- ***", "日本 a", "▁a b", "“q” – d…", "😀 a", "a <unk> b", "x" * 900 + " y", "!\n! a"]
    fast, whole = (alignment.Aligner(both.a, both.b) for _ in range(2))
    assert fast.by_word
    whole.by_word = False
    got, want = ([x.tolist() if hasattr(x, "tolist") else x for x in a.documents(texts * 2)] for a in (fast, whole))
    assert [r[:5] for r in got[0]] == [r[:5] for r in want[0]]
    for a, b in zip(got[1:], want[1:]):
        assert [sorted(x) for x in a] == [sorted(x) for x in b]
    fast.a = fast.b = None                               # no tokenizer is at hand now
    assert fast.document("See ein Haus am")[:2] == whole.document("See ein Haus am")[:2]
