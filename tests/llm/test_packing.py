import random
import zlib

import numpy as np
from tokenizers import Tokenizer
from words import documents, prose  # noqa: F401

from cargolens.llm import packing
from cargolens.llm.tokens import Encoder, default_tokenizer


def check_plan(counts, capacity):
    runs, n = packing.plan_best_fit(counts, capacity)
    fill, placed = {}, {}
    for length, rank, many, per, first, offset in runs:
        for i in range(many):
            placed.setdefault(length, []).append(rank + i)
            fill.setdefault(first + i // per, []).append((offset + i % per * length, length))
    assert {k: sorted(v) for k, v in placed.items()} == {k: list(range(c)) for k, c in counts.items() if c}
    for seq in fill.values():
        at = 0
        for off, length in sorted(seq):
            assert off == at
            at += length
        assert at <= capacity
    assert sorted(fill) == list(range(n))
    return n


def plain_best_fit(counts, capacity):
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - length)
            else:
                rooms.append(capacity - length)
    return len(rooms)


def test_plan_on_counts_equals_best_fit_on_items():
    r = random.Random(3)
    for _ in range(60):
        capacity = r.choice([7, 20, 64])
        counts = {r.randint(1, capacity): r.randint(1, 30) for _ in range(r.randint(1, 12))}
        assert check_plan(counts, capacity) == plain_best_fit(counts, capacity)
    assert check_plan({}, 64) == 0


def test_ids_are_those_of_the_tokenizer():
    path = default_tokenizer()
    plain, own = Tokenizer.from_file(path), Encoder(path)
    texts = [prose(i, 60) for i in range(40)] + [
        "", " ", "\n", " a", "a ", "a  b", "a\n\nb", "a \n b", "\ta\tb", "it's we'll DON'T 've", "x<|endoftext|>y", "<|endoftext|>",
        "a <|endoftext|>\n b", "héllo wörld ñ 日本語 テスト", "😀😀 a", "1234 5,678.90", "a b  c", "a\x1cb", "\x85", "--- ***",
        "end.\nStart 'quoted' (x)", "a\r\nb", "é combining", "퟿"]
    for t in texts:
        assert own.ids(t).tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_and_places(documents):
    rows = [(i, prose(i, 20 + 37 * i % 900)) for i in range(60)] + [(100, prose(9, 9000)), (101, None), (102, ""), (103, "a " * 4000)]
    rows += [(200 + i, prose(3, 50)) for i in range(40)] + [(300, "twice"), (300, "twice")]
    out = packing.pack_documents(documents(rows), with_ids=True).collect()
    plain = Tokenizer.from_file(default_tokenizer())
    want = {i: plain.encode(t or "", add_special_tokens=False).ids + [0] for i, t in rows}
    by_doc, by_seq = {}, {}
    for r in out:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and r.length == len(r.ids) <= 2048
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, t in rows:
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        if i == 300:
            assert len(parts) == 2 and all(p.ids == want[i] for p in parts)
            continue
        assert sum((p.ids for p in parts), []) == want[i]
        assert [p.length for p in parts[1:]] == [2048] * (len(parts) - 1)
        assert len(parts) == -(-len(want[i]) // 2048)
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    assert len(by_seq) <= -(-sum(r.length for r in out) // 2048) + 1


def test_empty_table_and_extra_columns(documents):
    assert packing.pack_documents(documents([])).count() == 0
    out = packing.pack_documents(documents([(None, "a b"), (1, "c")], extra=[("length", "x"), ("piece", "y"), ("_text", "z")]))
    assert out.count() == 2 and "source" not in out.columns
