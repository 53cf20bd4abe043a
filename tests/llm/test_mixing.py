import re

import pytest
from pyspark.sql import functions as F
from words import documents, prose  # noqa: F401

from cargolens.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, share=1.5, top=2.0):
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / w > top * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / w for s in open_}
        for s in over:
            out[s] = top * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= set(over)
    return out


def rows_of(n=150):
    names = ["b", "B", "é", "😀", "￿", None, "a", "big"]
    return [(i, prose(i, 1 + i * 17 % 90), names[i % 7] if i % 3 else "big") for i in range(n)] + [
        (900, None, "a"), (901, "", "nothing"), (902, "\x0b a b \x1c c ", "b")]


@pytest.mark.parametrize("whole", [False, True])
def test_targets_and_taken(documents, whole):
    rows = rows_of()
    out = {r.doc_id: r for r in mixing.mix_sources(documents(rows), whole_documents=whole).collect()}
    size = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    by = {}
    for i, _, s in rows:
        by.setdefault(s, []).append(i)
    want = targets({s: sum(size[i] for i in ids) for s, ids in by.items()})
    for s, ids in by.items():
        taken = sum(out[i].taken for i in ids)
        near = max(size[i] for i in ids) / 2 + 1 if whole else 1
        assert abs(taken - want[s]) <= near
        for i in ids:
            r = out[i]
            assert r["size"] == size[i] and r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * size[i]
            assert (r.position is not None) == (r.copies > 0) and (r.next_position is not None) == (r.copies > 1)
            if whole:
                assert r.taken == r.copies * size[i]


def test_curriculum_inverts_the_schedules(spark):
    for schedule in mixing.SCHEDULES + ((0.0, 1.0), (2.0, 0.0, 1.0, 4.0)):
        xs = [k / 40 for k in range(41)]
        df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", mixing.position(F.col("x"), schedule).alias("u"))
        step = 1 / (len(schedule) - 1)

        def area(u):
            total = 0.0
            for i, (a, b) in enumerate(zip(schedule, schedule[1:])):
                w = min(max(u - i * step, 0), step)
                total += a * w + (b - a) / step * w * w / 2
            return total
        got = [(r.x, r.u) for r in df.collect()]
        assert all(area(u) / area(1) == pytest.approx(x, abs=1e-9) for x, u in got) and all(0 <= u <= 1 for _, u in got)


def test_training_order(documents):
    rows = rows_of()
    df = documents(rows, extra=[("_row", "a"), ("_position", "b"), ("copies", "c")])
    mix = mixing.mix_sources(df, whole_documents=True)
    copies = {r.doc_id: r.copies for r in mix.collect()}
    order = mixing.training_order(df, mix)
    assert order.columns == df.columns
    got = [r.doc_id for r in order.collect()]
    assert {i: got.count(i) for i in copies} == copies
    again = [r.doc_id for r in mixing.training_order(df, mixing.mix_sources(df, whole_documents=True)).collect()]
    assert got == again


def test_repeated_rows_and_empty(documents):
    text = prose(1, 50)
    df = documents([(1, text, "a"), (1, text, "a"), (None, text, "b"), (3, text, None)])
    mix = mixing.mix_sources(df, whole_documents=True)
    assert mix.count() == 4 and mixing.training_order(df, mix).count() == sum(r.copies for r in mix.collect())
    assert mixing.mix_sources(documents([])).count() == 0
    none = mixing.mix_sources(documents([(1, "", "a"), (2, None, "b")])).collect()
    assert [(r.taken, r.target) for r in none] == [(0, 0.0)] * 2
