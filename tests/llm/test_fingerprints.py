import hashlib
import random

from pyspark.sql import functions as F
from words import documents, prose  # noqa: F401

from cargolens.llm import fingerprints as fp


def prints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    out = fp.add_fingerprints(df, {"p": F.col("t")}).select("i", fp.as_text(F.col("p")).alias("p"))
    return [r.p for r in sorted(out.collect())]


def test_order_does_not_matter_but_content_does(spark):
    parts = [prose(i, 12).replace("\n", " ") for i in range(30)]
    shuffled = parts[:]
    random.Random(1).shuffle(shuffled)
    a, b, c, d = prints(spark, ["\n".join(parts), "\n".join(shuffled), "\n".join(parts[1:]), "\n".join(parts + parts[:1])])
    assert a == b and len({a, c, d}) == 3
    assert len(a) == 8 * 8 + 128 * 4


def test_insert_and_delete(spark):
    one, two = prose(1, 200), prose(2, 150)
    df = spark.createDataFrame([(one, two, one + "\n" + two)], "a string, b string, ab string")
    df = fp.add_fingerprints(df, {"pa": F.col("a"), "pb": F.col("b"), "pab": F.col("ab")})
    r = df.select((fp.insert(F.col("pa"), F.col("pb")) == F.col("pab")).alias("i"),
                  (fp.delete(F.col("pab"), F.col("pb")) == F.col("pa")).alias("d")).first()
    assert r.i and r.d


def test_likeness_follows_the_cosine(spark):
    a = [prose(i, 10).replace("\n", " ").replace(",", "") for i in range(60)]
    rows = [("\n".join(a), "\n".join(a[k:] + [prose(500 + k + j, 10).replace("\n", " ").replace(",", "") for j in range(k)]))
            for k in (0, 15, 30, 45, 60)]
    df = fp.add_fingerprints(spark.createDataFrame(rows, "a string, b string"), {"x": F.col("a"), "y": F.col("b")})
    got = [r.n for r in fp.add_likeness(df, {"n": ("x", "y")}).collect()]
    assert got[0] == 1.0 and all(abs(g - w) < 0.25 for g, w in zip(got, (1, .75, .5, .25, 0)))


def test_edit_report_against_plain_python(documents):
    rows = [(i * 3 % 101, prose(i, 1 + i * 7 % 130)) for i in range(60)] + [(200, None), (201, ""), (202, "é😀x" * 40_000), (203, "a")]
    out = fp.edit_report(documents(rows, extra=[("th", "x"), ("k", "y"), ("rows", "z"), ("next_id", "n")])).collect()
    assert len(out) == len(rows)
    text = {i: t or "" for i, t in rows}
    order = sorted(text, reverse=True)
    after = {i: order[(k + 1) % len(order)] for k, i in enumerate(order)}
    for r in out:
        t, nxt = text[r.doc_id], text[after[r.doc_id]]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_edited == 1.0 if r.fingerprint == r.edited_fingerprint else True
    same = {r.fingerprint for r in out if not text[r.doc_id]}
    assert len(same) == 1 and {r.near_edited for r in out if not text[r.doc_id]} == {1.0}


def test_repeated_rows_null_ids_and_tables_of_none_or_one(documents):
    text = prose(3, 80)
    out = fp.edit_report(documents([(1, text), (1, text), (1, text), (None, "b c. d"), (None, None)])).collect()
    assert len(out) == 5
    twice = sorted(r.edited_sha256 for r in out if r.doc_id == 1)
    own = hashlib.sha256((text[:len(text) - len(text) // 2] + text[:len(text) // 2]).encode()).hexdigest()
    assert twice.count(own) == 2
    assert fp.edit_report(documents([])).count() == 0
    one = fp.edit_report(documents([(4, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def test_a_paragraph_repeated_very_often_keeps_its_direction(spark):
    df = spark.createDataFrame([("a\n" * 10, "a\n" * 40_000)], "a string, b string")
    df = fp.add_fingerprints(df, {"x": F.col("a"), "y": F.col("b")})
    assert fp.add_likeness(df, {"n": ("x", "y")}).first().n > 0.999
