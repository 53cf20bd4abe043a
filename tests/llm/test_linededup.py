import pytest
from words import documents, prose  # noqa: F401

from cargolens.llm.linededup import line_dedup


def cleaned(df, **kw):
    return {r.doc_id: r for r in line_dedup(df, **kw).collect()}


def test_planted_passages_go_and_clean_text_stays(documents):
    passages = [prose(900 + k, 60) for k in range(8)]
    rows = []
    for i in range(160):
        w = prose(i, 150).split(" ")
        if i % 2:
            w.insert(30 + i % 70, passages[i % 16 // 2])
        rows.append((i, " ".join(w)))
    got = cleaned(documents(rows))
    for k, p in enumerate(passages):
        holders = [i for i, t in rows if p in t]
        assert len(holders) == 10
        assert p in got[holders[0]].text                   # the smallest id keeps it
        assert not any(p in got[i].text for i in holders[1:]), k
        for i in holders[1:]:                               # a good part of it is gone, and nothing else
            assert 0.25 * len(p) < got[i].removed_chars <= len(p) + 2
    assert all(got[i].text == t and got[i].removed_chunks == 0 for i, t in rows if i % 2 == 0)


def test_exact_copies_keep_one(documents):
    text = prose(5, 300)
    got = cleaned(documents([(7, text), (3, text), (9, text + " " + prose(6, 80)), (4, prose(8, 100))]))
    assert got[3].text == text and got[7].text == "" and got[9].removed_chars > 0.9 * len(text)
    assert got[4].removed_chunks == 0


def test_short_boilerplate_stays(documents):
    line = "All of the rest, and the others."
    got = cleaned(documents([(i, line + "\n" + prose(i, 60)) for i in range(20)]))
    assert all(r.removed_chars == 0 for r in got.values())


def test_edge_rows(spark, documents):
    text = prose(1, 200)
    df = documents([(1, None), (2, ""), (3, "   "), (4, "word"), (5, "a " * 50_000), (6, text), (7, text)],
                   extra=[("_row", "x"), ("spans", "y"), ("removed_chunks", "z")])
    got = cleaned(df)
    assert got[1].text is None and got[2].text == "" and got[3].text == "   " and got[4].text == "word"
    assert got[5].text == "a " * 50_000 and got[6].text == text and got[7].text == ""
    assert got[6]["_row"] == "x" and got[6]["spans"] == "y" and got[7]["removed_chunks"] > 0
    assert line_dedup(documents([])).count() == 0


def test_repeated_and_null_ids(documents):
    text = prose(2, 200)
    out = line_dedup(documents([(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, len(r.text) > 0) for r in out) == [(1, True), (1, True), (2, False)]
    out = line_dedup(documents([(None, text), (None, text + " " + prose(3, 50)), (2, prose(4, 90))])).collect()
    assert len(out) == 3 and sum(text in (r.text or "") for r in out) == 1


@pytest.mark.parametrize("other", [[], [(None, "unrelated words")], [(99, "one"), (99, "two")], [(None, None)]])
def test_the_smallest_id_keeps_whatever_other_ids_are(documents, other):
    text = prose(6, 150)
    rows = [(i, f"{prose(100 + i, 30)}\n{text}") for i in (7, 3, 0, 11, 5)] + other
    kept = [r.doc_id for r in line_dedup(documents(rows)).collect() if text in (r.text or "")]
    assert kept == [0]
    # a null id comes after all others
    out = line_dedup(documents([(None, text), (4, f"{text}\n{prose(7, 40)}"), *other])).collect()
    assert [r.doc_id for r in out if text in (r.text or "")] == [4]


def test_short_lines_join_to_the_text(spark):
    from pyspark.sql import functions as F

    from cargolens.llm.linededup import short_lines
    texts = ["", " ", "e ", "a\n\nb", "the rest, of it.\nMore e  s \n", prose(3, 90), "e e e s ", "é, ü! \n", "end", "x\x01e y, z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", short_lines(F.col("t")).alias("l"))
    assert all("".join(r.l) == r.t for r in df.collect())


WORDS = {
    "en": "the of and to in is that for it with as was on be at by this had not are but from or have an they which one were all "
          "her would there their will when who him been has more if out so said what up its about into than them can only",
    "de": "der die und in den von zu das mit sich des auf nicht eine als auch es an werden aus er hat dass sie nach wird bei "
          "einer um am sind noch wie einem einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde wort",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec ou son sa aux "
          "cette ses mais comme nous tout fait leur bien peut dont sans deux entre encore temps jour avant chez vers fort",
    "es": "de la que el en y a los del se las por un para con no una su al lo como pero sus le ya o este porque esta entre "
          "cuando muy sin sobre ser tiene tambien me hasta hay donde quien desde todo nos durante todos uno les ni contra",
    "ru": "и в не на я быть он с что а по это она этот к но они мы весь который из у то за свой весь год от так о для ты же "
          "все тот мочь вы человек такой его сказать только или еще бы себя один как уже до время если сам когда другой",
}


def test_most_of_every_passage_goes_in_every_language(documents):
    import random
    for lang, text in WORDS.items():
        r, vocab = random.Random(lang), text.split()
        made = lambda n: " ".join(r.choice(vocab) + ("" if r.random() > 0.1 else ",") for _ in range(n))
        rows, planted = [], {}
        for k in range(60):
            p = made(r.randint(51, 60))
            for i in (2 * k, 2 * k + 1):
                rows.append((i, f"{made(r.randint(20, 60))} {p} {made(r.randint(20, 60))}"))
            planted[2 * k + 1] = p
        got = cleaned(documents(rows))
        share = [min(1.0, got[i].removed_chars / len(p)) for i, p in planted.items()]
        assert min(share) > 0.7, (lang, min(share))             # none is missed or half left
        assert sum(share) / len(share) > 0.95, (lang, sum(share) / len(share))
        assert all(got[i].text == t for i, t in rows if i % 2 == 0)
