import duckdb
import pytest
from words import documents, prose  # noqa: F401

from cargolens.llm import licenses

MIT = dict((n, t) for n, t in licenses.TEMPLATES if len(t) > 200)["MIT"]


def scan(df):
    return {r.doc_id: r for r in licenses.license_scan(df).collect()}


def test_notices_and_full_texts(documents):
    got = scan(documents([
        (1, prose(1, 80) + "\nReleased under the MIT License.\n" + prose(2, 30)),
        (2, "RELEASED!! UNDER!! THE!! MIT!! LICENSE!!"),
        (3, MIT), (4, MIT.replace("copies of", "units of") + " And a word more."), (5, prose(3, 200)),
        (6, "Copyright me\n\n" + MIT.replace(". ", ".\n") + "\n\n" + prose(4, 500))]))
    assert got[1].license == "MIT" and got[1].dice == 1.0 and got[1].licensed_units == 1
    assert got[2].license == "MIT" and got[3].dice == 1.0
    assert got[4].license == "MIT" and 0.8 <= got[4].dice < 1
    assert got[5].license is None and got[5].dice is None and got[5].licensed_units == 0
    assert got[6].license == "MIT"


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b))


def grams(text):
    import re
    w = re.sub("[^a-z0-9]+", " ", text.lower()).strip().split(" ")
    return set(zip(w, w[1:]))


def test_size_bounds_lose_nothing(documents):
    rows = []
    for k, (_, t) in enumerate(licenses.TEMPLATES):
        w = t.split()
        for cut in (1, 2, 5, len(w) // 5 + 1):
            rows.append((len(rows), " ".join(w[cut:])))
            rows.append((len(rows), t + " " + prose(k, cut)))
    got = scan(documents(rows))
    for i, text in rows:
        best = max(dice(grams(text), grams(t)) for _, t in licenses.TEMPLATES)
        units = [g for u in text.split("\n") if (g := grams(u))]
        best = max([best] + [dice(u, grams(t)) for u in units for _, t in licenses.TEMPLATES])
        if best >= licenses.THRESHOLD:
            assert got[i].dice == pytest.approx(best), text
        else:
            assert got[i].license is None


def test_edges(documents):
    df = documents([(1, None), (2, ""), (3, "mit"), (4, "x " * 30_000), (5, MIT), (5, MIT)], extra=[("dice", "a"), ("_row", "b")])
    out = licenses.license_scan(df)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_row", "license", "dice", "licensed_units"]
    rows = out.collect()
    assert len(rows) == 6 and sum(r.license == "MIT" for r in rows) == 2
    assert licenses.license_scan(documents([])).count() == 0


def test_matches_its_sql(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.execute(licenses.oracle()).fetchall())
    got = licenses.license_scan(spark.read.parquet(f"{sf}/documents.parquet")).select("doc_id", "license", "dice", "licensed_units")
    assert sorted(map(tuple, got.collect())) == want and any(r[1] for r in want)
