import os

import pytest
from words import documents, prose  # noqa: F401

import __spark_entry__ as entry
import corpus_pipeline


def test_queries_are_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard_join", "mix_sources", "best_fit_packing"]


@pytest.fixture()
def folder(spark, documents, tmp_path):
    copy, near = prose(50, 200), prose(51, 200).split(" ")
    passage = prose(52, 70).replace("\n", " ")
    rows = [(i, prose(i, 120), f"s{i % 5}") for i in range(100)]
    rows += [(200 + i, copy, "s1") for i in range(5)]
    rows += [(300 + i, " ".join(near[:i * 9] + [f"new{i}"] + near[i * 9 + 1:]), "s2") for i in range(4)]
    rows += [(400 + i, prose(600 + i, 60) + " " + passage + " " + prose(700 + i, 60), "s3") for i in range(6)]
    rows += [(500 + i, prose(800 + i, 90) + " vequing scumou vequed stupidou", "s4") for i in range(90)]
    rows += [(900, None, None), (901, "", "s1"), (902, "a", "s1"), (902, "a", "s1"), (903, prose(77, 9000), "s2")]
    os.makedirs(tmp_path / "in")
    documents(rows).coalesce(2).write.parquet(str(tmp_path / "in/documents.parquet"))
    labels = [(r[0], int(500 <= r[0] < 590)) for r in rows if r[0] % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "in/labels.parquet"))
    return str(tmp_path / "in"), rows, passage


def test_stages_take_effect(spark, folder):
    sf, rows, passage = folder
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{sf}/{name}"
        stage(spark, docs, sf).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != "best_fit_packing":
            assert docs.dtypes == before.dtypes
        seen[name] = docs.collect()
    toxic = {r.doc_id for r in seen["toxicity"]}
    assert not toxic & set(range(500, 590)) and set(range(100)) <= toxic
    lines = {r.doc_id: r.text for r in seen["line_dedup"]}
    assert sum(passage in (t or "") for t in lines.values()) == 1
    assert sum(lines.get(200 + i) is not None for i in range(5)) == 1
    assert all(lines[i] == t for i, t, _ in rows[:100]) and {900, 901, 902} <= set(lines)
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in seen["line_dedup"])
    kept = [r.doc_id for r in seen["ngram_jaccard_join"]]
    assert set(range(100)) <= set(kept) and kept.count(902) == 1 and sum(300 <= k < 304 for k in kept) >= 1
    words = sum(len((r.text or "").split()) for r in seen["ngram_jaccard_join"])
    mixed = seen["mix_sources"]
    assert abs(sum(len(r.text.split()) for r in mixed) - 1.5 * words) < 0.25 * words
    packed = seen["best_fit_packing"]
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed}
    assert all(r.offset + r.length <= 2048 for r in packed)
    assert corpus_pipeline.run(spark, sf).count() == len(packed)


def test_near_copies_leave_one(spark, documents):
    hub = prose(9, 150).split(" ")
    rows = [(5 + i, " ".join(hub[:i * 10] + ["changed"] + hub[i * 10 + 1:])) for i in range(8)] + [(30, prose(8, 100)), (1, " ".join(hub)), (1, " ".join(hub))]
    out = corpus_pipeline.drop_near_copies(spark, documents(rows, extra=[("_own", "x"), ("_links", "y")]), "")
    assert sorted(r.doc_id for r in out.collect()) == [1, 30] and "_own" in out.columns


def test_stages_on_an_empty_table(spark, documents, tmp_path):
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0
