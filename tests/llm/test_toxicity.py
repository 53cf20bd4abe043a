import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from words import documents, prose, vocabulary  # noqa: F401

from cargolens.llm import toxicity

STEMS = ["loser", "scumm", "vequ", "äßlow"]


def corpus(n=900):
    r = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        w = prose(i, r.randint(20, 160)).split(" ")
        bad = i % 5 == 0
        if bad:
            for _ in range(r.randint(2, 5)):
                w[r.randrange(len(w))] = r.choice(STEMS) + r.choice(["", "ing", "ed", "ou"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark, documents):
    rows, labels = corpus()
    docs = documents(rows, extra=[("score", "x"), ("_id", "y"), ("toxic", "z"), ("features", "f")])
    known = spark.createDataFrame(labels, "doc_id long, toxic int").filter(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.train(docs, known)
    out = toxicity.score(docs, model, alias="s").select("doc_id", "s", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score").collect()
    assert all(r.score == "x" for r in out) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    truth = dict(labels)
    test = [(r.s >= toxicity.CUT, truth[r.doc_id] == 1) for r in out if r.held_out]
    assert sum(p and t for p, t in test) >= 0.9 * sum(t for _, t in test)
    assert sum(p and not t for p, t in test) <= 0.01 * len(test)
    again = toxicity.train(docs, known)
    assert (again[0] == model[0]).all() and again[1] == model[1]


def test_bounded_sample_keeps_the_odds(spark, documents):
    rows, labels = corpus(600)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    weights, bias = toxicity.train(documents(rows), known, max_toxic=60, max_clean=60)
    assert np.count_nonzero(weights) > 0 and bias < 0


def test_whole_texts_are_read():
    long = " ".join(vocabulary(3, 400)) * 200
    assert len(long) > toxicity.STRETCH
    assert set(toxicity.features("vequou")) <= set(toxicity.features(long + " vequou"))
    assert len(toxicity.features(None)) == len(toxicity.features("")) == 0


def test_edges(spark, documents):
    docs = documents([(1, None), (2, ""), (None, "a b"), (4, "x" * 600_000), (5, "t"), (5, "t")])
    schema = "doc_id long, toxic int"
    for labels in ([], [(1, 1)], [(1, 0), (2, 0)], [(77, 1), (78, 0)], [(1, None), (None, 1), (2, 0), (2, 1), (4, 0)]):
        model = toxicity.train(docs, spark.createDataFrame(labels, schema))
        out = toxicity.score(docs, model).collect()
        assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    empty = documents([])
    assert toxicity.score(empty, toxicity.train(empty, spark.createDataFrame([(1, 0), (2, 1)], schema))).count() == 0
