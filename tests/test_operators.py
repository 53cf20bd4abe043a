"""Scalable operators against brute force on small fixtures."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cargolens.operators import evaluation as E
from cargolens.operators.loads import trailing_counts
from cargolens.operators.ranking import exact_quantile, global_running


def test_global_running_with_hot_key(spark):
    rng = np.random.default_rng(1)
    k = np.where(rng.random(3000) < 0.5, "hot", rng.choice(list("abc"), 3000))    # one key holds half the rows
    pdf = pd.DataFrame({"k": k, "v": rng.integers(0, 100, 3000).astype(float), "id": np.arange(3000)})
    out = global_running(spark.createDataFrame(pdf), ["v", "id"], {"cs": "v"}, keys=["k"]).toPandas()
    exp = pdf.sort_values(["k", "v", "id"]).assign(cs=lambda d: d.groupby("k").v.cumsum(),
                                                   pos=lambda d: d.groupby("k").cumcount() + 1)
    m = out.merge(exp, on="id")
    assert (m._k == m.pos).all() and np.allclose(m.cs_x, m.cs_y)


def test_exact_quantile_with_duplicates(spark):
    vals = [1.0, 2.0, 2.0, 4.0, 9.0, 9.0, 9.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for q in (0.25, 0.5, 0.8, 0.95):
        got = exact_quantile(df, "x", q).first()[0]
        assert abs(got - np.quantile(vals, q)) < 1e-12


def test_trailing_counts_half_open(spark):
    ev = [0, 10, 10, 20, 30, 86_400_000_000 * 7]         # microseconds; two events at the same instant
    probes = [(1, 10), (2, 11), (3, 86_400_000_000 * 7), (4, 86_400_000_000 * 7 + 15)]
    e = spark.createDataFrame([(t,) for t in ev], "t_us long")
    p = spark.createDataFrame(probes, "probe_id long, t_us long")
    w = 86_400_000_000 * 7
    out = {x.probe_id: x.n for x in trailing_counts(e, p, {"n": (w, 0)}).collect()}
    brute = {pid: sum(1 for t in ev if t0 - w <= t < t0) for pid, t0 in probes}
    assert out == brute


def test_trailing_counts_by_key_over_many_slices(spark):
    """A key with half of the rows spans several slices; null is a key; equal instants; a key without events."""
    rng = np.random.default_rng(11)
    keys = ["hot"] * 600 + ["a", "b", None, "c"] * 150
    ev = [(k, int(t)) for k, t in zip(keys, rng.integers(0, 400, len(keys))) if k != "c"]
    probes = [(k, i, int(t)) for i, (k, t) in enumerate(zip(keys, rng.integers(0, 450, len(keys))))]
    e = spark.createDataFrame([*ev, ("a", None)], "k string, t_us long").repartition(5)
    p = spark.createDataFrame(probes, "k string, probe_id long, t_us long").repartition(3)
    out = {x.probe_id: (x.k, x.n, x.m) for x in trailing_counts(e, p, {"n": (50, 0), "m": (200, 50)}, keys=["k"]).collect()}

    def count(k, lo, hi):
        return sum(1 for a, t in ev if a == k and lo <= t < hi)
    assert out == {i: (k, count(k, t - 50, t), count(k, t - 200, t - 50)) for k, i, t in probes}
    alone = {x.probe_id: x.n for x in trailing_counts(e.limit(0), p.limit(20), {"n": (50, 0)}, keys=["k"]).collect()}
    assert len(alone) == 20 and set(alone.values()) == {0}


def test_ranking_metrics_brute_force(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400), 1)                      # many ties
    df = spark.createDataFrame(pd.DataFrame({"order_id": np.arange(400), "y": y, "s": s}))
    ap = E.average_precision(df, "y", "s").first()
    auc = E.roc_auc(df, "y", "s").first().roc_auc
    # brute force: step-wise AP over distinct thresholds and pairwise AUC
    order = np.argsort(-s, kind="stable")
    thr = np.unique(s)[::-1]
    P = y.sum()
    ap_b, prev_r = 0.0, 0.0
    for t in thr:
        sel = s >= t
        tp = (y[sel] == 1).sum()
        rec, prec = tp / P, tp / sel.sum()
        ap_b += (rec - prev_r) * prec
        prev_r = rec
    pos, neg = s[y == 1], s[y == 0]
    auc_b = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(ap.pr_auc - ap_b) < 1e-12 and abs(auc - auc_b) < 1e-12
    del order


def test_top_share_rounds_half_even(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(25)], "order_id long, s double")
    f = E.flag_top_share(df, "s", 0.1, "order_id")
    assert f.agg(F.sum("flag")).first()[0] == 2           # round(2.5) = 2


def test_time_blocks_match_array_split(spark):
    n = 23
    df = spark.createDataFrame([(i, float(i // 2)) for i in range(n)], "order_id long, purchase_ts double")
    sizes = sorted(E.time_blocks(df, "purchase_ts", "order_id", 6).groupBy("block").count().collect())
    assert [x["count"] for x in sizes] == [len(b) for b in np.array_split(np.arange(n), 6)]


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_bracketed_quantiles_are_exact(spark, monkeypatch, accuracy):
    from cargolens.operators import ranking
    monkeypatch.setattr(ranking, "ACCURACY", accuracy)
    df = spark.range(20_000).repartition(7).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k"),
        F.when(F.col("id") % 11 > 0, F.pow((F.col("id") * 7919) % 10007, F.lit(1.5))).alias("v"), (F.col("id") % 5).alias("ties"))
    qs = (0.0, 0.013, 0.25, 0.5, 0.9, 1.0)
    wanted = {f"{c}{i}": (c, q) for c in ("v", "ties") for i, q in enumerate(qs)}
    want = df.groupBy("k").agg(*[F.percentile(c, q).alias(n) for n, (c, q) in wanted.items()])
    got = {r.k: r for r in ranking.exact_quantiles(df, wanted, ["k"]).collect()}
    rows = want.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert [got[r.k][n] for n in wanted] == pytest.approx([r[n] for n in wanted])
    one = ranking.exact_quantiles(df, wanted).first()
    all_ = df.agg(*[F.percentile(c, q).alias(n) for n, (c, q) in wanted.items()]).first()
    assert [one[n] for n in wanted] == pytest.approx([all_[n] for n in wanted])
