"""Preprocessing, model families and late-order explanations."""
import math

import pytest
from conftest import SMOKE
from pyspark.sql import functions as F

from cargolens.operators import evaluation as E
from cargolens.operators.models import Bench, Fitted, stacked
from cargolens.operators.prep import FeatureSet, fit_prep, slot_inputs, target_encoding
from cargolens.operators.ranking import agg_with_quantiles, exact_quantiles
from cargolens.plans import q_models as M
from cargolens.sources.fixtures import market


@pytest.fixture(scope="module")
def rows(spark):
    data = []
    for i in range(600):
        x = (i * 37 % 101) / 10.0
        c = "abcde"[i * 7 % 5]
        y = 2.0 + 0.5 * x + (i * 13 % 7) / 7.0 + {"a": 1.0, "b": 0.0, "c": -1.0, "d": 0.5, "e": 0.0}[c]
        data.append((i, i // 2, float(x) if i % 11 else None, float(i % 9), c if i % 40 else "rare", f"s{i * 17 % 23}", y, int(y > 4.5)))
    return spark.createDataFrame(data, "i long, order_id long, price double, n double, c string, seller string, target double, y int")


FS = FeatureSet(num=["price", "n"], cat=["c"], te=["seller"])


def test_prep_scales_numbers_only(rows):
    prep, x = fit_prep(rows, FS, "target", linear=True)
    got = x.select("features").collect()
    names = slot_inputs(x, FS)
    values = [r.features.toArray() for r in got]
    assert names.count("c") == 6 and set(names) == {"price", "n", "c", "seller"}       # five levels and the pooled one
    for k, name in enumerate(names):
        col = [v[k] for v in values]
        if name == "c":
            assert set(col) <= {0.0, 1.0}
        else:
            mean = sum(col) / len(col)
            assert abs(mean) < 1e-9 and abs(math.sqrt(sum((v - mean) ** 2 for v in col) / len(col)) - 1) < 1e-9
    assert prep.missing == ["price"] and sorted(prep.levels["c"]) == ["a", "b", "c", "d", "e"]


def test_prep_uses_training_statistics(spark, rows):
    prep, _ = fit_prep(rows, FeatureSet(num=["price"], cat=["c"]), "target", linear=False)
    med = rows.agg(F.median("price")).first()[0]
    other = spark.createDataFrame([(None, "never seen"), (3.0, "a")], "price double, c string")
    a, b = [r.features.toArray().tolist() for r in prep.transform(other).select("features").collect()]
    assert a == [med, 1.0, 5.0] and b == [3.0, 0.0, float(prep.levels["c"].index("a"))]


def test_target_encoding_is_cross_fitted(rows):
    f = rows.withColumn("_f", E.hash_fold("order_id", 5))
    enc = {(r["_f"], r.level): r.enc for r in target_encoding(f, "seller", "target", ["_f"]).collect()}
    data = f.select("_f", "seller", "target").collect()
    for (fold, level), got in list(enc.items())[:40]:
        rest = [r.target for r in data if r["_f"] != fold]
        mine = [r.target for r in data if r["_f"] != fold and r.seller == level]
        mean = sum(rest) / len(rest)
        var = sum((v - mean) ** 2 for v in rest) / len(rest)
        if mine:
            mu = sum(mine) / len(mine)
            m = sum((v - mu) ** 2 for v in mine) / len(mine) / var
            assert got == pytest.approx((len(mine) * mu + m * mean) / (len(mine) + m))
        else:
            assert got == pytest.approx(mean)


def test_models_beat_the_mean_and_refit_equal(rows):
    test = rows.filter("i % 4 = 0")
    bench = Bench(rows.filter("i % 4 <> 0"), FS, "target")
    base = test.agg(F.stddev_pop("target")).first()[0]
    for fit in (lambda: bench.ridge(1.0), lambda: bench.forest_regressor(trees=20, depth=6), bench.tree_regressor):
        one, two = (fit().score(test, "p").select("i", "p").orderBy("i").collect() for _ in range(2))
        assert one == two
        rmse = fit().score(test, "p").agg(F.sqrt(F.avg(F.pow(F.col("p") - F.col("target"), F.lit(2))))).first()[0]
        assert rmse < 0.8 * base
    bench.close()


def test_ridge_is_the_closed_form(rows):
    import numpy as np
    bench = Bench(rows, FeatureSet(num=["price", "n"]), "target")
    fitted = bench.ridge(10.0)
    x = np.stack([r.features.toArray() for r in bench.vectors(True)[1].select("features").collect()])
    y = np.array([r.label for r in bench.vectors(True)[1].select("label").collect()])
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 10.0 * np.eye(x.shape[1]), xc.T @ yc)
    assert np.allclose(fitted.model.coefficients.toArray(), want, atol=1e-6)
    bench.close()


def test_stacking_and_save_load(spark, rows, tmp_path):
    train, test = rows.filter("i % 4 <> 0"), rows.filter("i % 4 = 0")
    got = stacked(train, FS, [test], ["i", "target"], 1.0, {"trees": 10, "depth": 5}, 3, y="target")[0]
    assert got.count() == test.count()
    bench = Bench(train, FS, "y")
    fitted = bench.logistic(1.0, balanced=True)
    fitted.save(spark, str(tmp_path / "m"))
    loaded = Fitted.load(spark, str(tmp_path / "m"))
    a, b = (f.score(test, "s").select("i", "s").orderBy("i").collect() for f in (fitted, loaded))
    assert a == b and loaded.info == fitted.info
    bench.close()


def test_contributions_explain_the_score(spark):
    m = market(spark, SMOKE)
    scored = M.late_scoring(m)
    parts = sum((F.col(f"d_{c}") for c in M.FS_B.inputs), F.lit(0.0))
    rest = scored.agg(F.min(F.col("log_odds") - parts).alias("lo"), F.max(F.col("log_odds") - parts).alias("hi")).first()
    assert rest.hi - rest.lo < 1e-6
    mean = scored.agg(*[F.avg(f"d_{c}").alias(c) for c in M.FS_B.inputs]).first()      # against the average hold-out order
    assert all(abs(mean[c]) < 1e-6 for c in M.FS_B.inputs)
    assert {r[0] for r in scored.select("suggested_follow_up").distinct().collect()} >= {
        "Update the delivery estimate", "Check carrier tracking", "Confirm dispatch with seller"}
    bare = spark.createDataFrame([(1,)], "x int").withColumn("features", F.lit(None))
    with pytest.raises(ValueError):
        slot_inputs(bare, M.FS_B)


def test_draws_are_distinct_and_repeatable():
    a = M.draws(M.FOREST_CLF, 20)
    assert len({str(c) for c in a}) == 20 and a == M.draws(M.FOREST_CLF, 20)


def test_quantiles_with_a_hot_group(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1600, "hot").when(F.col("id") < 1700, None).otherwise(
        F.concat(F.lit("k"), F.col("id") % 40)).alias("k"), F.when(F.col("id") % 7 > 0, F.pow(F.col("id") % 611, F.lit(1.5))).alias("v"),
        (F.col("id") % 13).alias("w"))
    want = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.median("v").alias("m"), F.percentile("v", 0.9).alias("p"), F.median("w").alias("w"))
    got = agg_with_quantiles(df, ["k"], [F.count(F.lit(1)).alias("n")], {"m": ("v", 0.5), "p": ("v", 0.9), "w": ("w", 0.5)})
    key = lambda r: str(r.k)
    for a, b in zip(sorted(want.collect(), key=key), sorted(got.collect(), key=key)):
        assert (a.k, a.n) == (b.k, b.n) and (b.m, b.p, b.w) == pytest.approx((a.m, a.p, a.w))
    one = exact_quantiles(df, {"a": ("v", 0.25)}).first()
    assert one.a == pytest.approx(df.agg(F.percentile("v", 0.25)).first()[0])
    assert exact_quantiles(df.filter("false"), {"a": ("v", 0.5)}).first().a is None
