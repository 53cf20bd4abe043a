"""Forests grown in parallel tasks, ridge paths and concurrent jobs."""

import threading

import numpy as np
import pandas as pd
import pytest
from conftest import SMOKE
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cargolens.operators import forest as G
from cargolens.operators.models import Bench, Fitted
from cargolens.operators.parallel import concurrently
from cargolens.operators.prep import FeatureSet
from cargolens.plans import q_models as M
from cargolens.sources.fixtures import market

FS = FeatureSet(num=["a", "b"], cat=["c"])


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    data = []
    for i in range(900):
        a, b, c = round(float(rng.normal()), 2), float(rng.integers(0, 9)), "abcde"[rng.integers(0, 5)]
        y = 2.0 * (a > 0.3) + 0.2 * b + {"a": 1.5, "b": 0.0, "c": -1.0, "d": 0.4, "e": 0.0}[c] + float(rng.normal()) * 0.1
        data.append((i, i // 2, a if i % 50 else None, b, c, y, int(y > 1.5)))
    return spark.createDataFrame(data, "i long, order_id long, a double, b double, c string, target double, y int").repartition(5)


def codes_of(x):
    values, codes = zip(*(np.unique(c, return_inverse=True) for c in x.T))
    return list(values), np.array(codes)


def split_of(x, y, w, levels, leaf):
    """The best split of one node by trying each: (gain, input, threshold)."""
    def gain(go):
        if min((w[go] > 0).sum(), (w[~go] > 0).sum()) < leaf:
            return -np.inf
        return sum((w[m] * y[m]).sum() ** 2 / w[m].sum() for m in (go, ~go)) - (w * y).sum() ** 2 / w.sum()
    best = (-np.inf, None, None)
    for f in range(x.shape[1]):
        seen = np.unique(x[w > 0, f])
        for t in (seen if f in levels else (seen[1:] + seen[:-1]) / 2):
            g = gain(x[:, f] == t if f in levels else x[:, f] <= t)
            if g > best[0] + 1e-9:
                best = (g, f, t)
    return best


def test_splits_equal_brute_force():
    rng = np.random.default_rng(1)
    for turn in range(40):
        n = int(rng.integers(5, 60))
        x = np.column_stack([rng.integers(0, 6, n), rng.normal(size=n).round(1), rng.integers(0, 4, n)]).astype(float)
        y, w, leaf = rng.normal(size=n).round(2), rng.integers(0, 3, n).astype(float), int(rng.integers(1, 6))
        if not (w > 0).any():
            continue
        tree = G.grow_tree(*codes_of(x), y, w, {2: 4}, None, leaf, None, rng)
        where, todo = {0: np.ones(n, bool)}, [0]
        while todo:
            node = todo.pop()
            mine = where[node] & (w > 0)
            g, f, t = split_of(x[mine], y[mine], w[mine], {2}, leaf)
            assert tree["value"][node] == pytest.approx((w * y)[mine].sum() / w[mine].sum())
            if tree["feature"][node] < 0:
                assert f is None or g < 1e-9
                continue
            f2, t2 = tree["feature"][node], tree["threshold"][node]
            go = x[:, f2] == t2 if f2 == 2 else x[:, f2] <= t2
            parts = [(w * y)[mine & s].sum() ** 2 / w[mine & s].sum() for s in (go, ~go)]
            assert sum(parts) - (w * y)[mine].sum() ** 2 / w[mine].sum() == pytest.approx(g)     # as good as the best
            for child, side in ((tree["left"][node], go), (tree["right"][node], ~go)):
                where[child] = where[node] & side
                todo.append(child)


def test_depth_leaf_and_weights():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(400, 3)), rng.integers(0, 2, 400).astype(float)
    for depth in (0, 1, 3):
        tree = G.grow_tree(*codes_of(x), y, np.ones(400), {}, None, 1, depth, rng)
        assert len(tree["value"]) <= 2 ** (depth + 1) - 1
    whole = G.grow_tree(*codes_of(x), y, np.ones(400), {}, None, 1, None, rng)
    assert set(whole["value"][whole["feature"] < 0]) == {0.0, 1.0}                # unlimited: every leaf is pure
    counts = np.where(y == 1, 3.0, 1.0)
    w = counts * G._class_weights(y, counts, "balanced_subsample")
    assert w[y == 1].sum() == pytest.approx(w[y == 0].sum())
    assert G._class_weights(y, counts, "balanced")[y == 1].sum() == pytest.approx(200)


def test_forests_learn_refit_equal_and_ignore_the_layout(spark, rows, tmp_path):
    test, train = rows.filter("i % 4 = 0"), rows.filter("i % 4 <> 0")
    base = test.agg(F.stddev_pop("target")).first()[0]
    got = []
    for layout in (train, train.coalesce(1), train.repartition(7, "a")):
        bench = Bench(layout, FS, "target")
        fitted = bench.forest_regressor(trees=30, leaf=3)
        got.append({r.i: r.p for r in fitted.score(test, "p").collect()})
        bench.close()
    assert got[0] == pytest.approx(got[1]) and got[0] == pytest.approx(got[2])
    rmse = fitted.score(test, "p").agg(F.sqrt(F.avg(F.pow(F.col("p") - F.col("target"), F.lit(2))))).first()[0]
    assert rmse < 0.4 * base
    bench = Bench(train, FS, "y")
    for weight in (None, "balanced", "balanced_subsample"):
        clf = bench.forest_classifier(trees=20, leaf=5, class_weight=weight)
        right = clf.score(test, "s").agg(F.avg(((F.col("s") >= 0.5) == (F.col("y") == 1)).cast("int"))).first()[0]
        assert right > 0.9 and clf.info["class_weight"] == weight
    clf.save(spark, str(tmp_path / "forest"))
    loaded = Fitted.load(spark, str(tmp_path / "forest"))
    a, b = (f.score(test, "s").select("i", "s").orderBy("i").collect() for f in (clf, loaded))
    assert a == b and loaded.info == clf.info
    bench.close()


def test_coded_training_sets_grow_the_same_forest(rows, monkeypatch):
    def predictions():
        bench = Bench(rows, FS, "target")
        fitted = bench.forest_regressor(trees=10, leaf=2)
        bench.close()
        assert isinstance(fitted.model, G.Forest)
        return {r.i: r.p for r in fitted.score(rows, "p").collect()}, fitted.model

    want, _ = predictions()
    monkeypatch.setattr(G, "SIDE_BYTES", 20_000)             # 900 rows of 4 inputs: 36,000 bytes as doubles, 14,400 as codes
    got, model = predictions()
    assert got == pytest.approx(want)
    # a forest that is read file by file predicts the same
    x = np.column_stack([np.linspace(-2, 2, 50), np.arange(50) % 9, np.zeros(50), np.arange(50) % 5])
    whole = G.predicted(model.path, (3,), x)
    assert G._rows_at_once(model.path) == 1
    monkeypatch.setattr(G, "FOREST_NODES", 10)
    assert G._rows_at_once(model.path) == G.ROWS_AT_ONCE
    assert G.predicted(model.path, (3,), x) == pytest.approx(whole)
    parts = list(G._predicted_all(model.path, (3,), [x[:7], x[:0], x[7:]]))
    assert [len(p) for p in parts] == [7, 0, 43] and np.concatenate(parts) == pytest.approx(whole)


def test_bins_part_rows_where_the_forest_does(rows, monkeypatch):
    monkeypatch.setattr(G, "SIDE_BYTES", 20_000)
    monkeypatch.setattr(G, "MOST_VALUES", 40)                # input a has more values
    monkeypatch.setattr(G, "BINS", 32)
    bench = Bench(rows, FS, "target")
    side, levels = bench.side()
    y, values, codes, bins = G._training_set(side)
    assert bins == {0} and len(values[0]) <= 32 and len(y) == 900
    tree = G.grow_tree(values, codes, y, np.ones(900), levels, None, 1, None, np.random.default_rng(0), bins)
    x = np.array([r.features.toArray() for r in bench.vectors(False)[1].select("features").collect()])
    at = np.zeros(len(x), np.int64)
    while (tree["feature"][at] >= 0).any():
        f, t = tree["feature"][at], tree["threshold"][at]
        v = x[np.arange(len(x)), np.maximum(f, 0)]
        go = np.where(np.isin(f, list(levels)), v == t, v <= t)
        at = np.where(f < 0, at, np.where(go, tree["left"][at], tree["right"][at]))
    labels = np.array([r.label for r in bench.vectors(False)[1].select("label").collect()])
    for leaf in np.unique(at):                               # the mean of the rows that end there
        assert labels[at == leaf].mean() == pytest.approx(tree["value"][leaf])
    bench.close()


@pytest.mark.parametrize("n, distinct, kind", [(6000, 300, {"leaf": 3, "share": 0.5, "depth": None}), (70_000, 10**9, {
    "leaf": 40, "share": 0.7, "depth": 9}), (6000, 300, {"leaf": 2, "share": "sqrt", "depth": 6, "class_weight": "balanced_subsample"})])
def test_trees_of_the_jvm_are_those_of_numpy(spark, n, distinct, kind):
    rng = np.random.default_rng(7)                           # the second case has codes of four bytes
    x = np.column_stack([rng.integers(0, distinct, n), rng.permutation(n), rng.integers(0, 9, n), rng.integers(0, 30, n)]).astype(float)
    y = np.floor(x[:, 0] * 3 / distinct) + (x[:, 3] == 2) + rng.integers(0, 9, n) * 7 + x[:, 1] // 50       # whole numbers: sums are exact
    if "class_weight" in kind:
        y = (y > np.median(y)).astype(float)
    rows = pd.DataFrame({"x": list(x), "label": y})
    df = spark.createDataFrame(rows).select(array_to_vector("x").alias("features"), "label")
    side = G.side_table(df, 4, True)
    forest = G.grow_forest(spark, side, {3: 31}, 3, **kind)
    labels, values, codes, bins = G._training_set(side)
    assert sorted(zip(*[v[c] for v, c in zip(values, codes)], labels)) == sorted(map(tuple, np.column_stack([x, y])))
    slots = int(34 ** 0.5) if kind["share"] == "sqrt" else int(34 * kind["share"])
    for t, tree in enumerate(G._small_forest(forest.path)):
        root = G.tree_id(42, t)
        drawn = G.draw_rows(n, root)
        want = G.grow_tree(values, codes, labels, drawn * G._class_weights(labels, drawn, kind.get("class_weight")), {3: 31}, slots,
                           kind["leaf"], kind["depth"], root, bins)
        assert tree["tree"] == t and len(tree["feature"]) > 20
        todo, same = [(0, 0)], 0
        while todo:
            a, b = todo.pop()
            alike = tree["feature"][a] == want["feature"][b] and tree["number"][a] == pytest.approx(
                want["value" if want["feature"][b] < 0 else "threshold"][b])
            if alike and tree["feature"][a] >= 0:
                todo += [(tree["child"][a], want["left"][b]), (tree["child"][a] + 1, want["right"][b])]
            same += alike
        assert same >= 0.97 * len(want["value"])             # equally good splits may differ by rounding of gains


def test_smaller_forests_and_other_vectors_reuse_what_a_bench_has(spark, rows, monkeypatch, tmp_path):
    from cargolens.operators import prep as P
    calls = []
    for module, name in ((P, "_learnt"), (G, "grow_forest")):
        monkeypatch.setattr(module, name, lambda *a, f=getattr(module, name), name=name, **k: (calls.append(name), f(*a, **k))[1])
    bench = Bench(rows, FS, "target")
    linear, _, n, sd = bench.vectors(True)
    trees = bench.vectors(False)[0]
    assert calls == ["_learnt"] and linear.linear and not trees.linear and trees.centre == {} and linear.centre
    assert (trees.medians, trees.levels, trees.missing) == (linear.medians, linear.levels, linear.missing) and n == 900 and sd > 0
    whole, part = bench.forest_regressor(trees=6), bench.forest_regressor(trees=4)
    assert calls.count("grow_forest") == 1 and (whole.model.trees, part.model.trees) == (6, 4)
    bench.close()
    alone = Bench(rows, FS, "target").forest_regressor(trees=4)
    part.save(spark, str(tmp_path / "four"))
    want, got, loaded = ({r.i: r.p for r in f.score(rows, "p").collect()} for f in (alone, part, Fitted.load(spark, str(tmp_path / "four"))))
    assert got == pytest.approx(want) and loaded == pytest.approx(want)
    assert {r.i: r.p for r in whole.score(rows, "p").collect()} != pytest.approx(want)
    monkeypatch.setattr(G, "FOREST_NODES", 10)
    x = np.array([r.features.toArray() for r in alone.prep.transform(rows).select("features").collect()])
    assert G.predicted(whole.model.path, (3,), x, 4) == pytest.approx(G.predicted(alone.model.path, (3,), x))


def test_forests_predict_alike_in_the_jvm_and_in_python(rows, monkeypatch):
    bench = Bench(rows, FS, "target")
    fitted = bench.forest_regressor(trees=37, leaf=2)        # not a multiple of the trees side by side
    bench.close()

    def scored():
        df = fitted.score(rows, "p")
        plan = df._jdf.queryExecution().executedPlan().toString()
        return {r.i: r.p for r in df.collect()}, "ArrowEvalPython" in plan

    got, in_python = scored()
    monkeypatch.setattr(G, "HEAP_SHARE", 0.0)
    want, want_python = scored()
    assert got == pytest.approx(want) and (in_python, want_python) == (False, True)


def test_large_training_sets_go_to_row_parallel_forests(rows, monkeypatch):
    monkeypatch.setattr(G, "SIDE_BYTES", 100)
    bench = Bench(rows, FS, "target")
    fitted = bench.forest_regressor(trees=5, depth=4)
    assert not isinstance(fitted.model, G.Forest) and fitted.score(rows, "p").filter("p is not null").count() == 900
    bench.close()


def test_ridge_path_is_the_closed_form(rows):
    bench = Bench(rows, FS, "target")
    got = bench.vectors(True)[1].select("features", "label").collect()
    x, y = np.stack([r.features.toArray() for r in got]), np.array([r.label for r in got])
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha, one in zip((0.01, 1.0, 100.0), bench.ridge_path((0.01, 1.0, 100.0))):
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
        assert np.allclose(one.model.coefficients.toArray(), want, atol=1e-8)
        # MLlib ends its iterations earlier where a pooled level is empty
        assert np.allclose(one.model.coefficients.toArray(), bench.ridge(alpha).model.coefficients.toArray(), atol=1e-4)
        scored = {r.i: r.p for r in one.score(rows, "p").collect()}
        assert sum(scored.values()) / len(scored) == pytest.approx(y.mean())
    bench.close()


def test_concurrent_jobs_keep_order_and_raise(spark):
    got = concurrently(spark, [lambda k=k: (spark.range(k).count(), threading.get_ident()) for k in range(8)], 3)
    assert [g[0] for g in got] == list(range(8)) and 1 < len({g[1] for g in got}) <= 3
    with pytest.raises(ZeroDivisionError):
        concurrently(spark, [lambda: 1 // 0, lambda: 2])


def test_searches_name_their_winners(spark):
    log = spark.createDataFrame([("forest", "leaf=5 share=sqrt depth=None class_weight=balanced", True), ("logit_l2", "C=0.1 balanced=False", True),
                                 ("voting", "w_logit=0.25", True), ("voting", "w_logit=0.5", False)], "family string, params string, chosen boolean")
    assert M.chosen(log) == {"forest": {"leaf": 5, "share": "sqrt", "depth": None, "class_weight": "balanced"},
                             "logit_l2": {"C": 0.1, "balanced": False}, "voting": {"w_logit": 0.25}}


def test_last_window_is_the_hold_out(spark):
    from cargolens.plans.q_eval import split
    m = market(spark, SMOKE)
    train, test = split(m)
    rows = M.spl05_rolling_refit(spark, SMOKE).collect()
    assert len(rows) == 24 and {r.window for r in rows} == {"W1", "W2", "W3", "W4"}
    last = [r for r in rows if r.window == "W4"]
    assert {(r.train_orders, r.test_orders) for r in last} == {(train.count(), test.count())}
    held = {r.model: r for r in M.mdl_late_test(spark, SMOKE).collect()}
    for r in last:
        if r.model in ("logit", "logit_l2", "dummy (prior)"):
            assert (r.pr_auc, r.precision) == pytest.approx((held[r.model].pr_auc, held[r.model].precision), abs=2e-3)
