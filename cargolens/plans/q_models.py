"""Model experiments on MLlib (MDL, PRE, EXP, STA-8/9, SPL-7, SCO-1/2/4/5/11).

Training is MLlib's; this module builds the time-ordered folds, the searches
and the tables.  Scores of all models and folds are written once and measured
together by the keyed metric operators.  Results of trees and iterative solvers
depend on MLlib, so those queries carry no SQL oracle; ``tests/test_models.py``
checks their properties.  The two closed-form regressions have oracles.
"""

from __future__ import annotations

import ast
import hashlib
import itertools
import statistics
import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import r
from ..operators import evaluation as E
from ..operators.models import Bench, Fitted, stacked
from ..operators.parallel import concurrently, spread
from ..operators.prep import FeatureSet, fit_prep, slot_inputs
from ..operators.ranking import attach, exact_quantiles, global_running
from ..registry import query
from ..session import checkpoint_dir, stored
from ..sources.fixtures import market
from .core import item_features, memo, order_features
from .q_eval import item_split, scored_orders, split

# Input columns of the feature sets and groups.
NUM_CORE = ["weight_kg", "volume_cm3", "chargeable_kg", "distance_km"]
NUM_PRICE = ["price", "n_items", "n_sellers"]
NUM_LISTING = ["photos_qty", "name_len", "desc_len"]
NUM_TIME = ["purchase_month", "purchase_dow", "purchase_hour"]
CAT_GEO = ["seller_state", "customer_state"]
FS_REG = {
    "0 price only": FeatureSet(num=["price"]),
    "1 core": FeatureSet(num=NUM_CORE),
    "2 + category & states": FeatureSet(num=NUM_CORE + ["same_state"], cat=CAT_GEO + ["category"]),
    "3 + price & basket": FeatureSet(num=NUM_CORE + ["same_state"] + NUM_PRICE, cat=CAT_GEO + ["category"]),
    "4 + listing & timing": FeatureSet(num=NUM_CORE + ["same_state"] + NUM_PRICE + NUM_LISTING + NUM_TIME,
                                       cat=CAT_GEO + ["category"]),
    "5 + seller (target-encoded)": FeatureSet(num=NUM_CORE + ["same_state"] + NUM_PRICE + NUM_LISTING + NUM_TIME,
                                              cat=CAT_GEO + ["category"], te=["seller_id"]),
}
FS_A = FS_REG["3 + price & basket"]
FS_B = FeatureSet(num=["promised_days", "distance_km", "same_state", "price_total", "freight_total", "freight_ratio",
                       "n_items", "n_sellers"], cat=CAT_GEO)
LATE_GROUPS = {
    "route (distance, states)": FeatureSet(num=["distance_km", "same_state"], cat=CAT_GEO),
    "parcel & category": FeatureSet(num=["weight_kg", "volume_cm3", "chargeable_kg"], cat=["category"]),
    "order value & freight": FeatureSet(num=["price_total", "freight_total", "freight_ratio", "n_items", "n_sellers"]),
    "purchase weekday & hour": FeatureSet(num=["purchase_dow", "purchase_hour"]),
    "congestion (7-day volume surge)": FeatureSet(num=["platform_surge_7d", "seller_load_7d"]),
    "purchase month": FeatureSet(num=["purchase_month"]),
}
# Search grids, folds and the review share.
FOLDS, STACK_FOLDS, SHARE = 5, 3, 0.1
ALPHAS = (0.01, 0.1, 1.0, 10.0, 100.0, 1000.0)
LOGIT_C, VOTE_WEIGHTS = (0.01, 0.1, 1.0, 10.0), (0.25, 0.5, 0.75)
FOREST_REG = {"leaf": (2, 5, 10, 20), "share": (0.2, 0.33, 0.5), "depth": (None, 16, 24)}
FOREST_CLF = {"leaf": (10, 20, 50, 100, 200), "share": ("sqrt", 0.2, 0.3, 0.5), "depth": (6, 10, 16, None),
              "class_weight": (None, "balanced", "balanced_subsample")}
RIDGE_ALPHA, LATE_C, VOTE = 10.0, 1.0, 0.5
STACK_FOREST = {"trees": 100, "leaf": 5, "share": 0.5}
ITEM_KEYS = ["order_id", "order_item_id"]


def _union(frames):
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return out


def regression_scores(train, frames: dict, fs=FS_A, alpha: float = RIDGE_ALPHA, forest: dict | None = None):
    """Every freight model fitted on ``train``; (model, split, keys, reg_target, pred_log) for each frame.  ``forest``: its
    tuned values; the stacked one has half of its trees."""
    names, dfs, forest = list(frames), [spread(df) for df in frames.values()], forest or {}
    bench = Bench(train, fs, "reg_target")
    mean = train.agg(F.avg("reg_target").alias("pred_log"))
    bench.vectors(True), bench.vectors(False)

    def linear():
        plain, ridge = bench.ridge_path((0.0, alpha))
        return [("linear", [plain.score(df, "pred_log") for df in dfs]), ("ridge", [ridge.score(df, "pred_log") for df in dfs])]

    def grown(name, fit):
        fitted = fit()
        return [(name, [fitted.score(df, "pred_log") for df in dfs])]

    jobs = [lambda: [("dummy (mean)", [attach(df, mean) for df in dfs])], linear, lambda: grown("tree", bench.tree_regressor),
            lambda: grown("forest", lambda: bench.forest_regressor(**forest)),
            lambda: [("stacking (ridge + forest)", stacked(train, fs, dfs, [*ITEM_KEYS, "reg_target"], alpha, STACK_FOREST | forest | {
                "trees": STACK_FOREST["trees"]}, STACK_FOLDS, base=bench))]]
    out = [df.select(F.lit(model).alias("model"), F.lit(name).alias("split"), *ITEM_KEYS, "reg_target", "pred_log")
           for got in concurrently(train.sparkSession, jobs) for model, scored in got for name, df in zip(names, scored)]
    scores = stored(_union(out), "freight_scores")
    bench.close()
    return scores


def late_scores(train, frames: dict, fs=FS_B, logit: dict | None = None, forest: dict | None = None, vote: float = VOTE):
    """Every late-delivery model fitted on ``train``; (model, split, order_id, y, s) for each frame.  ``logit``, ``forest`` and
    ``vote`` are the tuned values."""
    bench, out = Bench(train, fs, "y"), []
    logit, forest = logit or {"c": LATE_C}, forest or {}

    def add(model, scored):
        for name, df in scored.items():
            out.append(df.select(F.lit(model).alias("model"), F.lit(name).alias("split"), "order_id", "y", "s"))

    rate = train.agg(F.avg("y").alias("s"))
    base = {n: df.drop("s") for n, df in frames.items()}
    add("dummy (prior)", {n: attach(df, rate) for n, df in base.items()})
    bench.vectors(True), bench.vectors(False)
    kinds = ("logit", "logit_l2", "tree", "forest")
    fits = concurrently(train.sparkSession, [lambda: bench.logistic(None), lambda: bench.logistic(**logit), bench.tree_classifier,
                                             lambda: bench.forest_classifier(**forest)])
    for kind, fitted in zip(kinds, fits):
        add(kind, {n: fitted.score(df, "s").select("order_id", "y", "s") for n, df in base.items()})
    scores = stored(_union(out), "late_scores")
    bench.close()
    one = scores.filter(F.col("model") == "logit_l2").select("split", "order_id", "y", F.col("s").alias("_a"))
    two = scores.filter(F.col("model") == "forest").select("split", "order_id", F.col("s").alias("_b"))
    voted = one.join(two, ["split", "order_id"]).select(
        F.lit("voting (logit + forest)").alias("model"), "split", "order_id", "y",
        (F.lit(vote) * F.col("_a") + F.lit(1 - vote) * F.col("_b")).alias("s"))
    return scores.unionByName(voted)


REG_METRICS = ("mae_rs", "rmse_rs", "r2_rs", "mae_log", "rmse_log", "r2_log")
CLF_METRICS = ("pr_auc", "lift", "roc_auc", "precision", "recall", "f1", "flagged")


def reg_table(scores, keys=("model",)):
    return E.regression_metrics(scores, "reg_target", "pred_log", keys)


def clf_table(scores, keys=("model",)):
    """All models' metrics in one pass of each ranking operator, keyed."""
    keys = list(keys)
    ap = E.average_precision(scores, "y", "s", keys).select(*keys, "pr_auc", "lift")
    auc = E.roc_auc(scores, "y", "s", keys)
    rule = E.threshold_metrics(E.flag_top_share(scores, "s", SHARE, "order_id", keys=keys), "y", "flag", keys)
    return ap.join(auc, keys).join(rule.select(*keys, "precision", "recall", "f1", "flagged"), keys)


def _rounded(df, keys, metrics, digits=4):
    return df.select(*keys, *[r(c, digits).alias(c) for c in metrics])


def _folds(df, k, embargo_days):
    """(fold, train, validate) frames of forward chaining, from one written table."""
    f = stored(E.forward_folds(df, "purchase_ts", "order_id", k, embargo_days), "folds")
    return [(j, *[f.filter((F.col("fold") == j) & (F.col("role") == role)).drop("fold", "role", "block")
                  for role in ("train", "validate")]) for j in range(1, k + 1)]


def item_folds(m):
    """Freight is known at checkout: no embargo."""
    return memo(m, "item_folds", lambda: _folds(item_split(m)[0], FOLDS, 0.0))


def order_folds(m):
    """Late labels are known after 30 days."""
    return memo(m, "order_folds", lambda: _folds(split(m)[0], FOLDS, 30.0))


def freight_test_scores(m):
    train, test = item_split(m)
    return memo(m, "freight_test", lambda: regression_scores(train, {"train": train, "test": test}))


def late_test_scores(m):
    train, test = split(m)
    return memo(m, "late_test", lambda: late_scores(train, {"train": train, "test": test}))


def freight_cv_scores(m):
    return memo(m, "freight_cv", lambda: _union(concurrently(m.spark, [
        lambda j=j, tr=tr, va=va: regression_scores(tr, {f"fold {j}": va}) for j, tr, va in item_folds(m)], 2)))


def late_cv_scores(m):
    return memo(m, "late_cv", lambda: _union(concurrently(m.spark, [
        lambda j=j, tr=tr, va=va: late_scores(tr, {f"fold {j}": va}) for j, tr, va in order_folds(m)], 3)))


@query("mdl_fair_freight_test")
def mdl_fair_freight_test(spark, sf):
    """EXP-11 / MDL-1 / MDL-2 / MDL-4 / MDL-5 / MDL-6 / PRE-1..3 / PRE-6 / MET-1: dummy, linear, ridge, tree, forest (200
    trees) and stacking (3 order-grouped folds, final ridge) on the time hold-out."""
    scores = freight_test_scores(market(spark, sf)).filter(F.col("split") == "test")
    return _rounded(reg_table(scores), ["model"], REG_METRICS)


@query("mdl_late_test")
def mdl_late_test(spark, sf):
    """EXP-11 / MDL-1 / MDL-3 / MDL-4 / MDL-5 / MDL-7 / MDL-8 / PRE-1..3 / PRE-6 / MET-2..5: prior, plain and L2 logistic,
    tree, balanced forest (200 trees) and soft voting on the late-delivery hold-out."""
    scores = late_test_scores(market(spark, sf)).filter(F.col("split") == "test")
    return _rounded(clf_table(scores), ["model"], CLF_METRICS)


def _with_summary(per_fold, metrics):
    """Fold rows, then mean and sample sd of each model (``fold`` says which)."""
    rows = per_fold.select("model", F.col("split").alias("fold"), *metrics)
    g = rows.groupBy("model").agg(*[f(c).alias(f"{n}__{c}") for c in metrics for n, f in (("mean", F.avg), ("sd", F.stddev_samp))])
    parts = [rows] + [g.select("model", F.lit(n).alias("fold"), *[F.col(f"{n}__{c}").alias(c) for c in metrics]) for n in ("mean", "sd")]
    return _rounded(_union(parts), ["model", "fold"], metrics)


@query("exp01_cv_regression")
def exp01_cv_regression(spark, sf):
    """EXP-1 / SPL-2: 5-fold forward-chaining CV of every freight model: all metrics by fold, mean and sd."""
    return _with_summary(reg_table(freight_cv_scores(market(spark, sf)), ["model", "split"]), REG_METRICS)


@query("exp02_cv_classification")
def exp02_cv_classification(spark, sf):
    """EXP-2 / EXP-3: 5-fold forward-chaining CV (30-day embargo) of every late-delivery model: metrics of the top-10%
    rule within each validation block, lift by fold, mean and sd."""
    return _with_summary(clf_table(late_cv_scores(market(spark, sf)), ["model", "split"]), CLF_METRICS)


def draws(grid: dict, n: int, seed: int = 42) -> list[dict]:
    """``n`` candidates of a grid without repeats, in the repeatable order of a hash."""
    every = [dict(zip(grid, v)) for v in itertools.product(*grid.values())]
    return sorted(every, key=lambda c: hashlib.md5(f"{seed}-{c}".encode()).hexdigest())[:n]


def _search(folds, fs, y, candidates, keys, measure, better):
    """Fit every candidate on every fold; log of mean and sd of the score, best first, and who is chosen.
    ``candidates``: (family, params, fit of a bench).  Scores of all candidates of a fold are measured together."""
    name = "pred_log" if y == "reg_target" else "s"

    def fold(j, tr, va):
        bench, va = Bench(tr, fs, y), spread(va.drop("s"))
        bench.vectors(True), bench.vectors(False)
        fits = concurrently(tr.sparkSession, [lambda fit=fit: fit(bench) for _, _, fit in candidates])
        scored = [f.score(va, name).select(F.lit(family).alias("family"), F.lit(params).alias("params"), *keys, y, name)
                  for (family, params, _), f in zip(candidates, fits)]
        got = measure(stored(_union(scored), "search")).withColumn("fold", F.lit(j))
        bench.close()
        return got

    logs = concurrently(folds[0][1].sparkSession, [lambda f=f: fold(*f) for f in folds], 2)
    g = _union(logs).groupBy("family", "params").agg(F.avg("score").alias("score"), F.stddev_samp("score").alias("sd"),
                                                     F.count(F.lit(1)).alias("folds"))
    order = [F.col("score") if better == "low" else F.desc("score"), F.col("params")]
    rank = F.row_number().over(Window.partitionBy("family").orderBy(*order))        # a family's few candidates
    return g.select("family", "params", r("score", 4).alias("score"), r("sd", 4).alias("sd"), "folds", (rank == 1).alias("chosen"))


@query("exp04_grid_search")
def exp04_grid_search(spark, sf, n_iter: int = 8):
    """EXP-4, freight: full grid of the ridge penalty and a random search of the forest (100 trees) over 5
    forward-chaining folds; the search log with mean fold MAE (log scale), sd and the chosen candidate."""
    m = market(spark, sf)
    return freight_search(m, n_iter)


def freight_candidates(n_iter: int) -> list:
    cands = [("ridge", f"alpha={a}", lambda b, a=a: b.ridge_path([a])[0]) for a in ALPHAS]
    cands += [("forest", " ".join(f"{k}={v}" for k, v in c.items()), lambda b, c=c: b.forest_regressor(trees=100, **c))
              for c in draws(FOREST_REG, n_iter)]
    return cands


def freight_search(m, n_iter: int = 8):
    """The log of EXP-4's freight search, made once a session and data folder."""
    def mae(scores):
        return E.regression_metrics(scores, "reg_target", "pred_log", ["family", "params"]).select(
            "family", "params", F.col("mae_log").alias("score"))
    return memo(m, f"freight_search{n_iter}", lambda: stored(
        _search(item_folds(m), FS_A, "reg_target", freight_candidates(n_iter), ITEM_KEYS, mae, "low"), "freight_search"))


def chosen(log) -> dict[str, dict]:
    """The winning values of each family of a search log (a row a family comes back)."""
    return {x["family"]: {k: ast.literal_eval(v) if v[:1] in "0123456789NTF" else v for k, v in (p.split("=") for p in x["params"].split(" "))}
            for x in log.filter("chosen").collect()}


@query("exp04_late_search")
def exp04_late_search(spark, sf, n_iter: int = 20):
    """EXP-4 / MDL-7, late delivery: grid of C x class weight, random search of the forest (100 trees), then the
    voting weight of the two winners; scored by PR-AUC lift over 5 forward-chaining folds."""
    return late_search(market(spark, sf), n_iter)


def late_search(m, n_iter: int = 20):
    """The log of EXP-4's late-delivery searches, made once a session and data folder."""
    logit = [("logit_l2", f"C={c} balanced={b}", lambda x, c=c, b=b: x.logistic(c, b)) for c in LOGIT_C for b in (False, True)]
    forest = [("forest", " ".join(f"{k}={v}" for k, v in c.items()), lambda x, c=c: x.forest_classifier(trees=100, **c))
              for c in draws(FOREST_CLF, n_iter)]

    def lift(scores):
        return E.average_precision(scores, "y", "s", ["family", "params"]).select("family", "params", F.col("lift").alias("score"))

    def votes(best, tr, va):
        bench, va = Bench(tr, FS_B, "y"), va.drop("s")
        both = best["forest"][2](bench).score(best["logit_l2"][2](bench).score(va, "_a"), "_b")
        got = lift(stored(both.select("order_id", "y", F.explode(F.array(*[F.struct(
            F.lit("voting").alias("family"), F.lit(f"w_logit={w}").alias("params"), (w * F.col("_a") + (1 - w) * F.col("_b")).alias("s"))
            for w in VOTE_WEIGHTS])).alias("v")).select("order_id", "y", "v.*"), "votes"))
        bench.close()
        return got

    def build():
        log = stored(_search(order_folds(m), FS_B, "y", logit + forest, ["order_id"], lift, "high"), "search")
        won = {x["family"]: x["params"] for x in log.filter("chosen").collect()}     # two rows
        best = {f: next(c for c in logit + forest if (c[0], c[1]) == (f, p)) for f, p in won.items()}
        logs = concurrently(m.spark, [lambda tr=tr, va=va: votes(best, tr, va) for _, tr, va in order_folds(m)], 3)
        g = _union(logs).groupBy("family", "params").agg(F.avg("score").alias("score"), F.stddev_samp("score").alias("sd"),
                                                         F.count(F.lit(1)).alias("folds"))
        rank = F.row_number().over(Window.partitionBy("family").orderBy(F.desc("score"), "params"))
        return stored(log.unionByName(g.select("family", "params", r("score", 4).alias("score"), r("sd", 4).alias("sd"), "folds",
                                               (rank == 1).alias("chosen"))), "late_search")
    return memo(m, f"late_search{n_iter}", build)


@query("exp11_tuned_freight")
def exp11_tuned_freight(spark, sf):
    """EXP-11 / MDL-2 / MDL-5 / MDL-6, freight: every model with the values that EXP-4's search chose, on the time hold-out."""
    m = market(spark, sf)
    best = chosen(freight_search(m))
    train, test = item_split(m)
    scores = regression_scores(train, {"test": test}, alpha=best["ridge"]["alpha"], forest=best["forest"])
    return _rounded(reg_table(scores), ["model"], REG_METRICS)


@query("exp11_tuned_late")
def exp11_tuned_late(spark, sf):
    """EXP-11 / MDL-3 / MDL-5 / MDL-7, late delivery: every model with the values (C, class weights, forest, voting weight)
    that EXP-4's searches chose, on the time hold-out."""
    m = market(spark, sf)
    train, test = split(m)
    scores = late_scores(train, {"test": test}, **tuned_late(m))
    return _rounded(clf_table(scores), ["model"], CLF_METRICS)


def tuned_late(m) -> dict:
    best = chosen(late_search(m))
    return {"logit": {"c": best["logit_l2"]["C"], "balanced": best["logit_l2"]["balanced"]}, "forest": best["forest"],
            "vote": best["voting"]["w_logit"]}


@query("spl05_rolling_refit")
def spl05_rolling_refit(spark, sf):
    """SPL-5: rolling-origin evaluation.  For each of four windows every late-delivery model is fitted again on all orders
    before the window (minus the embargo) and measured in it: PR-AUC, lift, ROC-AUC, precision and recall of the riskiest
    10%, and the low-review (1-2 stars) rates of flagged and other orders with a review."""
    m = market(spark, sf)
    windows = stored(E.rolling_windows(scored_orders(m), "purchase_ts", [0.5, 0.6, 0.7, 0.8], 30.0).drop("s", "start", "end"), "windows")
    low = m.reviews.groupBy("order_id").agg(
        (F.max_by("review_score", F.struct("review_creation_date", "review_id")) <= 2).cast("int").alias("low"))

    def refit(w):
        tr, te = (windows.filter((F.col("window") == w) & (F.col("role") == role)).drop("window", "role") for role in ("train", "test"))
        return late_scores(tr, {f"W{w}": te})

    scores = _union(concurrently(spark, [lambda w=w: refit(w) for w in range(1, 5)], 2)).withColumnRenamed("split", "window")
    scores = stored(scores, "window_scores")
    keys = ["window", "model"]
    flagged = E.flag_top_share(scores, "s", SHARE, "order_id", keys=keys).join(low, "order_id", "left")
    rates = flagged.groupBy(*keys).agg(
        F.avg(F.when(F.col("flag") == 1, F.col("low"))).alias("low_rate_flagged"),
        F.avg(F.when(F.col("flag") == 0, F.col("low"))).alias("low_rate_not_flagged"),
        F.try_divide(F.sum(F.when(F.col("flag") == 1, F.col("low"))), F.sum("low")).alias("share_low_flagged"))
    sizes = windows.groupBy(F.concat(F.lit("W"), F.col("window")).alias("window")).agg(
        F.sum((F.col("role") == "train").cast("long")).alias("train_orders"), F.sum((F.col("role") == "test").cast("long")).alias("test_orders"),
        F.avg(F.when(F.col("role") == "test", F.col("y"))).alias("late_rate"))
    table = clf_table(scores, keys).join(rates, keys).join(F.broadcast(sizes), "window")        # four rows
    metrics = ["late_rate", "pr_auc", "lift", "roc_auc", "precision", "recall", "low_rate_flagged", "low_rate_not_flagged", "share_low_flagged"]
    return table.select(*keys, "train_orders", "test_orders", *[r(c, 4).alias(c) for c in metrics])


@query("exp05_ablation_regression")
def exp05_ablation_regression(spark, sf):
    """EXP-5 / PRE-4: every nested feature set (the last one target-encoded, cross-fitted) with a fixed forest (100 trees)
    on the 5 forward folds: metrics, paired gain in MAE over the previous set, its mean and sd."""
    def one(i, name, fs, j, tr, va):
        bench = Bench(tr, fs, "reg_target")
        scored = bench.forest_regressor(trees=100).score(spread(va), "pred_log")
        got = stored(E.regression_metrics(scored, "reg_target", "pred_log").select(
            F.lit(i).alias("step"), F.lit(name).alias("feature_set"), F.lit(j).alias("fold"), "mae_rs", "rmse_rs", "r2_rs"), "ablation")
        bench.close()
        return got

    folds = item_folds(market(spark, sf))
    parts = concurrently(spark, [lambda a=(i, name, fs, *f): one(*a) for f in folds for i, (name, fs) in enumerate(FS_REG.items())])
    u = _union(parts)
    u = u.withColumn("gain", F.lag("mae_rs").over(Window.partitionBy("fold").orderBy("step")) - F.col("mae_rs"))
    return u.groupBy("step", "feature_set").agg(*[r(F.avg(c), 4).alias(c) for c in ("mae_rs", "rmse_rs", "r2_rs", "gain")],
                                                r(F.stddev_samp("gain"), 4).alias("gain_sd"))


@query("exp06_forward_selection")
def exp06_forward_selection(spark, sf):
    """EXP-6: forward selection of the six feature groups for the late-delivery model, from the promise alone, with both
    families (L2 logistic C = 0.1 and a regularised balanced forest) on 5 forward folds.  A group stays when its paired
    gain in lift exceeds the gain's sd for one family; a group rejected before a later one was kept is tried once more.
    The folds' lifts come back as a few numbers a candidate; the decision is arithmetic on them."""
    m = market(spark, sf)
    # the loads of the congestion group are joined to the fold rows once
    loads = order_features(m).select("order_id", "platform_surge_7d", "seller_load_7d")
    folds = [(j, *[stored(df.join(loads, "order_id", "left"), "fold") for df in (tr, va.drop("s"))]) for j, tr, va in order_folds(m)]

    def lifts(fs):
        def fold(j, tr, va):
            bench, parts = Bench(tr, fs, "y"), []
            for family, fitted in (("logit", bench.logistic(0.1)),
                                   ("forest", bench.forest_classifier(trees=100, leaf=50, share=0.3, depth=10))):
                parts.append(fitted.score(va, "s").select(F.lit(family).alias("family"), F.lit(j).alias("fold"), "order_id", "y", "s"))
            rows = stored(_union(parts), "lifts")
            bench.close()
            return rows

        parts = concurrently(spark, [lambda f=f: fold(*f) for f in folds], FOLDS)
        got = E.average_precision(_union(parts), "y", "s", ["family", "fold"]).collect()     # 10 rows
        return {f: [x["lift"] for x in sorted(got, key=lambda x: x["fold"]) if x["family"] == f] for f in ("logit", "forest")}

    kept, rows = FeatureSet(num=["promised_days"]), []
    base = lifts(kept)

    def note(name, state, now, gains):
        rows.append((name, state, *[v for f in ("logit", "forest") for v in (
            statistics.fmean(now[f]), statistics.fmean(gains[f]), statistics.stdev(gains[f]))]))

    def attempt(name, group):
        nonlocal kept, base
        cand = kept.merge(group)
        now = lifts(cand)
        gains = {f: [a - b for a, b in zip(now[f], base[f])] for f in now}
        stays = any(statistics.fmean(g) > statistics.stdev(g) for g in gains.values())
        note(name, "kept" if stays else "dropped", now, gains)
        if stays:
            kept, base = cand, now

    note("promise (start)", "start", base, {f: [0.0] * FOLDS for f in base})
    for name, group in LATE_GROUPS.items():
        attempt(name, group)
    last = max((i for i, x in enumerate(rows) if x[1] == "kept"), default=0)
    for i, (name, group) in enumerate(LATE_GROUPS.items(), 1):
        if rows[i][1] == "dropped" and i < last:
            attempt(f"re-check: {name}", group)
    cols = [f"{f}_{c}" for f in ("logit", "forest") for c in ("lift", "gain", "gain_sd")]
    schema = "step int, feature_group string, state string, " + ", ".join(f"{c} double" for c in cols)
    return spark.createDataFrame([(i, *x[:2], *[round(v, 4) for v in x[2:]]) for i, x in enumerate(rows)], schema)


@query("exp10_train_cv_test")
def exp10_train_cv_test(spark, sf):
    """EXP-10: train / CV / test comparison of every model of both problems (from the scores of EXP-1, EXP-2, EXP-11)."""
    m = market(spark, sf)
    out = []
    for problem, held, cv, tab, metrics in (("freight", freight_test_scores(m), freight_cv_scores(m), reg_table, ("mae_rs", "r2_rs")),
                                            ("late", late_test_scores(m), late_cv_scores(m), clf_table, ("lift", "roc_auc"))):
        whole = tab(held, ["model", "split"]).select("model", "split", *metrics)
        folds = tab(cv, ["model", "split"]).groupBy("model").agg(F.lit("cv").alias("split"), *[F.avg(c).alias(c) for c in metrics])
        both = whole.unionByName(folds.select("model", "split", *metrics))
        out.append(both.select(F.lit(problem).alias("problem"), "model", "split", F.explode(F.array(*[
            F.struct(F.lit(c).alias("metric"), r(c, 4).alias("value")) for c in metrics])).alias("e")).select(
            "problem", "model", "split", "e.metric", "e.value"))
    return _union(out)


def permutation_drops(fitted: Fitted, test, columns, id_col, y, score, measure, repeats):
    """Mean and sd of how much worse ``measure`` (small is bad) gets when a raw column is shuffled: rows in one md5 order are
    joined to values in another, ``repeats`` times a column.  All shuffles are scored and measured in one pass."""
    keyed = stored(global_running(test.select(id_col, y, *columns, E.tie_key(id_col, 1).alias("_h")), ["_h", id_col],
                                  index_col="_place").drop("_h", "_total_n"), "keyed")
    parts = [keyed.withColumn("_what", F.lit("")).withColumn("_turn", F.lit(0))]
    for turn in range(1, repeats + 1):
        donor = global_running(test.select(*columns, id_col, E.tie_key(id_col, 100 + turn).alias("_h")), ["_h", id_col],
                               index_col="_place").drop("_h", "_total_n", id_col)
        pairs = stored(keyed.join(donor.select("_place", *[F.col(c).alias(f"_v_{c}") for c in columns]), "_place"), "pairs")
        for c in columns:
            parts.append(pairs.withColumn(c, F.col(f"_v_{c}")).drop(*[f"_v_{x}" for x in columns])
                         .withColumn("_what", F.lit(c)).withColumn("_turn", F.lit(turn)))
    scored = stored(fitted.score(spread(_union(parts)), score).select("_what", "_turn", id_col, y, score), "shuffled")
    got = measure(scored).select("_what", "_turn", F.col("m"))
    drop = attach(got.filter(F.col("_turn") > 0), got.filter(F.col("_turn") == 0).agg(F.max("m").alias("_base"))).withColumn(
        "drop", F.col("_base") - F.col("m"))
    return drop.groupBy(F.col("_what").alias("column")).agg(r(F.avg("drop"), 6).alias("importance"), r(F.stddev_pop("drop"), 6).alias("sd"),
                                                            F.count(F.lit(1)).alias("repeats"))


@query("exp12_permutation_importance")
def exp12_permutation_importance(spark, sf, repeats: int = 5):
    """EXP-12: permutation importance on every raw column in the test window, of the L2 logistic model (drop in PR-AUC) and
    of the freight forest (rise in MAE on the log scale): mean and sd of ``repeats`` shuffles."""
    m = market(spark, sf)
    late = permutation_drops(late_model(m), split(m)[1].drop("s"), FS_B.inputs, "order_id", "y", "s", lambda x: E.average_precision(
        x, "y", "s", ["_what", "_turn"]).withColumnRenamed("pr_auc", "m"), repeats)
    train, test = item_split(m)
    bench = Bench(train, FS_A, "reg_target")
    forest = bench.forest_regressor()
    bench.close()
    test = test.withColumn("_line", F.concat_ws("-", *ITEM_KEYS))
    freight = permutation_drops(forest, test, FS_A.inputs, "_line", "reg_target", "pred_log", lambda x: x.groupBy("_what", "_turn").agg(
        (-F.avg(F.abs(F.col("reg_target") - F.col("pred_log")))).alias("m")), repeats)
    return late.select(F.lit("late").alias("problem"), "*").unionByName(freight.select(F.lit("freight").alias("problem"), "*"))


_TARIFF_SQL = """
WITH med AS (SELECT median(chargeable_kg) AS m1, median(distance_km / 100) AS m2, median(same_state) AS m3 FROM f_itrain),
tr AS (SELECT coalesce(chargeable_kg, m1) AS a, coalesce(distance_km / 100, m2) AS b, coalesce(same_state, m3)::DOUBLE AS c,
              freight_value AS y FROM f_itrain, med),
te AS (SELECT coalesce(chargeable_kg, m1) AS a, coalesce(distance_km / 100, m2) AS b, coalesce(same_state, m3)::DOUBLE AS c,
              freight_value AS y FROM f_itest, med),
s AS (SELECT covar_pop(a, a) AS aa, covar_pop(a, b) AS ab, covar_pop(a, c) AS ac, covar_pop(b, b) AS bb, covar_pop(b, c) AS bc,
             covar_pop(c, c) AS cc, covar_pop(a, y) AS ay, covar_pop(b, y) AS byy, covar_pop(c, y) AS cy, avg(a) AS ma, avg(b) AS mb,
             avg(c) AS mc, avg(y) AS my FROM tr),
d AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM s),
w AS (SELECT *, (ay * (bb * cc - bc * bc) - ab * (byy * cc - bc * cy) + ac * (byy * bc - bb * cy)) / det AS w1,
             (aa * (byy * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - byy * ac)) / det AS w2,
             (aa * (bb * cy - byy * bc) - ab * (ab * cy - byy * ac) + ay * (ab * bc - bb * ac)) / det AS w3 FROM d),
f AS (SELECT *, my - w1 * ma - w2 * mb - w3 * mc AS w0 FROM w)
SELECT round_even(max(w0), 4) AS intercept, round_even(max(w1), 4) AS per_kg, round_even(max(w2), 4) AS per_100km,
       round_even(max(w3), 4) AS same_state,
       round_even(avg(abs(te.y - greatest(w0 + w1 * te.a + w2 * te.b + w3 * te.c, 0))), 4) AS test_mae
FROM te, f
"""


@query("sta08_linear_tariff", _TARIFF_SQL)
def sta08_linear_tariff(spark, sf):
    """STA-8: linear tariff by least squares (intercept + per kg + per 100 km + same state) on median-imputed
    training lines; coefficients and the test MAE (clipped at 0)."""
    train, test = [df.withColumn("km100", F.col("distance_km") / 100) for df in item_split(market(spark, sf))]
    prep, x = fit_prep(train, FeatureSet(num=["chargeable_kg", "km100", "same_state"]), "freight_value", linear=False)
    prep.missing = []                                      # the tariff has no indicator terms
    fit = LinearRegression(regParam=0.0, labelCol="freight_value", solver="normal").fit(prep.transform(train))
    p = fit.transform(prep.transform(test)).withColumn("p", F.greatest(F.col("prediction"), F.lit(0.0)))
    return p.agg(r(F.lit(fit.intercept), 4).alias("intercept"), *[
        r(F.lit(float(v)), 4).alias(n) for n, v in zip(("per_kg", "per_100km", "same_state"), fit.coefficients.toArray())],
        r(F.avg(F.abs(F.col("freight_value") - F.col("p"))), 4).alias("test_mae"))


@query("sta09_baseline_regression", """
WITH i AS (SELECT order_id, ln(1 + freight_value) AS y, ln(1 + distance_km) AS a, ln(1 + weight_kg) AS b, freight_value AS v,
                  ('0x' || substr(md5(CAST(order_id AS VARCHAR) || '-42'), 1, 8))::BIGINT % 5 AS fold
           FROM f_items_full WHERE distance_km IS NOT NULL AND weight_kg > 0),
s AS (SELECT covar_pop(a, a) AS aa, covar_pop(a, b) AS ab, covar_pop(b, b) AS bb, covar_pop(a, y) AS ay, covar_pop(b, y) AS byy,
             avg(a) AS ma, avg(b) AS mb, avg(y) AS my, median(v) AS med FROM i WHERE fold <> 0),
w AS (SELECT *, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS w1, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS w2 FROM s),
p AS (SELECT i.y, i.v, w.med, (my - w1 * ma - w2 * mb) + w1 * i.a + w2 * i.b AS p FROM i, w WHERE fold = 0)
SELECT round_even(quantile_cont(y - p, 0.05), 4) AS res_p05, round_even(quantile_cont(y - p, 0.95), 4) AS res_p95,
       round_even(avg(abs(v - (exp(p) - 1))), 4) AS model_mae, round_even(avg(abs(v - med)), 4) AS median_baseline_mae
FROM p
""")
def sta09_baseline_regression(spark, sf):
    """STA-9 / SPL-3: log freight on log distance and log weight, fitted on a hash-grouped 80% of orders;
    residual p5 / p95 and MAE against the naive median baseline on the other 20%."""
    it = market(spark, sf).items_full.filter(F.col("distance_km").isNotNull() & (F.col("weight_kg") > 0))
    it = it.select("order_id", F.log1p("freight_value").alias("y"), F.log1p("distance_km").alias("ld"),
                   F.log1p("weight_kg").alias("lw"), "freight_value").withColumn("fold", E.hash_fold("order_id", 5))
    tr, te = it.filter(F.col("fold") != 0), it.filter(F.col("fold") == 0)
    va = VectorAssembler(inputCols=["ld", "lw"], outputCol="features")
    fit = LinearRegression(labelCol="y", solver="normal").fit(va.transform(tr))
    p = fit.transform(va.transform(te)).withColumn("res", F.col("y") - F.col("prediction"))
    q = exact_quantiles(p, {"p05": ("res", 0.05), "p95": ("res", 0.95)})
    med = exact_quantiles(tr, {"_med": ("freight_value", 0.5)})
    mae = attach(p, med).agg(r(F.avg(F.abs(F.col("freight_value") - F.expm1("prediction"))), 4).alias("model_mae"),
                             r(F.avg(F.abs(F.col("freight_value") - F.col("_med"))), 4).alias("median_baseline_mae"))
    return attach(mae, q).select(r("p05", 4).alias("res_p05"), r("p95", 4).alias("res_p95"), "model_mae", "median_baseline_mae")


@query("spl07_random_vs_time")
def spl07_random_vs_time(spark, sf):
    """SPL-7: the same models under different hold-outs.  Freight (ridge, forest): order-grouped, product-grouped (unseen
    listings) and time-ordered.  Late delivery (L2 logistic, forest): customer-grouped random and time-ordered."""
    m = market(spark, sf)
    out = []
    items = item_features(m)
    splits = {f"{g}-grouped": tuple(items.withColumn("_f", E.hash_fold(c, 5)).filter(cond).drop("_f") for cond in (F.col("_f") != 0, F.col("_f") == 0))
              for g, c in (("order", "order_id"), ("product", "product_id"))} | {"time-ordered": item_split(m)}

    def freight_parts(name, tr, te):
        bench = Bench(tr, FS_A, "reg_target")
        te = spread(te)
        parts = [fit.score(te, "pred_log").select(F.lit(k).alias("model"), F.lit(name).alias("split"), "reg_target", "pred_log")
                 for k, fit in (("ridge", bench.ridge_path([RIDGE_ALPHA])[0]), ("forest", bench.forest_regressor()))]
        got = stored(_union(parts), "scores")
        bench.close()
        return got

    out = concurrently(spark, [lambda n=n, f=f: freight_parts(n, *f) for n, f in splits.items()])
    freight = _rounded(reg_table(_union(out), ["model", "split"]), ["model", "split"], ("mae_rs", "r2_rs"))
    orders = order_features(m, with_loads=False).withColumn("y", F.col("clf_target")).withColumn("_f", E.hash_fold("customer_unique_id", 5))
    splits = {"customer-grouped": (orders.filter(F.col("_f") != 0), orders.filter(F.col("_f") == 0)), "time-ordered": split(m)}
    out = []
    for name, (tr, te) in splits.items():
        bench, te = Bench(tr, FS_B, "y"), te.drop("s")
        parts = [fit.score(te, "s").select(F.lit(k).alias("model"), F.lit(name).alias("split"), "order_id", "y", "s")
                 for k, fit in (("logit_l2", bench.logistic(LATE_C)), ("forest", bench.forest_classifier()))]
        out.append(stored(_union(parts), "scores"))
        bench.close()
    late = _rounded(clf_table(_union(out), ["model", "split"]), ["model", "split"], ("lift", "roc_auc"))
    none = F.lit(None).cast("double")
    return freight.select(F.lit("freight").alias("problem"), "model", "split", "mae_rs", "r2_rs", none.alias("lift"), none.alias("roc_auc")) \
        .unionByName(late.select(F.lit("late").alias("problem"), "model", "split", none.alias("mae_rs"), none.alias("r2_rs"), "lift", "roc_auc"))


def late_model(m) -> Fitted:
    """The L2 logistic late-delivery model, fitted once per session and data folder."""
    def build():
        bench = Bench(split(m)[0], FS_B, "y")
        fitted = bench.logistic(LATE_C)
        bench.close()
        return fitted
    return memo(m, "late_model", build)


# Input groups and the follow-up suggested for each.
DRIVER_GROUP = {"promised_days": "promise", "distance_km": "route", "same_state": "route", "seller_state": "route",
                "customer_state": "route", "price_total": "order", "freight_total": "order", "freight_ratio": "order",
                "n_items": "order", "n_sellers": "order"}
ACTIONS = {"promise": "Update the delivery estimate", "route": "Check carrier tracking",
           "order": "Confirm dispatch with seller", None: "Send a tracking update"}
ACTION_GROUPS = ["order", "promise", "route"]


def explained(fitted: Fitted, df, reference):
    """SCO-4: ``risk``, ``log_odds`` and a contribution ``d_<input>`` of every input to the log-odds, against the average
    row of ``reference`` (one-hot slots summed per input).  log_odds minus the contributions is the same for all rows."""
    x = fitted.prep.transform(df)
    owner = slot_inputs(x, fitted.prep.fs)
    coef = [float(v) for v in fitted.model.coefficients.toArray()]
    if len(owner) != len(coef):
        raise ValueError("the vector's slots and the model's coefficients differ")
    at = vector_to_array(F.col("features"))
    ref = fitted.prep.transform(reference).select(at.alias("v")).select(F.posexplode("v").alias("i", "v")).groupBy("i").agg(
        F.avg("v").alias("v")).agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("_ref"))      # one row per slot
    scored = fitted.model.transform(x).select("*", at.alias("_f"), vector_to_array(F.col("rawPrediction")).getItem(1).alias("log_odds"),
                                              vector_to_array(F.col("probability")).getItem(1).alias("risk"))
    scored = attach(scored, ref.select(F.transform("_ref", lambda z: z["v"]).alias("_ref")))
    parts = {c: sum((F.lit(coef[i]) * (F.get("_f", F.lit(i)) - F.get("_ref", F.lit(i))) for i, o in enumerate(owner) if o == c), F.lit(0.0))
             for c in fitted.prep.fs.inputs}
    return scored.withColumns({f"d_{c}": v for c, v in parts.items()}).drop(
        "features", "rawPrediction", "probability", "prediction", "_f", "_ref")


def suggested(x, inputs):
    """SCO-5: top driver (largest positive push) and the follow-up of the group that pushes most; ties go to the first."""
    groups = {g: sum((F.col(f"d_{c}") for c in inputs if DRIVER_GROUP.get(c, "order") == g), F.lit(0.0)) for g in ACTION_GROUPS}
    best, action = F.greatest(*groups.values()), F.lit(ACTIONS[None])
    for g in reversed(ACTION_GROUPS):
        action = F.when((groups[g] == best) & (best > 0), F.lit(ACTIONS[g])).otherwise(action)
    push, top = F.greatest(*[F.col(f"d_{c}") for c in inputs]), F.lit(None).cast("string")
    for c in reversed(inputs):
        top = F.when((F.col(f"d_{c}") == push) & (push > 0), F.lit(c)).otherwise(top)
    return x.withColumns({"suggested_follow_up": action, "top_driver": top})


def late_scoring(m, share: float = SHARE):
    """SCO-2..5 for every hold-out order: risk, percentile, list flag, contributions, top driver and follow-up."""
    test = split(m)[1].drop("s")
    fitted = late_model(m)
    x = stored(suggested(explained(fitted, test, test), FS_B.inputs).select(
        "order_id", "risk", "log_odds", *[f"d_{c}" for c in FS_B.inputs], "suggested_follow_up", "top_driver"), "late_scoring")
    ref = exact_quantiles(x, {f"q{k}": ("risk", k / 100.0) for k in range(101)}).select(F.array(*[f"q{k}" for k in range(101)]).alias("qs"))
    y = attach(x, ref)
    i = F.size(F.filter("qs", lambda v: v <= F.col("risk")))
    lo, hi = F.get("qs", i - 1), F.get("qs", i)
    pct = (F.when(i == 0, F.lit(0.0)).when(i >= 101, F.lit(100.0)).when(hi == lo, i - 1.0)
           .otherwise((i - 1) + F.try_divide(F.col("risk") - lo, hi - lo)))
    y = y.withColumn("percentile", pct).drop("qs")
    return y.withColumn("on_review_list", F.col("percentile") >= 100 * (1 - share))


@query("sco02_late_scoring")
def sco02_late_scoring(spark, sf):
    """SCO-2 / SCO-3 / SCO-4 / SCO-5: bulk late-risk scoring of the hold-out orders: one row each with risk, percentile
    against 101 reference quantiles, list flag, contributions of every input against the average hold-out order, top
    driver and suggested follow-up."""
    y = late_scoring(market(spark, sf))
    return y.select("order_id", r("risk", 6).alias("risk"), r("percentile", 4).alias("percentile"), "on_review_list",
                    *[r(f"d_{c}", 6).alias(f"d_{c}") for c in FS_B.inputs], "top_driver", "suggested_follow_up")


@query("sco01_freight_scoring")
def sco01_freight_scoring(spark, sf):
    """SCO-1: bulk fair-freight scoring of valid records: forest and ridge estimates, literal tariff, quote range (fair
    freight +/- the test MAE of the item's price band), verdicts of the overall and the per-band rule (AUD-2 cut-offs on
    the model residuals) and the inputs outside the training range; one row per scored line."""
    from .q_audit import audit_frame, verdict
    from .q_features import tariff
    from .q_scoring import _states, drift_flags, drift_stats, freight_records, level_counts, validate
    m = market(spark, sf)
    train, test = item_split(m)
    valid, _ = validate(freight_records(m), _states(m))
    rec = test.join(valid.select(*ITEM_KEYS), ITEM_KEYS, "left_semi")
    bench = Bench(train, FS_A, "reg_target")
    scored = bench.ridge(RIDGE_ALPHA).score(bench.forest_regressor().score(rec, "pf"), "pr")
    scored = stored(scored.withColumn("tariff", tariff("chargeable_kg", "distance_km", "same_state")), "scored")
    bench.close()
    fair, fair_r = (F.greatest(F.expm1(c), F.lit(0.0)) for c in ("pf", "pr"))
    a = audit_frame(scored, fair, fair_r)
    mae = a.groupBy("band").agg(F.avg(F.abs(F.col("freight_value") - F.col("est_a"))).alias("band_mae"))
    d = drift_flags(a.join(F.broadcast(mae), "band"), drift_stats(train), level_counts(train))      # one row per price band
    return d.select(*ITEM_KEYS, r("est_a", 4).alias("fair_freight"), r("est_b", 4).alias("fair_freight_check"), r("tariff", 4).alias("tariff"),
                    r(F.greatest(F.col("est_a") - F.col("band_mae"), F.lit(0.0)), 4).alias("quote_low"),
                    r(F.col("est_a") + F.col("band_mae"), 4).alias("quote_high"), "band", r("band_mae", 4).alias("band_mae"),
                    verdict("fo_a", "fo_b").alias("verdict"), verdict("fb_a", "fb_b").alias("band_verdict"),
                    F.array_join(F.array_sort("drift_inputs"), ",").alias("drift_inputs"))


@query("mdl09_save_load")
def mdl09_save_load(spark, sf):
    """MDL-9 / SCO-11: the late-delivery pipeline (preprocessing, model and metadata) saved to the shared folder, loaded
    back, and both versions' scores of the raw hold-out rows compared (rows, largest difference)."""
    m = market(spark, sf)
    test = split(m)[1].drop("s")
    fitted = late_model(m)
    path = f"{checkpoint_dir(spark)}/models/late-{uuid.uuid4().hex}"
    fitted.save(spark, path)
    loaded = Fitted.load(spark, path)
    a = fitted.score(test, "s1").select("order_id", "s1")
    b = loaded.score(test, "s2").select("order_id", "s2")
    return a.join(b, "order_id").agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("s1") - F.col("s2"))).alias("max_abs_diff"))
