"""Splits, ranking metrics and decision rules (SPL, MET, TOP-2/3, WIN-10/12/13).

All of them work on DataFrames with a label ``y`` (0/1) and a score ``s``.
Ranking metrics aggregate by distinct score first (partial aggregation), then
take running sums over the distinct-score table with :func:`global_running`,
so neither the rows nor a hot group ever sit in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import r
from .ranking import attach, exact_quantile, exact_quantiles, global_running

DAY_S = 86400.0


def tie_key(id_col: str, seed: int = 42):
    """Repeatable pseudo-random tie order (md5 of id and seed), the same in Spark and in SQL engines."""
    return F.md5(F.concat_ws("-", F.col(id_col).cast("string"), F.lit(str(seed))))


def hash_fold(id_col: str, k: int, seed: int = 42):
    """SPL-3: fold of a group key = first 32 bits of md5(key-seed) mod k; all rows of a group share it."""
    return (F.conv(F.substring(tie_key(id_col, seed), 1, 8), 16, 10).cast("long") % k).cast("int")


# ---------------------------------------------------------------- splits
def time_holdout(df: DataFrame, ts: str = "purchase_ts", test_frac: float = 0.2, embargo_days: float = 30.0):
    """SPL-1: test = after the (1 - f) quantile of time, train = up to the cut minus the embargo."""
    cut = exact_quantile(df, ts, 1 - test_frac, "_cut")
    j = attach(df, cut)
    test = j.filter(F.col(ts) > F.col("_cut")).drop("_cut")
    train = j.filter(F.col(ts) <= F.col("_cut") - F.lit(embargo_days * DAY_S)).drop("_cut")
    return train, test


def time_blocks(df: DataFrame, ts: str, id_col: str, n_blocks: int) -> DataFrame:
    """WIN-13: equal-size consecutive time blocks (larger blocks first, as ``array_split`` / ``ntile``),
    from the two-phase global row number over (time, id)."""
    g = global_running(df, [ts, id_col], index_col="_pos")
    p = F.col("_pos") - 1
    n = F.col("_total_n")
    q = F.floor(n / n_blocks)
    rem = n - q * n_blocks
    big = rem * (q + 1)
    block = F.when(p < big, F.floor(p / (q + 1))).otherwise(rem + F.floor((p - big) / q))
    return g.withColumn("block", block.cast("int")).drop("_pos", "_total_n")


def forward_folds(df: DataFrame, ts: str, id_col: str, k: int = 5, embargo_days: float = 30.0) -> DataFrame:
    """SPL-2: forward-chaining folds over k + 1 time blocks; fold j trains on blocks < j minus the embargo
    before block j's first time and validates on block j.  Returns rows tagged (fold, role)."""
    b = time_blocks(df, ts, id_col, k + 1)
    starts = b.groupBy("block").agg(F.min(ts).alias("_start"))
    folds = starts.filter(F.col("block") >= 1).select(F.col("block").alias("fold"), "_start")
    # each row meets at most k folds: explode the fold numbers it can belong to, then join the fold starts
    rows = b.select("*", F.explode(F.sequence(F.greatest(F.col("block"), F.lit(1)), F.lit(k))).alias("fold"))
    j = rows.join(F.broadcast(folds), "fold")
    role = (F.when(F.col("block") == F.col("fold"), F.lit("validate"))
            .when((F.col("block") < F.col("fold")) & (F.col(ts) < F.col("_start") - F.lit(embargo_days * DAY_S)),
                  F.lit("train")))
    return j.withColumn("role", role).filter(F.col("role").isNotNull()).drop("_start")


def rolling_windows(df: DataFrame, ts: str, starts_q: Sequence[float], embargo_days: float = 30.0) -> DataFrame:
    """SPL-5: rolling-origin windows; window w tests on (start_w, start_{w+1}] (the last up to the latest
    time) and trains on everything up to start_w minus the embargo.  Starts are time quantiles."""
    st = exact_quantiles(df, {f"s{i}": (ts, q) for i, q in enumerate(starts_q)})
    st = attach(st, df.agg(F.max(ts).alias("_end")))
    nw = len(starts_q)
    windows = st.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("window"), F.col(f"s{i}").alias("start"),
                 (F.col(f"s{i + 1}") if i + 1 < nw else F.col("_end")).alias("end")) for i in range(nw)]))
        .alias("w")).select("w.*")
    # every row may belong to each window once (as train or test): explode the window ids, equi-join the
    # small broadcast window table, then keep the rows that fall in a role
    j = (df.select("*", F.explode(F.sequence(F.lit(1), F.lit(nw))).alias("window"))
         .join(F.broadcast(windows), "window").filter(F.col(ts) <= F.col("end")))
    role = (F.when(F.col(ts) > F.col("start"), F.lit("test"))
            .when(F.col(ts) <= F.col("start") - F.lit(embargo_days * DAY_S), F.lit("train")))
    return j.withColumn("role", role).filter(F.col("role").isNotNull())


# ---------------------------------------------------------------- decision rules
def flag_top_share(df: DataFrame, score: str, share: float, id_col: str, seed: int = 42,
                   keys: Sequence[str] = (), flag: str = "flag") -> DataFrame:
    """TOP-2 / TOP-3: flag the round-half-even(share x n) highest scores (within ``keys``), score ties
    broken by a repeatable md5 order.  Ranks come from the two-phase running count."""
    d = df.withColumn("_tie", tie_key(id_col, seed))
    g = global_running(d, [F.desc(score), F.desc("_tie")], keys=keys, index_col="_rank")
    k = r(F.col("_total_n") * F.lit(float(share)), 0)
    return g.withColumn(flag, (F.col("_rank") <= k).cast("int")).drop("_tie", "_total_n")


# ---------------------------------------------------------------- ranking metrics
def _score_table(df: DataFrame, y: str, s: str, keys: Sequence[str], descending: bool) -> DataFrame:
    g = df.groupBy(*keys, s).agg(F.sum(F.col(y).cast("long")).alias("_pos"), F.count(F.lit(1)).alias("_cnt"))
    g = g.withColumn("_neg", F.col("_cnt") - F.col("_pos"))
    return global_running(g, [F.desc(s) if descending else F.asc(s)],
                          {"_tp": "_pos", "_cn": "_cnt", "_fp": "_neg"}, keys=keys)


def average_precision(df: DataFrame, y: str = "y", s: str = "s", keys: Sequence[str] = ()) -> DataFrame:
    """MET-2 / MET-3: average precision as the step sum over distinct thresholds, sum_k (R_k - R_{k-1}) P_k,
    and its lift over the positive rate."""
    t = _score_table(df, y, s, keys, True)
    return t.groupBy(*keys).agg(
        F.sum(F.try_divide(F.col("_pos"), F.col("_total__tp")) * F.col("_tp") / F.col("_cn")).alias("pr_auc"),
        F.max(F.col("_total__tp") / F.col("_total__cn")).alias("rate"),
        F.max("_total__cn").cast("long").alias("n")).withColumn("lift", F.try_divide(F.col("pr_auc"), F.col("rate")))


def roc_auc(df: DataFrame, y: str = "y", s: str = "s", keys: Sequence[str] = ()) -> DataFrame:
    """MET-4: ROC-AUC by Mann-Whitney with ties counted one half."""
    t = _score_table(df, y, s, keys, False)
    below = F.col("_fp") - F.col("_neg")
    return t.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("_pos") * (below + F.col("_neg") / 2.0)),
                     F.max("_total__tp") * F.max("_total__fp")).alias("roc_auc"))


def curve_points(df: DataFrame, y: str = "y", s: str = "s") -> DataFrame:
    """MET-8: precision, recall and false-positive rate at every distinct threshold (descending)."""
    t = _score_table(df, y, s, (), True)
    return t.select(F.col(s).alias("threshold"), F.col("_k").alias("point"),
                    (F.col("_tp") / F.col("_cn")).alias("precision"),
                    (F.col("_tp") / F.col("_total__tp")).alias("recall"),
                    (F.col("_fp") / F.col("_total__fp")).alias("fpr"), F.col("_total_n").alias("_n_points"))


def threshold_metrics(df: DataFrame, y: str = "y", pred: str = "flag", keys: Sequence[str] = ()) -> DataFrame:
    """MET-5 / MET-7: flagged share, precision (0 when nothing is flagged), recall, F1, balanced accuracy."""
    yy, pp = F.col(y).cast("int"), F.col(pred).cast("int")
    g = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(yy * pp).alias("tp"), F.sum((1 - yy) * pp).alias("fp"),
        F.sum(yy * (1 - pp)).alias("fn"), F.sum((1 - yy) * (1 - pp)).alias("tn"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    spec = F.try_divide(F.col("tn"), F.col("tn") + F.col("fp"))
    return g.select(*keys, "n", "tp", "fp", "fn", "tn",
                    ((F.col("tp") + F.col("fp")) / F.col("n")).alias("flagged"),
                    prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
                    ((rec + spec) / 2).alias("balanced_accuracy"))


def gain_table(df: DataFrame, y: str, s: str, id_col: str, bins: int = 10, seed: int = 42) -> DataFrame:
    """WIN-10: rows, positives, rate, cumulative capture and lift by score decile (highest scores first)."""
    d = df.withColumn("_tie", tie_key(id_col, seed))
    g = global_running(d, [F.desc(s), F.desc("_tie")], index_col="_rn")
    dec = F.least(F.floor((F.col("_rn") - 1) * bins / F.col("_total_n")) + 1, F.lit(bins))
    t = g.groupBy(dec.alias("decile")).agg(F.count(F.lit(1)).alias("orders"),
                                            F.sum(F.col(y).cast("long")).alias("late"))
    from pyspark.sql import Window
    w_all = Window.partitionBy()
    w_cum = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)     # at most `bins` rows
    return t.select("decile", "orders", "late", (F.col("late") / F.col("orders")).alias("late_rate"),
                    (F.sum("late").over(w_cum) / F.sum("late").over(w_all)).alias("cum_capture"),
                    ((F.col("late") / F.col("orders")) / (F.sum("late").over(w_all) / F.sum("orders").over(w_all)))
                    .alias("lift"))


def regression_metrics(df: DataFrame, y_log: str, pred_log: str, keys: Sequence[str] = ()) -> DataFrame:
    """MET-1: MAE, RMSE, R2 on the log scale and on the money scale (prediction floored at 0)."""
    yl, pl = F.col(y_log), F.col(pred_log)
    y, p = F.expm1(yl), F.greatest(F.expm1(pl), F.lit(0.0))
    return df.groupBy(*keys).agg(
        F.avg(F.abs(y - p)).alias("mae_rs"), F.sqrt(F.avg((y - p) * (y - p))).alias("rmse_rs"),
        (1 - F.sum((y - p) * (y - p)) / (F.var_pop(y) * F.count(F.lit(1)))).alias("r2_rs"),
        F.avg(F.abs(yl - pl)).alias("mae_log"), F.sqrt(F.avg((yl - pl) * (yl - pl))).alias("rmse_log"),
        (1 - F.sum((yl - pl) * (yl - pl)) / (F.var_pop(yl) * F.count(F.lit(1)))).alias("r2_log"))
