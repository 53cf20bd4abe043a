"""Model-free evaluation queries: splits (SPL-1..6, DQ-15, SET-3, JON-8),
ranking metrics (MET-1..11), decision rules (TOP-2/3), gain table (WIN-10),
daily review line (WIN-12), time blocks (WIN-13), dummy models (MDL-1).

The metric operators are checked on a fixed, model-free risk score computed
identically in Spark and in the oracle (longer distance, shorter promise =>
higher score, rounded to 3 decimals so that ties occur).  Models plug into the
same operators through their score column.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import clip, cut, r
from ..operators import evaluation as E
from ..operators.ranking import attach, exact_quantile, exact_quantiles
from ..registry import query
from ..sources.fixtures import market
from .core import item_features, memo, order_features
from .q_features import TARIFF, tariff


def scored_orders(m):
    """Delivered, dated orders with label ``y`` and the fixed risk score ``s``."""
    o = order_features(m, with_loads=False)
    raw = (F.lit(0.05) + F.coalesce("distance_km", F.lit(1000.0)) / F.lit(10000.0)
           + (F.lit(30.0) - F.col("promised_days")) / F.lit(100.0) - F.lit(0.02) * F.col("same_state"))
    return o.withColumn("y", F.col("clf_target")).withColumn("s", r(clip(raw, 0.0, 1.0), 3))


def _kept(pair, m):
    """Persist a (train, test) pair built once per session (reused by every metric and model query)."""
    return tuple(m._keep(df) for df in pair)


def split(m):
    """Late-delivery hold-out: latest 20% of orders; train ends 30 days before the cut (built once)."""
    return memo(m, "split", lambda: _kept(E.time_holdout(scored_orders(m), "purchase_ts", 0.2, 30.0), m))


def _summary(df, *keys):
    ts = F.col("order_purchase_timestamp")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 F.date_format(F.min(ts), "yyyy-MM-dd").alias("first_day"),
                                 F.date_format(F.max(ts), "yyyy-MM-dd").alias("last_day"),
                                 r(F.avg("y"), 6).alias("late_rate"))


_SUMMARY_SQL = """count(*) AS n, strftime(min(order_purchase_timestamp), '%Y-%m-%d') AS first_day,
       strftime(max(order_purchase_timestamp), '%Y-%m-%d') AS last_day, round_even(avg(y), 6) AS late_rate"""


@query("spl01_time_holdout", f"""
SELECT 'train' AS role, {_SUMMARY_SQL} FROM f_train
UNION ALL SELECT 'test', {_SUMMARY_SQL} FROM f_test
""")
def spl01_time_holdout(spark, sf):
    """SPL-1 / SPL-6: time hold-out (latest 20% by purchase time; train ends 30 days before the cut)."""
    train, test = split(market(spark, sf))
    return _summary(train.withColumn("role", F.lit("train")), "role").unionByName(
        _summary(test.withColumn("role", F.lit("test")), "role"))


@query("spl02_forward_folds", f"""
WITH b AS (SELECT *, ntile(6) OVER (ORDER BY purchase_ts, order_id) - 1 AS block FROM f_scored),
st AS (SELECT block AS fold, min(purchase_ts) AS start FROM b WHERE block >= 1 GROUP BY 1),
r AS (SELECT st.fold, CASE WHEN b.block = st.fold THEN 'validate'
                           WHEN b.block < st.fold AND b.purchase_ts < st.start - 30 * 86400.0 THEN 'train' END AS role,
             b.* FROM b JOIN st ON b.block <= st.fold)
SELECT fold, role, {_SUMMARY_SQL} FROM r WHERE role IS NOT NULL GROUP BY 1, 2
""")
def spl02_forward_folds(spark, sf):
    """SPL-2 / WIN-13 / SPL-6: forward-chaining folds over 6 equal time blocks with a 30-day embargo."""
    f = E.forward_folds(scored_orders(market(spark, sf)), "purchase_ts", "order_id", 5, 30.0)
    return _summary(f, "fold", "role")


@query("spl03_group_kfold", """
WITH f AS (SELECT order_id, ('0x' || substr(md5(CAST(order_id AS VARCHAR) || '-42'), 1, 8))::BIGINT % 5 AS fold
           FROM f_item_features)
SELECT fold, count(*) AS n_items, count(DISTINCT order_id) AS n_orders FROM f GROUP BY 1
""")
def spl03_group_kfold(spark, sf):
    """SPL-3: grouped 5-fold on the item table: the fold is a hash of the order key, so all lines of an
    order share it (usable as ``CrossValidator(foldCol=...)``)."""
    it = item_features(market(spark, sf)).withColumn("fold", E.hash_fold("order_id", 5))
    return it.groupBy("fold").agg(F.count(F.lit(1)).alias("n_items"), F.count_distinct("order_id").alias("n_orders"))


@query("set03_fold_key_overlap", """
WITH f AS (SELECT DISTINCT order_id, ('0x' || substr(md5(CAST(order_id AS VARCHAR) || '-42'), 1, 8))::BIGINT % 5 AS fold
           FROM f_item_features)
SELECT (SELECT count(*) FROM (SELECT order_id FROM f GROUP BY 1 HAVING count(*) > 1)) AS orders_in_two_folds,
       (SELECT count(*) FROM (SELECT order_id FROM f_train INTERSECT SELECT order_id FROM f_test)) AS orders_train_and_test,
       (SELECT count(*) FROM (SELECT DISTINCT customer_unique_id FROM f_train
                              INTERSECT SELECT DISTINCT customer_unique_id FROM f_test)) AS people_train_and_test
""")
def set03_fold_key_overlap(spark, sf):
    """SET-3: key intersection sizes: orders in two group folds, orders and people in both time splits."""
    m = market(spark, sf)
    f = item_features(m).select("order_id", E.hash_fold("order_id", 5).alias("fold")).distinct()
    two = f.groupBy("order_id").agg(F.count(F.lit(1)).alias("k")).agg(
        F.count(F.when(F.col("k") > 1, F.lit(1))).alias("orders_in_two_folds"))
    train, test = split(m)
    both = train.select("order_id").intersect(test.select("order_id")).agg(
        F.count(F.lit(1)).alias("orders_train_and_test"))
    people = (train.select("customer_unique_id").distinct().intersect(test.select("customer_unique_id").distinct())
              .agg(F.count(F.lit(1)).alias("people_train_and_test")))
    return attach(attach(two, both), people)


@query("spl04_stratified_group_holdout", """
WITH it AS (SELECT order_id, freight_value FROM f_item_features),
e AS (SELECT quantile_cont(freight_value, [0.2, 0.4, 0.6, 0.8]) AS q FROM it),
s AS (SELECT it.order_id, len(list_filter(e.q, lambda x: x < it.freight_value)) AS stratum FROM it, e),
g AS (SELECT order_id, arg_max(stratum, (n, -stratum)) AS stratum, sum(n) AS rows
      FROM (SELECT order_id, stratum, count(*) AS n FROM s GROUP BY 1, 2) GROUP BY 1),
k AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5(CAST(order_id AS VARCHAR) || '-42')) AS rk FROM g)
SELECT stratum, CASE WHEN rk % 5 = 0 THEN 'test' ELSE 'train' END AS role, count(*) AS groups, sum(rows) AS rows
FROM k GROUP BY 1, 2
""")
def spl04_stratified_group_holdout(spark, sf, k: int = 5):
    """SPL-4: grouped, stratified hold-out: freight quintile strata (right-closed quantile edges), each
    order takes its majority stratum (ties to the lower), and every k-th order of a stratum in md5 order
    is held out (about 1/k).  Ranks within a stratum use the two-phase running count."""
    it = item_features(market(spark, sf)).select("order_id", "freight_value")
    e = exact_quantiles(it, {f"q{k}": ("freight_value", k / 5) for k in range(1, 5)}).select(
        F.array(*[f"q{k}" for k in range(1, 5)]).alias("q"))
    s = attach(it, e).withColumn("stratum", F.size(F.filter("q", lambda x: x < F.col("freight_value"))))
    g = (s.groupBy("order_id", "stratum").agg(F.count(F.lit(1)).alias("n"))
         .groupBy("order_id").agg(F.max_by("stratum", F.struct(F.col("n"), -F.col("stratum"))).alias("stratum"),
                                  F.sum("n").alias("rows")))
    from ..operators.ranking import global_running
    ranked = global_running(g.withColumn("_h", E.tie_key("order_id")), ["_h"], keys=["stratum"], index_col="rk")
    role = F.when(F.col("rk") % k == 0, F.lit("test")).otherwise(F.lit("train"))
    return ranked.groupBy("stratum", role.alias("role")).agg(F.count(F.lit(1)).alias("groups"),
                                                             F.sum("rows").alias("rows"))


@query("spl05_rolling_windows", f"""
WITH q AS (SELECT quantile_cont(purchase_ts, 0.5) AS s1, quantile_cont(purchase_ts, 0.6) AS s2,
                  quantile_cont(purchase_ts, 0.7) AS s3, quantile_cont(purchase_ts, 0.8) AS s4,
                  max(purchase_ts) AS e FROM f_scored),
w AS (SELECT 1 AS "window", s1 AS start, s2 AS "end" FROM q UNION ALL SELECT 2, s2, s3 FROM q
      UNION ALL SELECT 3, s3, s4 FROM q UNION ALL SELECT 4, s4, e FROM q),
r AS (SELECT w."window", CASE WHEN o.purchase_ts > w.start THEN 'test'
                            WHEN o.purchase_ts <= w.start - 30 * 86400.0 THEN 'train' END AS role, o.*
      FROM f_scored o JOIN w ON o.purchase_ts <= w."end")
SELECT "window", role, {_SUMMARY_SQL}, round_even(median(promised_days), 6) AS median_promise
FROM r WHERE role IS NOT NULL GROUP BY 1, 2
""")
def spl05_rolling_windows(spark, sf):
    """SPL-5: four rolling-origin windows starting at the 50/60/70/80% time quantiles (the last is the main
    hold-out); train on all orders up to each start minus the embargo."""
    w = E.rolling_windows(scored_orders(market(spark, sf)), "purchase_ts", [0.5, 0.6, 0.7, 0.8], 30.0)
    s = _summary(w, "window", "role")
    med = exact_quantile(w, "promised_days", 0.5, "_m", keys=["window", "role"]).select(
        "window", "role", r("_m", 6).alias("median_promise"))
    return s.join(med, ["window", "role"])


@query("dq15_split_integrity", """
SELECT (SELECT count(*) FROM f_train WHERE order_id IN (SELECT order_id FROM f_test)) AS orders_in_both,
       (SELECT max(purchase_ts) FROM f_train) < (SELECT min(purchase_ts) FROM f_test) - 30 * 86400.0 AS embargo_kept,
       round_even(((SELECT min(purchase_ts) FROM f_test) - (SELECT max(purchase_ts) FROM f_train)) / 86400.0, 6)
           AS gap_days
""")
def dq15_split_integrity(spark, sf):
    """DQ-15: no order in both splits (left-semi count = 0); max train time < min test time - embargo."""
    train, test = split(market(spark, sf))
    both = train.join(test.select("order_id"), "order_id", "left_semi").agg(F.count(F.lit(1)).alias("orders_in_both"))
    tr = train.agg(F.max("purchase_ts").alias("_tmax"))
    te = test.agg(F.min("purchase_ts").alias("_tmin"))
    j = attach(attach(both, tr), te)
    return j.select("orders_in_both", (F.col("_tmax") < F.col("_tmin") - F.lit(30 * 86400.0)).alias("embargo_kept"),
                    r((F.col("_tmin") - F.col("_tmax")) / F.lit(86400.0), 6).alias("gap_days"))


@query("jon08_unseen_products", """
SELECT (SELECT count(*) FROM f_itest t WHERE NOT EXISTS (SELECT 1 FROM f_itrain r WHERE r.product_id = t.product_id)) AS lines_unseen_product,
       round_even((SELECT avg((EXISTS (SELECT 1 FROM f_itrain r WHERE r.product_id = t.product_id))::INT) FROM f_itest t), 6) AS product_seen_share
""")
def jon08_unseen_products(spark, sf):
    """JON-8: hold-out lines whose product never occurs in training (anti join) and the share of seen ones."""
    train, test = item_split(market(spark, sf))
    known = train.select("product_id").distinct()
    unseen = test.join(known, "product_id", "left_anti").agg(F.count(F.lit(1)).alias("lines_unseen_product"))
    seen = test.join(known.withColumn("_hit", F.lit(1)), "product_id", "left").agg(
        r(F.avg(F.coalesce("_hit", F.lit(0))), 6).alias("product_seen_share"))
    return attach(unseen, seen)


@query("jon08_unseen_and_overlap", """
SELECT (SELECT count(*) FROM f_test t WHERE NOT EXISTS (SELECT 1 FROM f_train r WHERE r.seller_id = t.seller_id))
           AS test_orders_unseen_seller,
       round_even((SELECT avg((EXISTS (SELECT 1 FROM f_train r WHERE r.customer_unique_id = t.customer_unique_id))::INT)
                   FROM f_test t), 6) AS test_people_seen_share,
       round_even((SELECT avg((EXISTS (SELECT 1 FROM f_train r WHERE r.category = t.category))::INT) FROM f_test t), 6)
           AS test_category_seen_share
""")
def jon08_unseen_and_overlap(spark, sf):
    """JON-8: anti join (test orders whose main seller never occurs in train) and overlap shares
    (``avg`` of a left-join hit) of people and categories."""
    train, test = split(market(spark, sf))
    unseen = test.join(train.select("seller_id").distinct(), "seller_id", "left_anti").agg(
        F.count(F.lit(1)).alias("test_orders_unseen_seller"))

    def seen(col):
        keys = train.select(col).distinct().withColumn("_hit", F.lit(1))
        return test.join(keys, col, "left").agg(r(F.avg(F.coalesce("_hit", F.lit(0))), 6)
                                                .alias(f"test_{'people' if col == 'customer_unique_id' else col}_seen_share"))
    return attach(attach(unseen, seen("customer_unique_id")), seen("category"))


# ---------------------------------------------------------------- ranking metrics on the test window
_AP_SQL = """
t AS (SELECT s, sum(y) AS pos, count(*) AS cnt FROM {src} GROUP BY s),
c AS (SELECT s, pos, cnt, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(cnt) OVER (ORDER BY s DESC) AS cn,
             sum(pos) OVER () AS p_all, sum(cnt) OVER () AS n_all FROM t)"""


@query("met02_average_precision", f"""
WITH {_AP_SQL.format(src='f_test')}
SELECT round_even(sum(pos / p_all * tp / cn), 6) AS pr_auc, round_even(max(p_all / n_all), 6) AS rate,
       max(n_all) AS n, round_even(sum(pos / p_all * tp / cn) / max(p_all / n_all), 6) AS lift
FROM c
""")
def met02_average_precision(spark, sf):
    """MET-2 / MET-3: average precision (step sum over distinct thresholds) and PR-AUC lift."""
    _, test = split(market(spark, sf))
    ap = E.average_precision(test, "y", "s")
    return ap.select(r("pr_auc", 6).alias("pr_auc"), r("rate", 6).alias("rate"), "n", r("lift", 6).alias("lift"))


@query("met04_roc_auc", """
WITH t AS (SELECT s, sum(y) AS pos, count(*) - sum(y) AS neg FROM f_test GROUP BY s),
c AS (SELECT *, sum(neg) OVER (ORDER BY s) - neg AS below, sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all FROM t)
SELECT round_even(sum(pos * (below + neg / 2.0)) / (max(p_all) * max(n_all)), 6) AS roc_auc FROM c
""")
def met04_roc_auc(spark, sf):
    """MET-4: ROC-AUC by Mann-Whitney, ties counted one half."""
    _, test = split(market(spark, sf))
    return E.roc_auc(test, "y", "s").select(r("roc_auc", 6).alias("roc_auc"))


@query("met06_brier", """
SELECT round_even(avg((s - y) * (s - y)), 6) AS brier, min(s) >= 0 AND max(s) <= 1 AS scores_in_unit FROM f_test
""")
def met06_brier(spark, sf):
    """MET-6: Brier score (defined when scores lie in [0, 1])."""
    _, test = split(market(spark, sf))
    d = F.col("s") - F.col("y")
    return test.agg(r(F.avg(d * d), 6).alias("brier"),
                    ((F.min("s") >= 0) & (F.max("s") <= 1)).alias("scores_in_unit"))


_FLAG_SQL = """
fl AS (SELECT *, row_number() OVER (ORDER BY s DESC, md5(CAST(order_id AS VARCHAR) || '-42') DESC) AS rk,
              count(*) OVER () AS n_all FROM f_test),
flagged AS (SELECT *, (rk <= round_even(n_all * 0.1, 0))::INT AS flag FROM fl)"""


@query("top02_top_share_flag", f"""
WITH {_FLAG_SQL}
SELECT count(*) AS n, sum(flag) AS flagged, sum(flag * y) AS flagged_late, min(s) FILTER (WHERE flag = 1) AS lowest_flagged,
       max(s) FILTER (WHERE flag = 0) AS highest_unflagged FROM flagged
""")
def top02_top_share_flag(spark, sf, share: float = 0.1):
    """TOP-2: flag the top 10% of scores (k = round-half-even(share x n), ties in md5 order)."""
    _, test = split(market(spark, sf))
    f = E.flag_top_share(test, "s", share, "order_id")
    return f.agg(F.count(F.lit(1)).alias("n"), F.sum("flag").alias("flagged"),
                 F.sum(F.col("flag") * F.col("y")).alias("flagged_late"),
                 F.min(F.when(F.col("flag") == 1, F.col("s"))).alias("lowest_flagged"),
                 F.max(F.when(F.col("flag") == 0, F.col("s"))).alias("highest_unflagged"))


_THRESH_SQL = """
SELECT n, tp, fp, fn, tn, round_even((tp + fp) / n, 6) AS flagged,
       round_even(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round_even(tp / nullif(tp + fn, 0), 6) AS recall,
       round_even(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
       round_even((tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2, 6) AS balanced_accuracy
FROM (SELECT count(*) AS n, sum(y * flag) AS tp, sum((1 - y) * flag) AS fp, sum(y * (1 - flag)) AS fn,
             sum((1 - y) * (1 - flag)) AS tn FROM flagged)"""


@query("met05_threshold_metrics", f"WITH {_FLAG_SQL}\n{_THRESH_SQL}")
def met05_threshold_metrics(spark, sf):
    """MET-5: flagged share, precision (0 if none), recall, F1, balanced accuracy of the top-10% rule."""
    _, test = split(market(spark, sf))
    t = E.threshold_metrics(E.flag_top_share(test, "s", 0.1, "order_id"), "y", "flag")
    return t.select("n", "tp", "fp", "fn", "tn",
                    *[r(c, 6).alias(c) for c in ("flagged", "precision", "recall", "f1", "balanced_accuracy")])


@query("met07_confusion", f"""
WITH {_FLAG_SQL}
SELECT y, flag AS pred, count(*) AS n FROM flagged GROUP BY 1, 2
""")
def met07_confusion(spark, sf):
    """MET-7: confusion matrix of the top-10% rule."""
    _, test = split(market(spark, sf))
    f = E.flag_top_share(test, "s", 0.1, "order_id")
    return f.groupBy("y", F.col("flag").alias("pred")).agg(F.count(F.lit(1)).alias("n"))


@query("met08_curve_points", f"""
WITH {_AP_SQL.format(src='f_test')},
k AS (SELECT *, row_number() OVER (ORDER BY s DESC) AS point, count(*) OVER () AS n_points,
             sum(cnt - pos) OVER (ORDER BY s DESC) AS fp, sum(cnt - pos) OVER () AS neg_all FROM c),
p AS (SELECT DISTINCT CASE WHEN g.range = 49 THEN n_points ELSE CAST(floor(g.range * ((n_points - 1) / 49.0)) AS BIGINT) + 1 END
          AS point FROM (SELECT max(n_points) AS n_points FROM k) t, range(50) g)
SELECT k.point, k.s AS threshold, round_even(tp / cn, 6) AS precision, round_even(tp / p_all, 6) AS recall,
       round_even(fp / neg_all, 6) AS fpr
FROM k JOIN p ON k.point = p.point
""")
def met08_curve_points(spark, sf, points: int = 50):
    """MET-8: precision-recall and ROC curve points at distinct thresholds, thinned to ~50 evenly spaced."""
    _, test = split(market(spark, sf))
    c = E.curve_points(test, "y", "s")
    pos = (c.agg(F.max("_n_points").alias("n"))
           .select("n", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("j"))
           .select(F.when(F.col("j") == points - 1, F.col("n"))
                   .otherwise(F.floor(F.col("j") * ((F.col("n") - 1) / F.lit(float(points - 1)))) + 1).alias("point"))
           .distinct())
    return c.join(F.broadcast(pos), "point").select(
        "point", "threshold", r("precision", 6).alias("precision"), r("recall", 6).alias("recall"),
        r("fpr", 6).alias("fpr"))


@query("met10_skill_by_month", """
WITH m AS (SELECT *, strftime(order_purchase_timestamp, '%Y-%m') AS month FROM f_test),
t AS (SELECT month, s, sum(y) AS pos, count(*) AS cnt FROM m GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY month ORDER BY s DESC) AS tp,
             sum(cnt) OVER (PARTITION BY month ORDER BY s DESC) AS cn,
             sum(cnt - pos) OVER (PARTITION BY month ORDER BY s) - (cnt - pos) AS below,
             sum(pos) OVER (PARTITION BY month) AS p_all, sum(cnt) OVER (PARTITION BY month) AS n_all FROM t)
SELECT month, max(n_all) AS orders, round_even(max(p_all / n_all), 6) AS late_rate,
       round_even(sum(pos / p_all * tp / cn), 6) AS pr_auc,
       round_even(sum(pos / p_all * tp / cn) / max(p_all / n_all), 6) AS lift,
       round_even(sum(pos * (below + (cnt - pos) / 2.0)) / (max(p_all) * max(n_all - p_all)), 6) AS roc_auc
FROM c GROUP BY 1 HAVING max(p_all) > 0 AND max(n_all - p_all) > 0
""")
def met10_skill_by_month(spark, sf):
    """MET-10: per test month: orders, late rate, PR-AUC, lift and ROC-AUC."""
    _, test = split(market(spark, sf))
    t = test.withColumn("month", F.date_format("order_purchase_timestamp", "yyyy-MM"))
    ap = E.average_precision(t, "y", "s", keys=["month"])
    auc = E.roc_auc(t, "y", "s", keys=["month"])
    j = ap.join(auc, "month").filter((F.col("rate") > 0) & (F.col("rate") < 1))
    return j.select("month", F.col("n").alias("orders"), r("rate", 6).alias("late_rate"), r("pr_auc", 6).alias("pr_auc"),
                    r("lift", 6).alias("lift"), r("roc_auc", 6).alias("roc_auc"))


@query("met11_low_review_by_flag", f"""
WITH {_FLAG_SQL},
lw AS (SELECT order_id, (arg_max(review_score, (review_creation_date, review_id)) <= 2)::INT AS low
       FROM f_reviews GROUP BY 1),
j AS (SELECT f.flag, lw.low FROM flagged f LEFT JOIN lw ON f.order_id = lw.order_id)
SELECT round_even(avg(low) FILTER (WHERE flag = 1), 6) AS low_rate_flagged,
       round_even(avg(low) FILTER (WHERE flag = 0), 6) AS low_rate_not_flagged,
       round_even(sum(low) FILTER (WHERE flag = 1) / sum(low), 6) AS share_low_flagged, count(low) AS with_review
FROM j
""")
def met11_low_review_by_flag(spark, sf):
    """MET-11 / JON-9: low-review (1-2 stars) rate of flagged vs unflagged test orders and the share of low
    reviews that were flagged; orders without a review are ignored."""
    m = market(spark, sf)
    _, test = split(m)
    f = E.flag_top_share(test, "s", 0.1, "order_id")
    lw = m.reviews.groupBy("order_id").agg(
        (F.max_by("review_score", F.struct("review_creation_date", "review_id")) <= 2).cast("int").alias("low"))
    j = f.select("order_id", "flag").join(lw, "order_id", "left")
    return j.agg(r(F.avg(F.when(F.col("flag") == 1, F.col("low"))), 6).alias("low_rate_flagged"),
                 r(F.avg(F.when(F.col("flag") == 0, F.col("low"))), 6).alias("low_rate_not_flagged"),
                 r(F.sum(F.when(F.col("flag") == 1, F.col("low"))) / F.sum("low"), 6).alias("share_low_flagged"),
                 F.count("low").alias("with_review"))


_DAILY_SQL = """
dl AS (SELECT *, CAST(order_purchase_timestamp AS DATE) AS day,
              row_number() OVER (PARTITION BY CAST(order_purchase_timestamp AS DATE)
                                 ORDER BY s DESC, md5(CAST(order_id AS VARCHAR) || '-42') DESC) AS rk,
              count(*) OVER (PARTITION BY CAST(order_purchase_timestamp AS DATE)) AS n_day FROM f_test),
dflag AS (SELECT *, (rk <= round_even(n_day * 0.1, 0))::INT AS flag FROM dl)"""


@query("top03_daily_top_share", f"""
WITH {_DAILY_SQL}
SELECT count(*) AS n, sum(flag) AS flagged, sum(flag * y) AS caught,
       round_even(sum(flag * y) / nullif(sum(flag), 0), 6) AS precision, count(DISTINCT day) AS days
FROM dflag
""")
def top03_daily_top_share(spark, sf, share: float = 0.1):
    """TOP-3: the top-share rule within each purchase day (ranks within a day from the keyed two-phase
    running count, so a very busy day is still split across tasks)."""
    _, test = split(market(spark, sf))
    t = test.withColumn("day", F.to_date("order_purchase_timestamp"))
    f = E.flag_top_share(t, "s", share, "order_id", keys=["day"])
    return f.agg(F.count(F.lit(1)).alias("n"), F.sum("flag").alias("flagged"),
                 F.sum(F.col("flag") * F.col("y")).alias("caught"),
                 r(F.try_divide(F.sum(F.col("flag") * F.col("y")), F.sum("flag")), 6).alias("precision"),
                 F.count_distinct("day").alias("days"))


@query("win12_daily_review_line", f"""
WITH {_DAILY_SQL}
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS orders, sum(flag) AS listed,
       min(s) FILTER (WHERE flag = 1) AS lowest_listed, max(s) FILTER (WHERE flag = 0) AS review_line
FROM dflag GROUP BY 1
""")
def win12_daily_review_line(spark, sf):
    """WIN-12: per day, the size of the list, the lowest listed score and the highest score left off (the
    review line)."""
    _, test = split(market(spark, sf))
    t = test.withColumn("day", F.to_date("order_purchase_timestamp"))
    f = E.flag_top_share(t, "s", 0.1, "order_id", keys=["day"])
    return f.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("flag").alias("listed"),
        F.min(F.when(F.col("flag") == 1, F.col("s"))).alias("lowest_listed"),
        F.max(F.when(F.col("flag") == 0, F.col("s"))).alias("review_line"))


@query("win10_gain_table", """
WITH k AS (SELECT y, row_number() OVER (ORDER BY s DESC, md5(CAST(order_id AS VARCHAR) || '-42') DESC) AS rn,
                  count(*) OVER () AS n FROM f_test),
g AS (SELECT least(CAST(floor((rn - 1) * 10 / n) AS BIGINT) + 1, 10) AS decile, count(*) AS orders, sum(y) AS late
      FROM k GROUP BY 1)
SELECT decile, orders, late, round_even(late / orders, 6) AS late_rate,
       round_even(sum(late) OVER (ORDER BY decile) / sum(late) OVER (), 6) AS cum_capture,
       round_even((late / orders) / (sum(late) OVER () / sum(orders) OVER ()), 6) AS lift
FROM g
""")
def win10_gain_table(spark, sf):
    """WIN-10: decile gain table of the test window (rows, late, rate, cumulative capture, lift)."""
    _, test = split(market(spark, sf))
    g = E.gain_table(test, "y", "s", "order_id", 10)
    return g.select("decile", "orders", "late", *[r(c, 6).alias(c) for c in ("late_rate", "cum_capture", "lift")])


# ---------------------------------------------------------------- regression metrics on the item hold-out
def item_split(m):
    """Fair-freight hold-out: latest 20% of lines; no embargo (freight is known at checkout)."""
    return memo(m, "item_split", lambda: _kept(E.time_holdout(item_features(m), "purchase_ts", 0.2, 0.0), m))


_ITEM_SPLIT_SQL = """
icut AS (SELECT quantile_cont(purchase_ts, 0.8) AS c FROM f_item_features),
itest AS (SELECT f.*, CASE WHEN distance_km IS NULL THEN NULL ELSE greatest(9.614 + 1.846 * chargeable_kg
              + 0.811 * distance_km / 100 + -3.985 * same_state, 0.0) END AS est
          FROM f_item_features f, icut WHERE purchase_ts > icut.c),
itrain AS (SELECT f.* FROM f_item_features f, icut WHERE purchase_ts <= icut.c)"""


def _with_tariff(df):
    return df.withColumn("est", tariff("chargeable_kg", "distance_km", "same_state", TARIFF))


@query("met01_regression_metrics", f"""
WITH {_ITEM_SPLIT_SQL},
p AS (SELECT ln(1 + freight_value) AS yl, ln(1 + est) AS pl FROM itest WHERE est IS NOT NULL),
q AS (SELECT exp(yl) - 1 AS y, greatest(exp(pl) - 1, 0) AS p, yl, pl FROM p)
SELECT count(*) AS n, round_even(avg(abs(y - p)), 4) AS mae_rs, round_even(sqrt(avg((y - p) * (y - p))), 4) AS rmse_rs,
       round_even(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 4) AS r2_rs,
       round_even(avg(abs(yl - pl)), 4) AS mae_log, round_even(sqrt(avg((yl - pl) * (yl - pl))), 4) AS rmse_log,
       round_even(1 - sum((yl - pl) * (yl - pl)) / (var_pop(yl) * count(*)), 4) AS r2_log
FROM q
""")
def met01_regression_metrics(spark, sf):
    """MET-1 / STA-10 / PRJ-11: MAE, RMSE, R2 on the money and log scales of the literal tariff as a
    freight estimate on the item hold-out (the same operator scores the MLlib models)."""
    _, test = item_split(market(spark, sf))
    t = _with_tariff(test).filter(F.col("est").isNotNull())
    t = t.select(F.log1p("freight_value").alias("yl"), F.log1p("est").alias("pl"))
    m = E.regression_metrics(t, "yl", "pl")
    n = t.agg(F.count(F.lit(1)).alias("n"))
    return attach(n, m.select(*[r(c, 4).alias(c) for c in m.columns]))


# Band edges and labels.
PRICE_EDGES = [0, 30, 60, 100, 200, 500, float("inf")]
PRICE_LABELS = ["<30", "30-60", "60-100", "100-200", "200-500", "500+"]


def _band_sql(closed_left: bool):
    parts = []
    for a, b, lab in zip(PRICE_EDGES[:-1], PRICE_EDGES[1:], PRICE_LABELS):
        hi = "'inf'::DOUBLE" if b == float("inf") else str(float(b))
        cond = (f"price >= {float(a)} AND price < {hi}" if closed_left else f"price > {float(a)} AND price <= {hi}")
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


@query("met09_error_by_price_band", f"""
WITH {_ITEM_SPLIT_SQL},
e AS (SELECT price, freight_value, abs(freight_value - est) AS err FROM itest WHERE est IS NOT NULL),
b AS (SELECT 'left' AS closed, {_band_sql(True)} AS price_band, * FROM e
      UNION ALL SELECT 'right', {_band_sql(False)}, * FROM e)
SELECT closed, price_band, count(*) AS n, round_even(avg(err), 4) AS mae,
       round_even(avg(err) / avg(freight_value) * 100, 4) AS mae_pct_of_mean
FROM b WHERE price_band IS NOT NULL GROUP BY 1, 2
""")
def met09_error_by_price_band(spark, sf):
    """MET-9 / PRJ-12 / PRJ-13: estimate error by price band under both band closings (the reference uses
    both): n, MAE and MAE as % of mean freight."""
    _, test = item_split(market(spark, sf))
    e = _with_tariff(test).filter(F.col("est").isNotNull()).withColumn(
        "err", F.abs(F.col("freight_value") - F.col("est")))
    left = e.select(F.lit("left").alias("closed"), cut("price", PRICE_EDGES, PRICE_LABELS, right=False)
                    .alias("price_band"), "freight_value", "err")
    right = e.select(F.lit("right").alias("closed"), cut("price", PRICE_EDGES, PRICE_LABELS, right=True)
                     .alias("price_band"), "freight_value", "err")
    b = left.unionByName(right).filter(F.col("price_band").isNotNull())
    return b.groupBy("closed", "price_band").agg(
        F.count(F.lit(1)).alias("n"), r(F.avg("err"), 4).alias("mae"),
        r(F.avg("err") / F.avg("freight_value") * 100, 4).alias("mae_pct_of_mean"))


@query("mdl01_dummy_models", f"""
WITH {_ITEM_SPLIT_SQL},
mu AS (SELECT avg(ln(1 + freight_value)) AS m FROM itrain),
reg AS (SELECT round_even(avg(abs(freight_value - greatest(exp(mu.m) - 1, 0))), 4) AS dummy_mae_rs
        FROM itest, mu),
pr AS (SELECT avg(y) AS prior FROM f_train)
SELECT reg.dummy_mae_rs, round_even(pr.prior, 6) AS dummy_prior,
       round_even((SELECT avg(y) FROM f_test), 6) AS dummy_pr_auc, 1.0 AS dummy_lift, 0.5 AS dummy_roc_auc
FROM reg, pr
""")
def mdl01_dummy_models(spark, sf):
    """MDL-1: dummy regressor (train mean of the log target as a literal) and dummy classifier (train
    prior): test MAE; a constant score has PR-AUC = positive rate, lift 1 and ROC-AUC 0.5."""
    m = market(spark, sf)
    itrain, itest = item_split(m)
    mu = itrain.agg(F.avg(F.log1p("freight_value")).alias("_m"))
    reg = attach(itest, mu).agg(r(F.avg(F.abs(F.col("freight_value") - F.greatest(F.expm1("_m"), F.lit(0.0)))), 4)
                                .alias("dummy_mae_rs"))
    train, test = split(m)
    prior = train.agg(r(F.avg("y"), 6).alias("dummy_prior"))
    const = test.withColumn("s", F.lit(0.5))
    ap = E.average_precision(const, "y", "s").select(r("pr_auc", 6).alias("dummy_pr_auc"),
                                                      F.col("lift").alias("dummy_lift"))
    auc = E.roc_auc(const, "y", "s").select(F.col("roc_auc").alias("dummy_roc_auc"))
    return attach(attach(attach(reg, prior), ap), auc)
