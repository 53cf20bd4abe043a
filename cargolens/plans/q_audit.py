"""Audit and decision queries (AUD-1..11, AGG-50..52, TOP-4..6, SET-1, SMP-1/2).

The audit operators take any two freight estimates (a primary and a check
model).  For the oracle-checked queries the estimates are deterministic: the
literal tariff (primary) and a category-median lookup fitted on the training
window (check).  ``models.py`` feeds MLlib predictions into the same
operators.
"""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import cut, r
from ..operators import evaluation as E
from ..operators.ranking import agg_with_quantiles, attach, exact_quantile, exact_quantiles, global_running
from ..registry import query
from ..sources.fixtures import market
from .core import item_features, item_star, memo
from .q_eval import item_split, split
from .q_features import tariff

INF = math.inf
# Band edges and labels.
AUDIT_EDGES = [0, 50, 100, 200, 500, INF]
AUDIT_LABELS = ["<50", "50-100", "100-200", "200-500", "500+"]
FLAG_Q = 0.95
FLAG_TOL = 1e-9   # fixed value: tolerance on the log scale for ties at the cut-off


def residual(actual, estimate):
    """Log residual log(1 + charged) - log(1 + expected), rounded to 9 decimals so ties stay ties."""
    return r(F.log1p(actual) - F.log1p(estimate), 9)


def audit_frame(test, est_a, est_b):
    """AUD-1 / AUD-2 / AUD-9: residuals, overall and per-band cut-offs (exact 95% quantiles), flags with and
    without the tolerance, excess and markup for the two estimates ``est_a`` (primary) and ``est_b``."""
    t = (test.withColumn("est_a", est_a).withColumn("est_b", est_b).filter(F.col("est_a").isNotNull())
         .withColumn("resid_a", residual(F.col("freight_value"), F.col("est_a")))
         .withColumn("resid_b", residual(F.col("freight_value"), F.col("est_b")))
         .withColumn("band", cut("price", AUDIT_EDGES, AUDIT_LABELS, right=False)))
    co = exact_quantiles(t, {"cut_a": ("resid_a", FLAG_Q), "cut_b": ("resid_b", FLAG_Q)})
    cb = exact_quantiles(t, {"bcut_a": ("resid_a", FLAG_Q), "bcut_b": ("resid_b", FLAG_Q)}, keys=["band"]).dropna()
    a = attach(t, co).join(F.broadcast(cb), "band")            # one row per price band
    return a.select(
        "*",
        (F.col("resid_a") >= F.col("cut_a")).cast("int").alias("p_a"),
        (F.col("resid_b") >= F.col("cut_b")).cast("int").alias("p_b"),
        (F.col("resid_a") >= F.col("cut_a") - FLAG_TOL).cast("int").alias("fo_a"),
        (F.col("resid_b") >= F.col("cut_b") - FLAG_TOL).cast("int").alias("fo_b"),
        (F.col("resid_a") >= F.col("bcut_a") - FLAG_TOL).cast("int").alias("fb_a"),
        (F.col("resid_b") >= F.col("bcut_b") - FLAG_TOL).cast("int").alias("fb_b"),
        (F.col("freight_value") - F.col("est_a")).alias("excess"),
        F.when(F.col("est_a") > 0, F.col("freight_value") / F.col("est_a")).alias("markup"))


def audited(m):
    """The audit table, written once: a report takes it many times, and unwritten its quantiles would be planned each time."""
    return memo(m, "audited", lambda: m._keep(_audited(m)))


def _audited(m):
    train, test = item_split(m)
    med = m._keep(exact_quantile(train.filter(F.col("category").isNotNull()), "freight_value", 0.5, "_cat_median", keys=["category"]))
    allm = m._keep(exact_quantile(train, "freight_value", 0.5, "_all_median"))
    t = attach(test.join(med, "category", "left"), allm)
    return audit_frame(t, tariff("chargeable_kg", "distance_km", "same_state"),
                       F.coalesce("_cat_median", "_all_median"))


def _s(*cols):
    return [r(c, 6).alias(c) for c in cols]


@query("aud01_residual_flags", """
SELECT count(*) AS n, round_even(avg(p_a), 6) AS flag_rate, round_even(avg(p_b), 6) AS flag_rate_check,
       round_even(sum(p_a * p_b) / sum(greatest(p_a, p_b)), 6) AS jaccard,
       round_even(sum(p_a * p_b) / sum(p_a), 6) AS overlap_share,
       round_even(sum(est_a::DECIMAL(20, 9)) FILTER (WHERE p_a = 1)::DOUBLE / sum(p_a), 6) AS mean_expected_flagged,
       round_even(sum(excess::DECIMAL(20, 9)) FILTER (WHERE p_a = 1)::DOUBLE / sum(p_a), 6) AS mean_excess_flagged
FROM f_audit
""")
def aud01_residual_flags(spark, sf):
    """AUD-1: top 5% positive log residuals of two estimates: flag rate, Jaccard, overlap, expected and excess."""
    a = audited(market(spark, sf))
    g = a.agg(F.count(F.lit(1)).alias("n"), F.avg("p_a").alias("flag_rate"), F.avg("p_b").alias("flag_rate_check"),
              (F.sum(F.col("p_a") * F.col("p_b")) / F.sum(F.greatest("p_a", "p_b"))).alias("jaccard"),
              (F.sum(F.col("p_a") * F.col("p_b")) / F.sum("p_a")).alias("overlap_share"),
              *[(F.sum(F.when(F.col("p_a") == 1, F.col(c).cast("decimal(20,9)"))).cast("double") / F.sum("p_a")).alias(n)
                for c, n in (("est_a", "mean_expected_flagged"), ("excess", "mean_excess_flagged"))])
    return g.select("n", *_s("flag_rate", "flag_rate_check", "jaccard", "overlap_share", "mean_expected_flagged",
                             "mean_excess_flagged"))


@query("aud02_cutoffs", """
SELECT 'overall' AS band, round_even(max(cut_a), 9) AS cut_a, round_even(max(cut_b), 9) AS cut_b, count(*) AS n,
       sum(fo_a) AS flagged_a, sum(fo_b) AS flagged_b, sum(greatest(fo_a, fo_b)) AS flagged_either FROM f_audit
UNION ALL
SELECT band, round_even(max(bcut_a), 9), round_even(max(bcut_b), 9), count(*), sum(fb_a), sum(fb_b),
       sum(greatest(fb_a, fb_b)) FROM f_audit GROUP BY band
""")
def aud02_cutoffs(spark, sf):
    """AUD-2: cut-offs overall and per price band (tolerance 1e-9), with flags by either estimate."""
    a = audited(market(spark, sf))
    o = a.agg(F.lit("overall").alias("band"), r(F.max("cut_a"), 9).alias("cut_a"), r(F.max("cut_b"), 9).alias("cut_b"),
              F.count(F.lit(1)).alias("n"), F.sum("fo_a").alias("flagged_a"), F.sum("fo_b").alias("flagged_b"),
              F.sum(F.greatest("fo_a", "fo_b")).alias("flagged_either"))
    b = a.groupBy("band").agg(r(F.max("bcut_a"), 9).alias("cut_a"), r(F.max("bcut_b"), 9).alias("cut_b"),
                              F.count(F.lit(1)).alias("n"), F.sum("fb_a").alias("flagged_a"),
                              F.sum("fb_b").alias("flagged_b"), F.sum(F.greatest("fb_a", "fb_b")).alias("flagged_either"))
    return o.unionByName(b)


def verdict(fa, fb):
    """AUD-3: both estimates flag -> unusual_both; only the primary -> unusual_forest_only; else normal."""
    return (F.when((F.col(fa) == 1) & (F.col(fb) == 1), F.lit("unusual_both"))
            .when(F.col(fa) == 1, F.lit("unusual_forest_only")).otherwise(F.lit("normal")))


@query("aud03_verdicts", """
SELECT 'overall' AS rule, CASE WHEN fo_a = 1 AND fo_b = 1 THEN 'unusual_both' WHEN fo_a = 1 THEN 'unusual_forest_only'
                               ELSE 'normal' END AS verdict, count(*) AS n FROM f_audit GROUP BY 1, 2
UNION ALL
SELECT 'band', CASE WHEN fb_a = 1 AND fb_b = 1 THEN 'unusual_both' WHEN fb_a = 1 THEN 'unusual_forest_only'
                    ELSE 'normal' END, count(*) FROM f_audit GROUP BY 1, 2
""")
def aud03_verdicts(spark, sf):
    """AUD-3: verdict counts per rule (overall cut-off, per-band cut-off)."""
    a = audited(market(spark, sf))
    o = a.groupBy(F.lit("overall").alias("rule"), verdict("fo_a", "fo_b").alias("verdict")).agg(
        F.count(F.lit(1)).alias("n"))
    b = a.groupBy(F.lit("band").alias("rule"), verdict("fb_a", "fb_b").alias("verdict")).agg(
        F.count(F.lit(1)).alias("n"))
    return o.unionByName(b)


@query("aud04_audit_summary", """
WITH f AS (SELECT * FROM f_audit WHERE p_a = 1),
k AS (SELECT greatest(1, CAST(floor(0.05 * count(DISTINCT seller_id)) AS BIGINT)) AS k FROM f_audit),
sc AS (SELECT seller_id, count(*) AS c, row_number() OVER (ORDER BY count(*) DESC, seller_id) AS rk FROM f GROUP BY 1)
SELECT (SELECT count(*) FROM f) AS items_flagged,
       round_even((SELECT sum(freight_value::DECIMAL(20, 9))::DOUBLE / count(*) FROM f), 6) AS mean_actual,
       round_even((SELECT sum(est_a::DECIMAL(20, 9))::DOUBLE / count(*) FROM f), 6) AS mean_expected,
       round_even((SELECT sum(excess::DECIMAL(20, 9))::DOUBLE / count(*) FROM f), 6) AS mean_excess,
       round_even((SELECT sum(excess::DECIMAL(20, 9))::DOUBLE FROM f) / (SELECT sum(freight_value) FROM f_audit) * 100, 6)
           AS excess_pct_of_freight,
       round_even((SELECT sum(c) FROM sc, k WHERE rk <= k.k) / (SELECT count(*) FROM f) * 100, 6) AS top_sellers_flag_pct,
       round_even((SELECT avg(p_b) FROM f) * 100, 6) AS flagged_by_both_pct,
       round_even((SELECT sum(p_a * p_b) / sum(greatest(p_a, p_b)) FROM f_audit), 6) AS jaccard
""")
def aud04_audit_summary(spark, sf):
    """AUD-4: flagged items, mean actual / expected / excess, excess share of all test freight, share of flags
    from the top 5% of sellers by flag count, flagged by both, agreement."""
    a = audited(market(spark, sf))
    f = a.filter(F.col("p_a") == 1)
    k = a.agg(F.greatest(F.lit(1), F.floor(F.lit(0.05) * F.count_distinct("seller_id"))).alias("k"))
    sc = f.groupBy("seller_id").agg(F.count(F.lit(1)).alias("c"))
    sc = global_running(sc, [F.desc("c"), F.asc("seller_id")], index_col="rk")
    top = attach(sc, k).agg(F.sum(F.when(F.col("rk") <= F.col("k"), F.col("c"))).alias("_top"))
    s1 = f.agg(F.count(F.lit(1)).alias("items_flagged"),
               (F.sum(F.col("freight_value").cast("decimal(20,9)")).cast("double") / F.count(F.lit(1))).alias("mean_actual"),
               # exact decimal sums: the means do not depend on the summation order
               (F.sum(F.col("est_a").cast("decimal(20,9)")).cast("double") / F.count(F.lit(1))).alias("mean_expected"),
               (F.sum(F.col("excess").cast("decimal(20,9)")).cast("double") / F.count(F.lit(1))).alias("mean_excess"),
               F.sum(F.col("excess").cast("decimal(20,9)")).cast("double").alias("_ex"),
               (F.avg("p_b") * 100).alias("flagged_by_both_pct"))
    s2 = a.agg(F.sum("freight_value").alias("_all"),
               (F.sum(F.col("p_a") * F.col("p_b")) / F.sum(F.greatest("p_a", "p_b"))).alias("jaccard"))
    j = attach(attach(s1, s2), top)
    return j.select("items_flagged", *_s("mean_actual", "mean_expected", "mean_excess"),
                    r(F.col("_ex") / F.col("_all") * 100, 6).alias("excess_pct_of_freight"),
                    r(F.col("_top") / F.col("items_flagged") * 100, 6).alias("top_sellers_flag_pct"),
                    *_s("flagged_by_both_pct", "jaccard"))


@query("aud05_concentration", """
WITH f AS (SELECT * FROM f_audit WHERE p_a = 1),
k AS (SELECT greatest(1, CAST(floor(0.05 * count(DISTINCT seller_id)) AS BIGINT)) AS k FROM f_audit),
bf AS (SELECT seller_id FROM (SELECT seller_id, row_number() OVER (ORDER BY count(*) DESC, seller_id) AS rk
                              FROM f GROUP BY 1), k WHERE rk <= k.k),
bi AS (SELECT seller_id FROM (SELECT seller_id, row_number() OVER (ORDER BY count(*) DESC, seller_id) AS rk
                              FROM f_audit GROUP BY 1), k WHERE rk <= k.k)
SELECT round_even((SELECT median(markup) FROM f), 6) AS median_markup,
       round_even((SELECT avg((seller_id IN (SELECT seller_id FROM bf))::INT) FROM f) * 100, 6) AS by_flags_pct_of_flags,
       round_even((SELECT avg((seller_id IN (SELECT seller_id FROM bf))::INT) FROM f_audit) * 100, 6) AS by_flags_pct_of_items,
       round_even((SELECT avg((seller_id IN (SELECT seller_id FROM bi))::INT) FROM f_audit) * 100, 6) AS by_items_pct_of_items,
       round_even((SELECT avg((seller_id IN (SELECT seller_id FROM bi))::INT) FROM f) * 100, 6) AS by_items_pct_of_flags
""")
def aud05_concentration(spark, sf):
    """AUD-5 / JON-7: median markup of flagged items; top 5% of sellers by flags and by items (ties by seller
    id), and their shares of flags and of items (semi joins)."""
    a = audited(market(spark, sf))
    f = a.filter(F.col("p_a") == 1)
    k = a.agg(F.greatest(F.lit(1), F.floor(F.lit(0.05) * F.count_distinct("seller_id"))).alias("k"))

    def top(df):
        c = df.groupBy("seller_id").agg(F.count(F.lit(1)).alias("c"))
        c = attach(global_running(c, [F.desc("c"), F.asc("seller_id")], index_col="rk"), k)
        return c.filter(F.col("rk") <= F.col("k")).select("seller_id", F.lit(1).alias("_in"))

    def share(df, sellers, name):
        return df.join(sellers, "seller_id", "left").agg(
            r(F.avg(F.coalesce("_in", F.lit(0))) * 100, 6).alias(name))
    bf, bi = top(f), top(a)
    parts = [exact_quantile(f, "markup", 0.5, "_m").select(r("_m", 6).alias("median_markup")), share(f, bf, "by_flags_pct_of_flags"),
             share(a, bf, "by_flags_pct_of_items"), share(a, bi, "by_items_pct_of_items"),
             share(f, bi, "by_items_pct_of_flags")]
    out = parts[0]
    for p in parts[1:]:
        out = attach(out, p)
    return out


@query("aud05_flag_rate_by_band", """
SELECT band, round_even(avg(p_a), 6) AS flag_rate, count(*) AS n FROM f_audit GROUP BY 1
""")
def aud05_flag_rate_by_band(spark, sf):
    """AUD-5 / PRJ-13: flag rate of the primary estimate by audit price band (left-closed)."""
    a = audited(market(spark, sf))
    return a.groupBy("band").agg(r(F.avg("p_a"), 6).alias("flag_rate"), F.count(F.lit(1)).alias("n"))


@query("aud06_flag_rate_by_category", """
SELECT category, round_even(avg(p_a), 6) AS flag_rate, count(*) AS n FROM f_audit WHERE category IS NOT NULL
GROUP BY 1 HAVING count(*) >= 100 ORDER BY avg(p_a) DESC, category LIMIT 10
""")
def aud06_flag_rate_by_category(spark, sf, min_n: int = 100, k: int = 10):
    """AUD-6 / TOP-1: the k categories with the highest flag rate among those with >= min_n test lines."""
    a = audited(market(spark, sf)).filter(F.col("category").isNotNull())
    g = a.groupBy("category").agg(F.avg("p_a").alias("_fr"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_n)
    return g.orderBy(F.desc("_fr"), "category").limit(k).select("category", r("_fr", 6).alias("flag_rate"), "n")


# Band edges and labels.
QUOTE_EDGES = [0, 25, 50, 100, 200, 500, INF]
QUOTE_LABELS = ["<25", "25-50", "50-100", "100-200", "200-500", "500+"]


@query("aud07_quote_range", """
WITH b AS (SELECT *, CASE WHEN price >= 0 AND price < 25 THEN '<25' WHEN price >= 25 AND price < 50 THEN '25-50'
                          WHEN price >= 50 AND price < 100 THEN '50-100' WHEN price >= 100 AND price < 200 THEN '100-200'
                          WHEN price >= 200 AND price < 500 THEN '200-500' WHEN price >= 500 THEN '500+' END AS qband
           FROM f_audit),
m AS (SELECT qband, avg(abs(freight_value - est_a)) AS mae FROM b GROUP BY 1)
SELECT b.qband AS price_band, count(*) AS n, round_even(max(m.mae), 6) AS band_mae,
       round_even(avg(greatest(b.est_a - m.mae, 0)), 6) AS mean_quote_low,
       round_even(avg(b.est_a + m.mae), 6) AS mean_quote_high,
       round_even(avg(((b.freight_value >= greatest(b.est_a - m.mae, 0)) AND (b.freight_value <= b.est_a + m.mae))::INT), 6)
           AS share_inside
FROM b JOIN m ON b.qband = m.qband GROUP BY 1
""")
def aud07_quote_range(spark, sf):
    """AUD-7 / MET-9: quote range = estimate +- the price band's MAE, floored at 0 (band MAE broadcast back)."""
    a = audited(market(spark, sf)).withColumn("price_band", cut("price", QUOTE_EDGES, QUOTE_LABELS, right=False))
    m = a.groupBy("price_band").agg(F.avg(F.abs(F.col("freight_value") - F.col("est_a"))).alias("mae"))
    j = a.join(F.broadcast(m), "price_band")
    low = F.greatest(F.col("est_a") - F.col("mae"), F.lit(0.0))
    high = F.col("est_a") + F.col("mae")
    return j.groupBy("price_band").agg(
        F.count(F.lit(1)).alias("n"), r(F.max("mae"), 6).alias("band_mae"), r(F.avg(low), 6).alias("mean_quote_low"),
        r(F.avg(high), 6).alias("mean_quote_high"),
        r(F.avg(((F.col("freight_value") >= low) & (F.col("freight_value") <= high)).cast("int")), 6)
        .alias("share_inside"))


# Band edges and labels.
PROMISE_EDGES = [0, 14, 21, 28, 35, INF]
PROMISE_LABELS = ["< 14", "14-20", "21-27", "28-34", "35+"]

_FLAGGED_ORDERS_SQL = """
fl AS (SELECT *, row_number() OVER (ORDER BY s DESC, md5(CAST(order_id AS VARCHAR) || '-42') DESC) AS rk,
              count(*) OVER () AS n_all FROM f_test),
flagged AS (SELECT *, (rk <= round_even(n_all * 0.1, 0))::INT AS flag FROM fl)"""


@query("aud08_missed_late", f"""
WITH {_FLAGGED_ORDERS_SQL},
rt AS (SELECT n.n_name AS state, r.r_name AS region FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
x AS (SELECT f.*, rt.region,
             CASE WHEN promised_days >= 0 AND promised_days < 14 THEN '< 14' WHEN promised_days >= 14 AND promised_days < 21
                  THEN '14-20' WHEN promised_days >= 21 AND promised_days < 28 THEN '21-27'
                  WHEN promised_days >= 28 AND promised_days < 35 THEN '28-34' WHEN promised_days >= 35 THEN '35+' END
                 AS promise_band
      FROM flagged f LEFT JOIN rt ON f.customer_state = rt.state),
u AS (SELECT 'promise' AS breakdown, promise_band AS grp, * FROM x UNION ALL SELECT 'region', region, * FROM x)
SELECT breakdown, grp, count(*) AS orders, sum(y) AS late, sum(flag) AS flagged, sum(flag * y) AS caught,
       round_even(sum(flag * y) / nullif(sum(flag), 0), 6) AS precision, round_even(sum(flag * y) / nullif(sum(y), 0), 6) AS recall,
       round_even(sum(y * (1 - flag)) / (SELECT sum(y * (1 - flag)) FROM flagged), 6) AS share_of_misses
FROM u WHERE grp IS NOT NULL GROUP BY 1, 2
""")
def aud08_missed_late(spark, sf):
    """AUD-8 / SET-1: missed late orders of the top-10% rule by promise band and by region, stacked with a
    label column: orders, late, flagged, caught, precision (null when none flagged), recall, share of misses."""
    m = market(spark, sf)
    _, test = split(m)
    from ..functions.geo import region_table
    f = E.flag_top_share(test, "s", 0.1, "order_id")
    rt = region_table(m.raw("nation"), m.raw("region"))
    x = (f.join(F.broadcast(rt), f.customer_state == rt.state, "left")
         .withColumn("promise_band", cut("promised_days", PROMISE_EDGES, PROMISE_LABELS, right=False)))
    misses = f.agg(F.sum(F.col("y") * (1 - F.col("flag"))).alias("_miss"))
    parts = []
    for name, col in (("promise", "promise_band"), ("region", "region")):
        g = (x.filter(F.col(col).isNotNull()).groupBy(F.lit(name).alias("breakdown"), F.col(col).alias("grp"))
             .agg(F.count(F.lit(1)).alias("orders"), F.sum("y").alias("late"), F.sum("flag").alias("flagged"),
                  F.sum(F.col("flag") * F.col("y")).alias("caught"),
                  F.sum(F.col("y") * (1 - F.col("flag"))).alias("_m")))
        parts.append(g)
    u = attach(parts[0].unionByName(parts[1]), misses)            # SET-1: union with a label column
    return u.select("breakdown", "grp", "orders", "late", "flagged", "caught",
                    r(F.try_divide(F.col("caught"), F.col("flagged")), 6).alias("precision"),
                    r(F.try_divide(F.col("caught"), F.col("late")), 6).alias("recall"),
                    r(F.col("_m") / F.col("_miss"), 6).alias("share_of_misses"))


@query("aud09_audit_columns", """
SELECT order_id, order_item_id, round_even(excess, 6) AS excess, round_even(markup, 6) AS markup,
       fo_a * fo_b AS both, band
FROM f_audit WHERE fo_a = 1 AND band IN ('50-100', '100-200')
""")
def aud09_audit_columns(spark, sf, bands=("50-100", "100-200")):
    """AUD-9: audit columns (excess, markup null when expected <= 0, both flag, band) and a filtered view
    (flagged lines in the chosen bands, ``isin``)."""
    a = audited(market(spark, sf))
    return (a.filter((F.col("fo_a") == 1) & F.col("band").isin(*bands))
            .select("order_id", "order_item_id", r("excess", 6).alias("excess"), r("markup", 6).alias("markup"),
                    (F.col("fo_a") * F.col("fo_b")).alias("both"), "band"))


_SELLER_SQL = """
SELECT seller_id, count(*) AS items, sum(fo_a) AS n_unusual, sum(fo_a * fo_b) AS n_both,
       round_even(coalesce(sum(excess) FILTER (WHERE fo_a = 1), 0), 6) AS excess,
       round_even(median(markup) FILTER (WHERE fo_a = 1), 6) AS markup, round_even(avg(fo_a), 6) AS rate,
       round_even(coalesce(sum(excess) FILTER (WHERE fo_a = 1), 0) / sum(freight_value), 6) AS excess_share
FROM f_audit GROUP BY 1"""


def _seller_table(a):
    g = agg_with_quantiles(a, ["seller_id"], [
        F.count(F.lit(1)).alias("items"), F.sum("fo_a").alias("n_unusual"),
        F.sum(F.col("fo_a") * F.col("fo_b")).alias("n_both"),
        r(F.coalesce(F.sum(F.when(F.col("fo_a") == 1, F.col("excess"))), F.lit(0.0)), 6).alias("excess"),
        r(F.avg("fo_a"), 6).alias("rate"),
        r(F.coalesce(F.sum(F.when(F.col("fo_a") == 1, F.col("excess"))), F.lit(0.0)) / F.sum("freight_value"), 6)
        .alias("excess_share")], {"_mk": (F.when(F.col("fo_a") == 1, F.col("markup")), 0.5)})
    return g.select("seller_id", "items", "n_unusual", "n_both", "excess", r("_mk", 6).alias("markup"), "rate", "excess_share")


@query("aud10_seller_drilldown", _SELLER_SQL)
def aud10_seller_drilldown(spark, sf):
    """AUD-10: per seller: lines, unusual, unusual by both, excess on unusual lines, median markup, rate,
    excess share."""
    return _seller_table(audited(market(spark, sf)))


@query("agg50_sellers_to_audit", f"""
SELECT * FROM ({_SELLER_SQL}) WHERE items >= 30 ORDER BY rate DESC, n_unusual DESC, seller_id LIMIT 20
""")
def agg50_sellers_to_audit(spark, sf, min_items: int = 30, k: int = 20):
    """AGG-50 / TOP-1: sellers to audit: flag rate among sellers with >= min_items test lines, top k."""
    g = _seller_table(audited(market(spark, sf))).filter(F.col("items") >= min_items)
    return g.orderBy(F.desc("rate"), F.desc("n_unusual"), "seller_id").limit(k)


@query("agg51_state_table", """
WITH s AS (SELECT customer_state, count(*) AS n, sum(fo_a) AS hits, sum(fo_a * fo_b) AS both,
                  round_even(coalesce(sum(excess) FILTER (WHERE fo_a = 1), 0), 6) AS excess FROM f_audit GROUP BY 1),
st AS (SELECT DISTINCT n_name AS customer_state FROM nation)
SELECT st.customer_state, coalesce(s.n, 0) AS n, coalesce(s.hits, 0) AS hits, coalesce(s.both, 0) AS both,
       coalesce(s.excess, 0) AS excess, round_even(s.hits / nullif(s.n, 0), 6) AS rate
FROM st LEFT JOIN s ON st.customer_state = s.customer_state
UNION ALL
SELECT 'national', count(*), sum(fo_a), sum(fo_a * fo_b), round_even(coalesce(sum(excess) FILTER (WHERE fo_a = 1), 0), 6),
       round_even(avg(fo_a), 6) FROM f_audit
""")
def agg51_state_table(spark, sf):
    """AGG-51: per customer state (all states kept, right-joined to the state list): lines, hits, both,
    excess and rate, plus the national row (the closest the reference has to a rollup)."""
    m = market(spark, sf)
    a = audited(m)
    s = a.groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("n"), F.sum("fo_a").alias("hits"), F.sum(F.col("fo_a") * F.col("fo_b")).alias("both"),
        r(F.coalesce(F.sum(F.when(F.col("fo_a") == 1, F.col("excess"))), F.lit(0.0)), 6).alias("excess"))
    states = m.raw("nation").select(F.col("n_name").alias("customer_state")).distinct()
    j = states.join(s, "customer_state", "left").select(
        "customer_state", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("hits", F.lit(0)).alias("hits"),
        F.coalesce("both", F.lit(0)).alias("both"), F.coalesce("excess", F.lit(0.0)).alias("excess"),
        r(F.try_divide(F.col("hits"), F.col("n")), 6).alias("rate"))
    nat = a.agg(F.lit("national").alias("customer_state"), F.count(F.lit(1)).alias("n"), F.sum("fo_a").alias("hits"),
                F.sum(F.col("fo_a") * F.col("fo_b")).alias("both"),
                r(F.coalesce(F.sum(F.when(F.col("fo_a") == 1, F.col("excess"))), F.lit(0.0)), 6).alias("excess"),
                r(F.avg("fo_a"), 6).alias("rate"))
    return j.unionByName(nat)


# Band edges and labels.
DIST_EDGES = [0, 300, 800, 1500, INF]
DIST_LABELS = ["<300 km", "300-800 km", "800-1500 km", "1500+ km"]
KG_EDGES = [0, 1, 5, 15, INF]
KG_LABELS = ["<1 kg", "1-5 kg", "5-15 kg", "15+ kg"]


def _case_sql(x, edges, labels):
    parts = []
    for a_, b_, lab in zip(edges[:-1], edges[1:], labels):
        hi = "'inf'::DOUBLE" if b_ == INF else str(float(b_))
        parts.append(f"WHEN {x} >= {float(a_)} AND {x} < {hi} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


@query("agg52_tariff_gap_grid", f"""
WITH x AS (SELECT {_case_sql('distance_km', DIST_EDGES, DIST_LABELS)} AS dist_band,
                  {_case_sql('chargeable_kg', KG_EDGES, KG_LABELS)} AS kg_band, freight_value - est_a AS gap FROM f_audit),
g AS (SELECT dist_band, kg_band, avg(gap) AS mean_gap, count(*) AS n FROM x
      WHERE dist_band IS NOT NULL AND kg_band IS NOT NULL GROUP BY 1, 2),
grid AS (SELECT d.x AS dist_band, k.x AS kg_band FROM (SELECT unnest({list(DIST_LABELS)}) AS x) d,
                                                     (SELECT unnest({list(KG_LABELS)}) AS x) k)
SELECT grid.dist_band, grid.kg_band, coalesce(g.n, 0) AS n,
       CASE WHEN g.n >= 30 THEN round_even(g.mean_gap, 6) END AS mean_gap
FROM grid LEFT JOIN g ON grid.dist_band = g.dist_band AND grid.kg_band = g.kg_band
""")
def agg52_tariff_gap_grid(spark, sf, min_n: int = 30):
    """AGG-52: mean gap (charged - tariff) by distance band x chargeable-weight band; every cell of the label
    grid kept (the grid is an explode of the two fixed label lists), cells under min_n blanked."""
    a = audited(market(spark, sf))
    x = a.select(cut("distance_km", DIST_EDGES, DIST_LABELS, right=False).alias("dist_band"),
                 cut("chargeable_kg", KG_EDGES, KG_LABELS, right=False).alias("kg_band"),
                 (F.col("freight_value") - F.col("est_a")).alias("gap"))
    g = (x.filter(F.col("dist_band").isNotNull() & F.col("kg_band").isNotNull()).groupBy("dist_band", "kg_band")
         .agg(F.avg("gap").alias("_mg"), F.count(F.lit(1)).alias("n")))
    grid = (a.sparkSession.range(1)
            .select(F.explode(F.array(*[F.lit(v) for v in DIST_LABELS])).alias("dist_band"))
            .select("dist_band", F.explode(F.array(*[F.lit(v) for v in KG_LABELS])).alias("kg_band")))
    j = grid.join(F.broadcast(g), ["dist_band", "kg_band"], "left")
    return j.select("dist_band", "kg_band", F.coalesce("n", F.lit(0)).alias("n"),
                    F.when(F.col("n") >= min_n, r("_mg", 6)).alias("mean_gap"))


@query("agg52_gap_extremes", f"""
WITH x AS (SELECT {_case_sql('distance_km', DIST_EDGES, DIST_LABELS)} AS dist_band,
                  {_case_sql('chargeable_kg', KG_EDGES, KG_LABELS)} AS kg_band, freight_value - est_a AS gap FROM f_audit),
g AS (SELECT dist_band || ' / ' || kg_band AS cell, avg(gap) AS mean_gap FROM x
      WHERE dist_band IS NOT NULL AND kg_band IS NOT NULL GROUP BY 1, dist_band, kg_band HAVING count(*) >= 30)
SELECT arg_max(cell, mean_gap) AS most_overcharged_cell, round_even(max(mean_gap), 6) AS max_gap,
       arg_min(cell, mean_gap) AS most_undercharged_cell, round_even(min(mean_gap), 6) AS min_gap FROM g
""")
def agg52_gap_extremes(spark, sf, min_n: int = 30):
    """AGG-52: extremes of the gap grid (``max_by`` / ``min_by``)."""
    g = agg52_tariff_gap_grid(spark, sf, min_n).filter(F.col("mean_gap").isNotNull())
    cell = F.concat_ws(" / ", "dist_band", "kg_band")
    return g.agg(F.max_by(cell, "mean_gap").alias("most_overcharged_cell"), F.max("mean_gap").alias("max_gap"),
                 F.min_by(cell, "mean_gap").alias("most_undercharged_cell"), F.min("mean_gap").alias("min_gap"))


@query("aud11_weekly_monitor", f"""
WITH dl AS (SELECT *, row_number() OVER (PARTITION BY CAST(order_purchase_timestamp AS DATE)
                                         ORDER BY s DESC, md5(CAST(order_id AS VARCHAR) || '-42') DESC) AS rk,
                   count(*) OVER (PARTITION BY CAST(order_purchase_timestamp AS DATE)) AS n_day FROM f_test),
d AS (SELECT *, (rk <= round_even(n_day * 0.1, 0))::INT AS flag FROM dl),
wk AS (SELECT CAST(date_trunc('week', order_purchase_timestamp) AS DATE) AS week, count(*) AS orders, sum(y) AS late,
              median(promised_days) AS promise, sum(flag * y) AS caught FROM d GROUP BY 1 HAVING count(*) >= 5),
t AS (SELECT *, list_sort(list(promise) OVER (ORDER BY week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)) AS prev FROM wk),
m AS (SELECT *, CASE WHEN len(prev) < 2 THEN NULL WHEN len(prev) % 2 = 1 THEN prev[(len(prev) + 1) // 2]
                     ELSE (prev[len(prev) // 2] + prev[len(prev) // 2 + 1]) / 2 END AS trail FROM t)
SELECT strftime(week, '%Y-%m-%d') AS week, orders, late, caught, round_even(promise, 6) AS promise,
       round_even(late / orders, 6) AS late_rate, CASE WHEN late >= 5 THEN round_even(caught / late, 6) END AS catch_rate,
       round_even(trail, 6) AS trailing_promise, coalesce(abs(promise / trail - 1) > 0.2, false) AS alert
FROM m
""")
def aud11_weekly_monitor(spark, sf, min_orders: int = 5):
    """AUD-11 / WIN-9 / TOP-3: weekly orders, late, caught by the daily 10% list, median promise, late and catch
    rate (when >= 5 late), and the promise alert: the week's median moved > 20% from the median of the previous
    4 weeks (at least 2).  ``median`` is not allowed over a window frame, so the frame's values are collected
    (at most 4 per row) and the middle taken."""
    _, test = split(market(spark, sf))
    t = test.withColumn("day", F.to_date("order_purchase_timestamp"))
    d = E.flag_top_share(t, "s", 0.1, "order_id", keys=["day"])
    d = d.withColumn("week", F.to_date(F.date_trunc("week", "order_purchase_timestamp")))
    wk = agg_with_quantiles(d, ["week"], [F.count(F.lit(1)).alias("orders"), F.sum("y").alias("late"),
                                          F.sum(F.col("flag") * F.col("y")).alias("caught")],
                            {"promise": ("promised_days", 0.5)}).filter(F.col("orders") >= min_orders)
    frame = Window.orderBy("week").rowsBetween(-4, -1)            # one row per week: a small table
    prev = F.sort_array(F.collect_list("promise").over(frame))
    n = F.size("prev")
    mid = (F.when(n < 2, F.lit(None))
           .when(n % 2 == 1, F.element_at("prev", ((n + 1) / 2).cast("int")))
           .otherwise((F.element_at("prev", (n / 2).cast("int")) + F.element_at("prev", (n / 2 + 1).cast("int"))) / 2))
    w = wk.withColumn("prev", prev).withColumn("trailing", mid)
    return w.select(F.date_format("week", "yyyy-MM-dd").alias("week"), "orders", "late", "caught",
                    r("promise", 6).alias("promise"), r(F.col("late") / F.col("orders"), 6).alias("late_rate"),
                    F.when(F.col("late") >= 5, r(F.col("caught") / F.col("late"), 6)).alias("catch_rate"),
                    r("trailing", 6).alias("trailing_promise"),
                    F.coalesce(F.abs(F.col("promise") / F.col("trailing") - 1) > 0.2, F.lit(False)).alias("alert"))


@query("top04_review_sheet", """
WITH f AS (SELECT *, count(*) OVER (PARTITION BY order_id, product_id) AS units FROM f_audit WHERE fo_a = 1 AND fo_b = 1),
d AS (SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY resid_a DESC, order_item_id) AS k FROM f)
SELECT order_id, product_id, units, seller_id, category, price, freight_value, round_even(est_a, 6) AS expected_rs,
       round_even(excess, 6) AS excess_rs, round_even(resid_a, 9) AS resid_primary, '' AS reviewer_verdict
FROM d WHERE k = 1 ORDER BY resid_a DESC, order_id, product_id LIMIT 30
""")
def top04_review_sheet(spark, sf, n: int = 30):
    """TOP-4 / WIN-11: review sheet: lines flagged by both estimates, one row per order and product with the
    number of units, the n largest residuals, an empty verdict column."""
    a = audited(market(spark, sf)).filter((F.col("fo_a") == 1) & (F.col("fo_b") == 1))
    g = a.groupBy("order_id", "product_id").agg(
        F.count(F.lit(1)).alias("units"),
        F.max_by(F.struct("resid_a", "seller_id", "category", "price", "freight_value", "est_a", "excess"),
                 F.struct(F.col("resid_a"), -F.col("order_item_id"))).alias("x"))
    return (g.orderBy(F.desc("x.resid_a"), "order_id", "product_id").limit(n)
            .select("order_id", "product_id", "units", "x.seller_id", "x.category", "x.price", "x.freight_value",
                    r("x.est_a", 6).alias("expected_rs"), r("x.excess", 6).alias("excess_rs"),
                    r("x.resid_a", 9).alias("resid_primary"), F.lit("").alias("reviewer_verdict")))


@query("top05_review_list", """
SELECT row_number() OVER (ORDER BY fo_a * fo_b DESC, excess DESC, order_id, order_item_id) AS priority,
       order_id, order_item_id, fo_a * fo_b AS both, round_even(excess, 6) AS excess
FROM f_audit WHERE fo_a = 1 ORDER BY priority LIMIT 50
""")
def top05_review_list(spark, sf, k: int = 50):
    """TOP-5: review list ordering (both estimates first, then excess) with a priority number."""
    a = audited(market(spark, sf)).filter(F.col("fo_a") == 1).withColumn("both", F.col("fo_a") * F.col("fo_b"))
    top = a.orderBy(F.desc("both"), F.desc("excess"), "order_id", "order_item_id").limit(k)
    w = Window.orderBy(F.desc("both"), F.desc("excess"), "order_id", "order_item_id")   # over k rows only
    return top.select(F.row_number().over(w).alias("priority"), "order_id", "order_item_id", "both",
                      r("excess", 6).alias("excess"))


@query("top06_best_origins", """
WITH il AS (SELECT i.customer_state, i.seller_state, i.freight_value, i.distance_km, o.delivery_days
            FROM f_item_star i LEFT JOIN f_order_master o ON i.order_id = o.order_id
            WHERE i.customer_state IS NOT NULL AND i.seller_state IS NOT NULL),
l AS (SELECT customer_state, seller_state, count(*) AS lines, median(delivery_days) AS med_days,
             median(freight_value) AS med_freight, median(distance_km) AS med_km FROM il GROUP BY 1, 2 HAVING count(*) >= 15),
k AS (SELECT *, row_number() OVER (PARTITION BY customer_state ORDER BY med_days, seller_state) AS rank FROM l)
SELECT customer_state, seller_state, lines, rank, med_days, med_freight, round_even(med_km, 6) AS med_km,
       customer_state = seller_state AS in_state
FROM k WHERE rank <= 10 OR customer_state = seller_state
""")
def top06_best_origins(spark, sf, min_lines: int = 15, k: int = 10):
    """TOP-6: best origin states per destination: lanes with >= 15 lines, the 10 fastest by median delivery
    days (ties by state) and the in-state lane for comparison (window per destination over the lane table,
    which has one row per origin state)."""
    from .core import order_master
    m = market(spark, sf)
    it = item_star(m).filter(F.col("customer_state").isNotNull() & F.col("seller_state").isNotNull())
    il = it.join(order_master(m).select("order_id", "delivery_days"), "order_id", "left")
    lanes = agg_with_quantiles(il, ["customer_state", "seller_state"], [F.count(F.lit(1)).alias("lines")], {
        "med_days": ("delivery_days", 0.5), "med_freight": ("freight_value", 0.5), "med_km": ("distance_km", 0.5)})
    lanes = lanes.filter(F.col("lines") >= min_lines)
    ranked = lanes.withColumn("rank", F.row_number().over(
        Window.partitionBy("customer_state").orderBy("med_days", "seller_state")))
    same = F.col("customer_state") == F.col("seller_state")
    return ranked.filter((F.col("rank") <= k) | same).select(
        "customer_state", "seller_state", "lines", "rank", "med_days", "med_freight", r("med_km", 6).alias("med_km"),
        same.alias("in_state"))


@query("smp01_seeded_sample", """
SELECT order_id, order_item_id, round_even(weight_kg, 2) AS weight_kg, round_even(price, 2) AS price
FROM f_item_star WHERE weight_kg > 0 AND price > 0
ORDER BY md5(CAST(order_id AS VARCHAR) || '-' || CAST(order_item_id AS VARCHAR) || '-42') LIMIT 900
""")
def smp01_seeded_sample(spark, sf, n: int = 900, seed: int = 42):
    """SMP-1: seeded sample of at most n rows (md5 order of the row key: the same rows on any partitioning)."""
    it = item_star(market(spark, sf)).filter((F.col("weight_kg") > 0) & (F.col("price") > 0))
    key = F.md5(F.concat_ws("-", F.col("order_id").cast("string"), F.col("order_item_id").cast("string"),
                            F.lit(str(seed))))
    return it.orderBy(key).limit(n).select("order_id", "order_item_id", r("weight_kg", 2).alias("weight_kg"),
                                           r("price", 2).alias("price"))


@query("smp02_group_sample", """
WITH f AS (SELECT order_id, count(*) AS n FROM f_item_features GROUP BY 1),
t AS (SELECT count(*) AS total FROM f_item_features),
keep AS (SELECT order_id FROM f, t
         WHERE ('0x' || substr(md5(CAST(order_id AS VARCHAR) || '-42'), 1, 8))::BIGINT / 4294967296.0 < 10000.0 / t.total)
SELECT count(*) AS rows, count(DISTINCT order_id) AS orders, round_even(avg(freight_value), 6) AS mean_freight
FROM f_item_features WHERE order_id IN (SELECT order_id FROM keep)
""")
def smp02_group_sample(spark, sf, n: int = 10000, seed: int = 42):
    """SMP-2: group-preserving sample of about n rows: an order is kept when the hash of its key falls below
    n / rows, so whole orders are kept (semi join), without collecting keys."""
    it = item_features(market(spark, sf))
    total = it.agg(F.count(F.lit(1)).alias("_total"))
    u = F.conv(F.substring(E.tie_key("order_id", seed), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    keep = attach(it.select("order_id").distinct(), total).filter(u < F.lit(float(n)) / F.col("_total")).select("order_id")
    s = it.join(keep, "order_id", "left_semi")
    return s.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("order_id").alias("orders"),
                 r(F.avg("freight_value"), 6).alias("mean_freight"))



@query("dq16_one_to_one_scores", """
WITH rec AS (SELECT order_id, order_item_id, count(*) AS n_records FROM f_itest GROUP BY 1, 2),
sc AS (SELECT order_id, order_item_id, count(*) AS n_scores FROM f_audit GROUP BY 1, 2),
j AS (SELECT coalesce(rec.n_records, 0) AS n_records, coalesce(sc.n_scores, 0) AS n_scores
      FROM rec FULL JOIN sc ON rec.order_id = sc.order_id AND rec.order_item_id = sc.order_item_id)
SELECT count(*) AS keys, count(*) FILTER (WHERE n_records = 1 AND n_scores = 1) AS one_to_one,
       count(*) FILTER (WHERE n_scores = 0) AS unscored, count(*) FILTER (WHERE n_records = 0) AS orphan_scores,
       count(*) FILTER (WHERE n_records > 1 OR n_scores > 1) AS duplicated FROM j
""")
def dq16_one_to_one_scores(spark, sf):
    """DQ-16: one-to-one merge check of records and scores (full join of per-key counts): every hold-out line
    should have exactly one score; lines without an estimate (unknown distance) show up as unscored."""
    m = market(spark, sf)
    _, test = item_split(m)
    keys = ["order_id", "order_item_id"]
    rec = test.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))
    sc = audited(m).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_scores"))
    j = rec.join(sc, keys, "full").select(F.coalesce("n_records", F.lit(0)).alias("n_records"),
                                          F.coalesce("n_scores", F.lit(0)).alias("n_scores"))
    one = (F.col("n_records") == 1) & (F.col("n_scores") == 1)
    return j.agg(F.count(F.lit(1)).alias("keys"), F.count(F.when(one, F.lit(1))).alias("one_to_one"),
                 F.count(F.when(F.col("n_scores") == 0, F.lit(1))).alias("unscored"),
                 F.count(F.when(F.col("n_records") == 0, F.lit(1))).alias("orphan_scores"),
                 F.count(F.when((F.col("n_records") > 1) | (F.col("n_scores") > 1), F.lit(1))).alias("duplicated"))


@query("snk03_records_round_trip", """
SELECT count(*) AS rows, count(DISTINCT order_id) AS orders, 0 AS mismatched_keys, 0 AS rescored_differently,
       (SELECT count(*) FROM (SELECT DISTINCT category FROM f_itest)) AS mart_rows FROM f_itest
""")
def snk03_records_round_trip(spark, sf):
    """SNK-1 / SNK-2 / SNK-3: the hold-out records written to the shared folder, read back, compared per key and
    scored again (rows whose estimate differs); a mart table as one CSV file and a summary document as JSON."""
    import os
    import uuid

    from ..session import checkpoint_dir
    from ..sources.files import read_document, round_trip, write_document, write_table
    m = market(spark, sf)
    _, test = item_split(m)
    base = os.path.join(checkpoint_dir(spark), "exports", uuid.uuid4().hex)
    bad = round_trip(test.select("order_id", "order_item_id", "freight_value"), os.path.join(base, "records"),
                     ["order_id", "order_item_id"])
    keys, inputs = ["order_id", "order_item_id"], ["chargeable_kg", "distance_km", "same_state"]
    again = os.path.join(base, "inputs")
    write_table(test.select(*keys, *inputs), again)
    one = test.select(*keys, tariff(*inputs).alias("_a"))
    two = spark.read.parquet(again).select(*keys, tariff(*inputs).alias("_b"))
    differs = one.join(two, keys, "full").agg(F.count(F.when(~F.col("_a").eqNullSafe(F.col("_b")), F.lit(1))).alias("rescored_differently"))
    mart = test.groupBy("category").agg(F.count(F.lit(1)).alias("lines"))
    write_table(mart, os.path.join(base, "mart"), "csv", single_file=True)
    rows = spark.read.option("header", True).csv(os.path.join(base, "mart")).agg(F.count(F.lit(1)).alias("mart_rows"))
    summary = test.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("order_id").alias("orders"))
    write_document(summary, os.path.join(base, "summary"))
    back = read_document(spark, os.path.join(base, "summary"), summary.schema)
    return attach(attach(attach(back, bad.agg(F.count(F.lit(1)).alias("mismatched_keys"))), differs), rows)


@query("src3_upload", """
WITH u AS (SELECT order_id % 10 = 3 AS bad, * FROM f_itest)
SELECT count(*) FILTER (WHERE NOT bad) AS rows, count(*) FILTER (WHERE bad) AS rejects,
       round_even(sum(price::DECIMAL(18, 4)) FILTER (WHERE NOT bad)::DOUBLE, 2) AS price_sum,
       count(*) FILTER (WHERE NOT bad AND order_id % 7 = 0) AS bad_weights,
       count(*) FILTER (WHERE NOT bad AND order_id % 11 = 0) AS default_ids
FROM u
""")
def src3_upload(spark, sf):
    """SRC-3: the hold-out lines written as a user's CSV (aliased columns, bad numbers, missing ids) to the shared
    folder and loaded permissively: kept rows, rejects without a charge, numbers that became null, default ids."""
    import os
    import uuid

    from ..session import checkpoint_dir
    from ..sources.files import read_upload, write_table
    _, test = item_split(market(spark, sf))
    k = F.col("order_id")
    up = test.select(
        F.when(k % 11 != 0, k.cast("string")).alias("order_id"), F.col("price").cast("string").alias("price"),
        F.when(k % 10 == 3, F.lit("n/a")).otherwise(F.col("freight_value").cast("string")).alias("freight_value"),
        F.when(k % 7 == 0, F.lit("heavy")).otherwise(F.coalesce(F.col("weight_kg"), F.lit(1.0)).cast("string")).alias("weight_kg"),
        F.coalesce(F.col("volume_cm3"), F.lit(1.0)).cast("string").alias("volume_cm3"), "seller_state", "customer_state",
        F.lit("01310").alias("seller_zip_code_prefix"), F.lit("01310").alias("customer_zip_code_prefix"))
    path = os.path.join(checkpoint_dir(spark), "uploads", uuid.uuid4().hex)
    write_table(up, path, "csv")
    rows, rejects, _ = read_upload(spark, path)
    a = rows.agg(F.count(F.lit(1)).alias("rows"), r(F.sum(F.col("price").cast("decimal(18,4)")).cast("double"), 2).alias("price_sum"),
                 F.count(F.when(F.col("weight_kg").isNull(), F.lit(1))).alias("bad_weights"),
                 F.count(F.when(F.col("order_id").startswith("row "), F.lit(1))).alias("default_ids"))
    return attach(a, rejects.agg(F.count(F.lit(1)).alias("rejects")))
