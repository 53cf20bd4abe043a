"""Statistics queries (STA-1 .. STA-7, STA-10, WIN-8, SHP-2)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import nan_max, r
from ..operators import stats as S
from ..operators.mart import pct
from ..operators.ranking import agg_with_quantiles, exact_quantiles
from ..registry import query
from ..sources.fixtures import market
from .core import delivered_orders, item_star
from .q_mart2 import _freight_population, seller_month_panel

_CORE_SQL = """
core AS (SELECT *, CASE WHEN weight_kg IS NULL OR volumetric_weight_kg IS NULL THEN NULL
                        ELSE greatest(weight_kg, volumetric_weight_kg) END AS ckg
         FROM f_item_star
         WHERE freight_ratio IS NOT NULL AND price > 0 AND freight_value >= 0 AND distance_km IS NOT NULL
           AND weight_kg IS NOT NULL AND volumetric_weight_kg IS NOT NULL AND weight_kg > 0)"""


def _core(m):
    f = _freight_population(item_star(m))
    f = f.filter(F.col("distance_km").isNotNull() & F.col("weight_kg").isNotNull()
                 & F.col("volumetric_weight_kg").isNotNull() & (F.col("weight_kg") > 0))
    return f.withColumn("ckg", nan_max("weight_kg", "volumetric_weight_kg"))


@query("sta01_freight_correlations", f"""
WITH {_CORE_SQL}
SELECT count(*) AS n, round_even(corr(weight_kg, freight_value), 6) AS corr_freight_weight,
       round_even(corr(volumetric_weight_kg, freight_value), 6) AS corr_freight_volume,
       round_even(corr(distance_km, freight_value), 6) AS corr_freight_distance,
       round_even(corr(price, freight_value), 6) AS corr_freight_price,
       round_even(corr(ckg, freight_value), 6) AS corr_freight_chargeable
FROM core
""")
def sta01_freight_correlations(spark, sf):
    """STA-1 / PRJ-2: Pearson correlation of freight with weight, volumetric weight, distance, price and
    chargeable weight (lines with all drivers known)."""
    c = _core(market(spark, sf))
    v = "freight_value"
    return c.agg(F.count(F.lit(1)).alias("n"),
                 r(F.corr("weight_kg", v), 6).alias("corr_freight_weight"),
                 r(F.corr("volumetric_weight_kg", v), 6).alias("corr_freight_volume"),
                 r(F.corr("distance_km", v), 6).alias("corr_freight_distance"),
                 r(F.corr("price", v), 6).alias("corr_freight_price"),
                 r(F.corr("ckg", v), 6).alias("corr_freight_chargeable"))


def _corr_sql(src, cols, digits=4):
    parts = []
    for a in cols:
        for b in cols:
            parts.append(f"SELECT '{a}' AS var, '{b}' AS other, round_even(corr({a}, {b}), {digits}) AS corr FROM {src}")
    return "\nUNION ALL ".join(parts)


DRIVER_COLS = ["price", "freight_value", "freight_ratio", "weight_kg", "volumetric_weight_kg", "distance_km"]
REVIEW_COLS = ["order_total", "freight_total", "freight_ratio", "n_items", "delivery_days", "days_late",
               "review_score", "max_installments"]


@query("sta02_driver_corr_matrix", f"WITH {_CORE_SQL}\n" + _corr_sql("core", DRIVER_COLS))
def sta02_driver_corr_matrix(spark, sf):
    """STA-2: freight driver correlation matrix (long form)."""
    return S.corr_long(_core(market(spark, sf)), DRIVER_COLS)


@query("sta02_review_corr_matrix",
       "WITH rel AS (SELECT * FROM f_delivered WHERE review_score IS NOT NULL)\n" + _corr_sql("rel", REVIEW_COLS))
def sta02_review_corr_matrix(spark, sf):
    """STA-2: order-level correlation matrix around the review score (pairwise complete)."""
    rel = delivered_orders(market(spark, sf)).filter(F.col("review_score").isNotNull())
    return S.corr_long(rel, REVIEW_COLS)


def _spearman_sql(src, x, y):
    return f"""
WITH p AS (SELECT {x} AS x, {y} AS y FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
k AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM p)
SELECT round_even(corr(rx, ry), 6) AS spearman, count(*) AS n FROM k"""


@query("sta03_spearman_weight_price", "WITH pw AS (SELECT * FROM f_item_star WHERE weight_kg > 0 AND price > 0)"
       + _spearman_sql("pw", "weight_kg", "price").replace("WITH p AS", ", p AS", 1))
def sta03_spearman_weight_price(spark, sf):
    """STA-3: Spearman correlation (average ranks on ties) of weight and price."""
    it = item_star(market(spark, sf)).filter((F.col("weight_kg") > 0) & (F.col("price") > 0))
    s = S.spearman(it, "weight_kg", "price")
    return s.select(r("spearman", 6).alias("spearman"), "n")


@query("sta03_spearman_distance_freight", "WITH pw AS (SELECT * FROM f_item_star)"
       + _spearman_sql("pw", "distance_km", "freight_value").replace("WITH p AS", ", p AS", 1))
def sta03_spearman_distance_freight(spark, sf):
    """STA-3: Spearman correlation of distance and freight."""
    s = S.spearman(item_star(market(spark, sf)), "distance_km", "freight_value")
    return s.select(r("spearman", 6).alias("spearman"), "n")


@query("sta04_price_burden_over_categories", """
WITH c AS (SELECT category, count(order_item_id) AS lines, median(price) AS med_price,
                  median(freight_ratio) AS med_ratio FROM f_item_star WHERE category IS NOT NULL GROUP BY 1)
SELECT count(*) AS categories, round_even(corr(ln(med_price), med_ratio), 6) AS corr_price_burden
FROM c WHERE lines >= 300
""")
def sta04_price_burden_over_categories(spark, sf, min_lines: int = 300):
    """STA-4: correlation of log median price and median burden across categories with >= min_lines lines."""
    it = item_star(market(spark, sf)).filter(F.col("category").isNotNull())
    c = agg_with_quantiles(it, ["category"], [F.count("order_item_id").alias("lines")],
                           {"mp": ("price", 0.5), "mr": ("freight_ratio", 0.5)})
    c = c.filter(F.col("lines") >= min_lines)
    return c.agg(F.count(F.lit(1)).alias("categories"), r(F.corr(F.log("mp"), F.col("mr")), 6).alias("corr_price_burden"))


# ---------------------------------------------------------------- seller panel: lag, autocorrelation, at-risk
LAG_COLS = ["avg_review_score", "late_rate", "revenue", "avg_delivery_days"]

_PANEL_SQL = """
base AS (SELECT i.order_id, i.order_item_id, i.seller_id, i.price, i.freight_value, o.review_score, o.purchase_month,
                coalesce(o.order_delivered_customer_date > o.order_estimated_delivery_date, false)::INT AS is_late_ts,
                epoch_us(o.order_delivered_customer_date) - epoch_us(o.order_purchase_timestamp) AS delivery_us
         FROM f_items i JOIN f_delivered o ON i.order_id = o.order_id),
sm AS (SELECT seller_id, count(DISTINCT purchase_month) AS k FROM base GROUP BY 1),
panel AS (SELECT seller_id, purchase_month, sum(price) AS revenue, count(DISTINCT order_id) AS n_orders,
                 avg(review_score) AS avg_review_score, avg(is_late_ts) AS late_rate,
                 sum(delivery_us) / count(delivery_us) / 86400000000.0 AS avg_delivery_days
          FROM base WHERE seller_id IN (SELECT seller_id FROM sm WHERE k >= 3) GROUP BY 1, 2),
lagged AS (SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY purchase_month) - 1 AS month_rank,
                  lag(purchase_month) OVER (PARTITION BY seller_id ORDER BY purchase_month) AS prev_month,
                  lag(avg_review_score) OVER (PARTITION BY seller_id ORDER BY purchase_month) AS avg_review_score_prev,
                  lag(late_rate) OVER (PARTITION BY seller_id ORDER BY purchase_month) AS late_rate_prev,
                  lag(revenue) OVER (PARTITION BY seller_id ORDER BY purchase_month) AS revenue_prev,
                  lag(avg_delivery_days) OVER (PARTITION BY seller_id ORDER BY purchase_month) AS avg_delivery_days_prev
           FROM panel),
lag_valid AS (SELECT * FROM lagged WHERE avg_review_score_prev IS NOT NULL AND late_rate_prev IS NOT NULL
              AND revenue_prev IS NOT NULL AND avg_delivery_days_prev IS NOT NULL)"""


def _lagged(m):
    """WIN-8: previous active month per seller (lag 1) and 0-based month rank.  Each seller's partition
    holds at most one row per calendar month, so the window is bounded."""
    p = seller_month_panel(m)
    w = Window.partitionBy("seller_id").orderBy("purchase_month")
    return p.select("*", (F.row_number().over(w) - 1).alias("month_rank"),
                    F.lag("purchase_month").over(w).alias("prev_month"),
                    *[F.lag(c).over(w).alias(f"{c}_prev") for c in LAG_COLS])


def _lag_valid(m):
    lg = _lagged(m)
    cond = None
    for c in LAG_COLS:
        e = F.col(f"{c}_prev").isNotNull()
        cond = e if cond is None else cond & e
    return lg.filter(cond)


@query("win08_seller_prev_month", f"""
WITH {_PANEL_SQL}
SELECT seller_id, purchase_month, month_rank, prev_month, round_even(revenue, 2) AS revenue,
       round_even(revenue_prev, 2) AS revenue_prev FROM lagged
""")
def win08_seller_prev_month(spark, sf):
    """WIN-8: previous active month (lag 1) and month rank per seller in the seller-month panel."""
    lg = _lagged(market(spark, sf))
    return lg.select("seller_id", "purchase_month", "month_rank", "prev_month", r("revenue", 2).alias("revenue"),
                     r("revenue_prev", 2).alias("revenue_prev"))


@query("sta05_seller_autocorrelation", f"""
WITH {_PANEL_SQL},
q AS (SELECT quantile_cont(revenue, 0.99) AS qc, quantile_cont(revenue_prev, 0.99) AS qp FROM lag_valid)
SELECT 'avg_review_score' AS metric, 'all' AS variant, count(*) AS n,
       round_even(corr(avg_review_score_prev, avg_review_score), 6) AS r FROM lag_valid
UNION ALL SELECT 'late_rate', 'all', count(*), round_even(corr(late_rate_prev, late_rate), 6) FROM lag_valid
UNION ALL SELECT 'revenue', 'all', count(*), round_even(corr(revenue_prev, revenue), 6) FROM lag_valid
UNION ALL SELECT 'avg_delivery_days', 'all', count(*), round_even(corr(avg_delivery_days_prev, avg_delivery_days), 6)
          FROM lag_valid
UNION ALL SELECT 'revenue', 'p99_trimmed', count(*), round_even(corr(revenue_prev, revenue), 6)
          FROM lag_valid, q WHERE revenue < q.qc AND revenue_prev < q.qp
UNION ALL SELECT 'avg_review_score', 'min_orders_' || k, count(*),
                 round_even(corr(avg_review_score_prev, avg_review_score), 6)
          FROM lag_valid, (VALUES (1), (3), (5), (10)) t(k) WHERE n_orders >= k GROUP BY k HAVING count(*) > 30
""")
def sta05_seller_autocorrelation(spark, sf):
    """STA-5: month-over-month autocorrelation of seller metrics (previous active month), the p99-trimmed
    revenue variant, and review autocorrelation by minimum monthly volume (kept when n > 30)."""
    lv = _lag_valid(market(spark, sf))
    parts = []
    for c in LAG_COLS:
        parts.append(lv.agg(F.lit(c).alias("metric"), F.lit("all").alias("variant"), F.count(F.lit(1)).alias("n"),
                            r(F.corr(f"{c}_prev", c), 6).alias("r")))
    q = exact_quantiles(lv, {"qc": ("revenue", 0.99), "qp": ("revenue_prev", 0.99)})
    trimmed = (lv.withColumn("_one", F.lit(1)).join(F.broadcast(q.withColumn("_one", F.lit(1))), "_one")
               .filter((F.col("revenue") < F.col("qc")) & (F.col("revenue_prev") < F.col("qp"))))
    parts.append(trimmed.agg(F.lit("revenue").alias("metric"), F.lit("p99_trimmed").alias("variant"),
                             F.count(F.lit(1)).alias("n"), r(F.corr("revenue_prev", "revenue"), 6).alias("r")))
    ks = lv.select("*", F.explode(F.array(*[F.lit(k) for k in (1, 3, 5, 10)])).alias("k")).filter(
        F.col("n_orders") >= F.col("k"))
    by_k = (ks.groupBy("k").agg(F.count(F.lit(1)).alias("n"),
                                r(F.corr("avg_review_score_prev", "avg_review_score"), 6).alias("r"))
            .filter(F.col("n") > 30)
            .select(F.lit("avg_review_score").alias("metric"),
                    F.concat(F.lit("min_orders_"), F.col("k").cast("string")).alias("variant"), "n", "r"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.unionByName(by_k)


def _at_risk(review, late, review_line=3.5, late_line=0.15):
    """A null comparison counts as false, as in pandas."""
    return (F.coalesce(F.col(review) < review_line, F.lit(False))
            | F.coalesce(F.col(late) > late_line, F.lit(False))).cast("int")


@query("sta06_at_risk_rate", f"""
WITH {_PANEL_SQL}
SELECT count(*) AS seller_months,
       round_even(avg((coalesce(avg_review_score < 3.5, false) OR coalesce(late_rate > 0.15, false))::INT) * 100, 1)
           AS at_risk_pct
FROM lagged
""")
def sta06_at_risk_rate(spark, sf):
    """STA-6: share of seller-months at risk (mean review < 3.5 or late rate > 15%)."""
    lg = _lagged(market(spark, sf)).withColumn("at_risk", _at_risk("avg_review_score", "late_rate"))
    return lg.agg(F.count(F.lit(1)).alias("seller_months"), r(F.avg("at_risk") * 100, 1).alias("at_risk_pct"))


@query("shp02_at_risk_transition", f"""
WITH {_PANEL_SQL},
t AS (SELECT (coalesce(avg_review_score_prev < 3.5, false) OR coalesce(late_rate_prev > 0.15, false))::INT AS prev_state,
             (coalesce(avg_review_score < 3.5, false) OR coalesce(late_rate > 0.15, false))::INT AS now_state
      FROM lagged)
SELECT prev_state, round_even(avg((now_state = 0)::INT) * 100, 1) AS now_healthy_pct,
       round_even(avg((now_state = 1)::INT) * 100, 1) AS now_at_risk_pct, count(*) AS n
FROM t GROUP BY 1
""")
def shp02_at_risk_transition(spark, sf):
    """SHP-2 / STA-6: row-normalised transition matrix of the at-risk state (previous -> current month)."""
    lg = _lagged(market(spark, sf)).select(
        _at_risk("avg_review_score_prev", "late_rate_prev").alias("prev_state"),
        _at_risk("avg_review_score", "late_rate").alias("now_state"))
    p = lg.groupBy("prev_state").pivot("now_state", [0, 1]).count().na.fill(0)
    tot = F.col("0") + F.col("1")
    return p.select("prev_state", r(F.col("0") / tot * 100, 1).alias("now_healthy_pct"),
                    r(F.col("1") / tot * 100, 1).alias("now_at_risk_pct"), tot.alias("n"))


@query("sta07_naive_forecast", f"""
WITH {_PANEL_SQL},
v AS (SELECT * FROM lag_valid WHERE revenue IS NOT NULL AND revenue_prev IS NOT NULL),
m AS (SELECT avg(revenue) AS mu FROM v)
SELECT count(*) AS n, round_even(avg(abs(revenue - revenue_prev)), 4) AS persistence_mae,
       round_even(avg(abs(revenue - m.mu)), 4) AS mean_mae,
       round_even((1 - avg(abs(revenue - revenue_prev)) / avg(abs(revenue - m.mu))) * 100, 2) AS gain_pct
FROM v, m GROUP BY m.mu
""")
def sta07_naive_forecast(spark, sf):
    """STA-7: persistence (t = t-1) vs mean-only revenue baselines: MAE of each and relative gain."""
    v = _lag_valid(market(spark, sf)).filter(F.col("revenue").isNotNull() & F.col("revenue_prev").isNotNull())
    mu = v.agg(F.avg("revenue").alias("mu"))
    j = v.withColumn("_one", F.lit(1)).join(F.broadcast(mu.withColumn("_one", F.lit(1))), "_one")
    pers = F.avg(F.abs(F.col("revenue") - F.col("revenue_prev")))
    mean = F.avg(F.abs(F.col("revenue") - F.col("mu")))
    return j.agg(F.count(F.lit(1)).alias("n"), r(pers, 4).alias("persistence_mae"), r(mean, 4).alias("mean_mae"),
                 r((F.lit(1) - pers / mean) * 100, 2).alias("gain_pct"))


__all__ = ["pct"]
