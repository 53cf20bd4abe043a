"""Aggregate mart, part 2: payments, freight economics, determinism cells,
reviews, seller panel, promise and lateness trends (AGG-23 .. AGG-55)."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import cut, frac_days, micros, r
from ..operators import mart as M
from ..operators.mart import pct
from ..operators.ranking import agg_with_quantiles, exact_quantile
from ..registry import query
from ..sources.fixtures import market
from .core import _cached, dated_delivered, delivered_orders, item_star, order_features, order_master

INF = math.inf


def _m(spark, sf):
    return market(spark, sf)


# ---------------------------------------------------------------- categories and states by revenue (AGG-23)
@query("agg23_category_revenue", """
SELECT category, round_even(sum(order_total), 2) AS revenue, count(DISTINCT order_id) AS orders,
       round_even(avg(review_score), 4) AS avg_review
FROM f_delivered WHERE category IS NOT NULL
GROUP BY 1 ORDER BY sum(order_total) DESC, category LIMIT 15
""")
def agg23_category_revenue(spark, sf):
    """AGG-23 / TOP-1: top 15 categories of delivered orders by revenue, with orders and mean review."""
    d = delivered_orders(_m(spark, sf)).filter(F.col("category").isNotNull())
    g = d.groupBy("category").agg(F.sum("order_total").alias("rev"), F.count_distinct("order_id").alias("orders"),
                                  r(F.avg("review_score"), 4).alias("avg_review"))
    return (g.orderBy(F.desc("rev"), "category").limit(15)
            .select("category", r("rev", 2).alias("revenue"), "orders", "avg_review"))


@query("agg23_state_revenue", """
SELECT customer_state, count(DISTINCT order_id) AS orders, round_even(sum(order_total), 2) AS revenue
FROM f_delivered WHERE customer_state IS NOT NULL GROUP BY 1
""")
def agg23_state_revenue(spark, sf):
    """AGG-23: delivered orders and revenue by customer state."""
    d = delivered_orders(_m(spark, sf)).filter(F.col("customer_state").isNotNull())
    return d.groupBy("customer_state").agg(F.count_distinct("order_id").alias("orders"),
                                           r(F.sum("order_total"), 2).alias("revenue"))


# ---------------------------------------------------------------- payments (AGG-24..27)
@query("agg24_payment_mix", """
WITH g AS (SELECT payment_type, count(*) / sum(count(*)) OVER () * 100 AS p FROM f_payments GROUP BY 1)
SELECT payment_type, round_even(p, 1) AS pct FROM g WHERE p >= 0.1
""")
def agg24_payment_mix(spark, sf):
    """AGG-24: payment rows by type in % (types under 0.1% dropped)."""
    g = _m(spark, sf).payments.groupBy("payment_type").agg(F.count(F.lit(1)).alias("n"))
    g = g.select("payment_type", (F.col("n") / F.sum("n").over(Window.partitionBy()) * 100).alias("p"))
    return g.filter(F.col("p") >= 0.1).select("payment_type", r("p", 1).alias("pct"))


@query("agg25_installments", """
WITH c AS (SELECT least(payment_installments, 11) AS k FROM f_payments
           WHERE payment_type = 'credit_card' AND payment_installments > 0)
SELECT CASE WHEN k < 11 THEN CAST(k AS VARCHAR) ELSE '11+' END AS installments,
       round_even(count(*) / (SELECT count(*) FROM c) * 100, 1) AS pct
FROM c GROUP BY k
""")
def agg25_installments(spark, sf):
    """AGG-25: card instalment distribution with an 11+ bucket, in %."""
    p = _m(spark, sf).payments
    c = p.filter((F.col("payment_type") == "credit_card") & (F.col("payment_installments") > 0))
    g = c.groupBy(F.least("payment_installments", F.lit(11)).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.when(F.col("k") < 11, F.col("k").cast("string")).otherwise(F.lit("11+")).alias("installments"),
                    r(F.col("n") / F.sum("n").over(Window.partitionBy()) * 100, 1).alias("pct"))


@query("agg25_installment_stats", """
SELECT round_even(avg((payment_installments > 1)::INT) * 100, 3) AS inst_pct,
       median(payment_installments) AS inst_median, quantile_cont(payment_installments, 0.9) AS inst_p90
FROM f_payments WHERE payment_type = 'credit_card' AND payment_installments > 0
""")
def agg25_installment_stats(spark, sf):
    """AGG-25: share of card payments in more than one instalment, median and p90."""
    p = _m(spark, sf).payments
    c = p.filter((F.col("payment_type") == "credit_card") & (F.col("payment_installments") > 0))
    return c.agg(r(pct(F.col("payment_installments") > 1), 3).alias("inst_pct"),
                 F.median("payment_installments").alias("inst_median"),
                 F.percentile("payment_installments", 0.9).alias("inst_p90"))


@query("agg26_order_value_by_installment", """
SELECT max_installments, round_even(median(order_total), 1) AS median_order_value, count(*) AS n
FROM f_order_master WHERE max_installments BETWEEN 1 AND 12 AND order_total IS NOT NULL
GROUP BY 1 HAVING count(*) >= 500
""")
def agg26_order_value_by_installment(spark, sf, min_n: int = 500):
    """AGG-26 / PRJ-22: median order value by instalment count 1..12 (groups of at least ``min_n``)."""
    o = order_master(_m(spark, sf)).filter(F.col("max_installments").between(1, 12) & F.col("order_total").isNotNull())
    g = o.groupBy("max_installments").agg(r(F.median("order_total"), 1).alias("median_order_value"),
                                          F.count(F.lit(1)).alias("n"))
    return g.filter(F.col("n") >= min_n)


@query("agg27_installment_share_by_type", """
WITH t AS (SELECT payment_type, count(DISTINCT order_id) AS total_orders FROM f_payments GROUP BY 1),
i AS (SELECT payment_type, count(DISTINCT order_id) AS orders_with_installments FROM f_payments
      WHERE payment_installments > 0 GROUP BY 1)
SELECT coalesce(t.payment_type, i.payment_type) AS payment_type, coalesce(t.total_orders, 0) AS total_orders,
       coalesce(i.orders_with_installments, 0) AS orders_with_installments,
       round_even(coalesce(i.orders_with_installments, 0) / t.total_orders * 100, 2) AS pct_with_installments
FROM t FULL JOIN i ON t.payment_type = i.payment_type
""")
def agg27_installment_share_by_type(spark, sf):
    """AGG-27 / JON-6: orders with instalments as % of each payment type's orders (full outer, null -> 0)."""
    p = _m(spark, sf).payments
    t = p.groupBy("payment_type").agg(F.count_distinct("order_id").alias("total_orders"))
    i = (p.filter(F.col("payment_installments") > 0).groupBy("payment_type")
         .agg(F.count_distinct("order_id").alias("orders_with_installments")))
    j = t.join(i, "payment_type", "full").na.fill(0, ["total_orders", "orders_with_installments"])
    return j.select("payment_type", "total_orders", "orders_with_installments",
                    r(F.col("orders_with_installments") / F.col("total_orders") * 100, 2).alias("pct_with_installments"))


# ---------------------------------------------------------------- freight economics (AGG-28..31)
def _freight_population(items):
    """Lines with a defined ratio, positive price and non-negative freight."""
    return items.filter(F.col("freight_ratio").isNotNull() & (F.col("price") > 0) & (F.col("freight_value") >= 0))


@query("agg28_freight_headline", """
WITH f AS (SELECT * FROM f_item_star WHERE freight_ratio IS NOT NULL AND price > 0 AND freight_value >= 0)
SELECT round_even((SELECT median(freight_ratio) FROM f) * 100, 3) AS median_freight_ratio,
       round_even((SELECT avg(freight_ratio) FROM f) * 100, 3) AS mean_freight_ratio,
       round_even((SELECT avg((freight_ratio > 0.25)::INT) FROM f) * 100, 3) AS pct_high_freight,
       round_even((SELECT avg((freight_value = 0)::INT) FROM f) * 100, 3) AS pct_free_shipping,
       round_even(sum(freight_value) / (sum(freight_value) + sum(price)) * 100, 3) AS freight_pct_gmv
FROM f_item_star
""")
def agg28_freight_headline(spark, sf):
    """AGG-28: freight share of GMV, median / mean ratio, share above 25%, free-shipping share."""
    items = item_star(_m(spark, sf))
    f = agg_with_quantiles(_freight_population(items), [], [
        r(F.avg("freight_ratio") * 100, 3).alias("mean_freight_ratio"),
        r(pct(F.col("freight_ratio") > 0.25), 3).alias("pct_high_freight"),
        r(pct(F.col("freight_value") == 0), 3).alias("pct_free_shipping")], {"_med": ("freight_ratio", 0.5)})
    f = f.withColumn("median_freight_ratio", r(F.col("_med") * 100, 3)).drop("_med")
    g = items.agg(r(F.sum("freight_value") / (F.sum("freight_value") + F.sum("price")) * 100, 3)
                  .alias("freight_pct_gmv"))
    return _one_row_pair(f, g)


# Band edges and labels.
PRICE_EDGES = [0, 30, 60, 100, 200, 500, INF]
PRICE_LABELS = ["<30", "30-60", "60-100", "100-200", "200-500", "500+"]


@query("agg29_price_band", """
WITH f AS (SELECT *, CASE WHEN price > 0 AND price <= 30 THEN '<30' WHEN price > 30 AND price <= 60 THEN '30-60'
                          WHEN price > 60 AND price <= 100 THEN '60-100' WHEN price > 100 AND price <= 200
                          THEN '100-200' WHEN price > 200 AND price <= 500 THEN '200-500'
                          WHEN price > 500 THEN '500+' END AS price_band
           FROM f_item_star WHERE freight_ratio IS NOT NULL AND price > 0 AND freight_value >= 0)
SELECT price_band, median(freight_value) AS median_freight, round_even(median(freight_ratio) * 100, 1) AS median_burden,
       count(*) AS n
FROM f WHERE price_band IS NOT NULL GROUP BY 1
""")
def agg29_price_band(spark, sf):
    """AGG-29 / PRJ-12: price bands (right-closed): median freight, median burden %, lines."""
    f = _freight_population(item_star(_m(spark, sf))).withColumn("price_band", cut("price", PRICE_EDGES, PRICE_LABELS))
    g = agg_with_quantiles(f.filter(F.col("price_band").isNotNull()), ["price_band"], [F.count(F.lit(1)).alias("n")],
                           {"median_freight": ("freight_value", 0.5), "mr": ("freight_ratio", 0.5)})
    return g.select("price_band", "median_freight", r(F.col("mr") * 100, 1).alias("median_burden"), "n")


@query("agg30_category_burden", """
SELECT category, round_even(median(freight_ratio) * 100, 1) AS median_burden, median(freight_value) AS median_freight,
       median(price) AS median_price, count(*) AS n
FROM f_item_star WHERE freight_ratio IS NOT NULL AND price > 0 AND freight_value >= 0 AND category IS NOT NULL
GROUP BY 1 HAVING count(*) >= 200
""")
def agg30_category_burden(spark, sf, min_n: int = 200):
    """AGG-30 / PRJ-22: per category median burden, freight and price, categories with at least ``min_n`` lines."""
    f = _freight_population(item_star(_m(spark, sf))).filter(F.col("category").isNotNull())
    g = agg_with_quantiles(f, ["category"], [F.count(F.lit(1)).alias("n")], {
        "mr": ("freight_ratio", 0.5), "median_freight": ("freight_value", 0.5), "median_price": ("price", 0.5)})
    return g.filter(F.col("n") >= min_n).select("category", r(F.col("mr") * 100, 1).alias("median_burden"),
                                                "median_freight", "median_price", "n")


@query("agg31_top_categories_by_freight", """
SELECT category, median(freight_value) AS median_freight, count(*) AS n
FROM f_item_star WHERE category IS NOT NULL AND freight_value IS NOT NULL
GROUP BY 1 HAVING count(*) >= 50 ORDER BY median(freight_value) DESC, category LIMIT 10
""")
def agg31_top_categories_by_freight(spark, sf, min_n: int = 50, k: int = 10):
    """AGG-31 / TOP-1: the k categories with the highest median freight (n >= min_n)."""
    items = item_star(_m(spark, sf)).filter(F.col("category").isNotNull() & F.col("freight_value").isNotNull())
    g = items.groupBy("category").agg(F.median("freight_value").alias("median_freight"), F.count(F.lit(1)).alias("n"))
    return g.filter(F.col("n") >= min_n).orderBy(F.desc("median_freight"), "category").limit(k)


# ---------------------------------------------------------------- determinism cells (AGG-32..34)
# Band edges and labels.
W_EDGES = [0, 300, 500, 750, 1000, 1500, 2000, 3000, 5000, 10000, INF]
V_EDGES = [0, 1000, 2000, 4000, 8000, 16000, 32000, INF]
D_EDGES = [0, 50, 100, 200, 300, 500, 750, 1000, 1500, 2000, INF]
_CELL_SQL = """
f_cells AS (
  SELECT *,
    CASE {w} END AS wbin, CASE {v} END AS vbin, CASE {d} END AS dbin
  FROM f_item_star
  WHERE freight_ratio IS NOT NULL AND price > 0 AND freight_value >= 0 AND distance_km IS NOT NULL
    AND weight_kg IS NOT NULL AND volumetric_weight_kg IS NOT NULL AND weight_kg > 0 AND volume_cm3 > 0
    AND freight_value > 0)"""


def _case(x, edges):
    parts = []
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        hi = "'inf'::DOUBLE" if b == INF else f"{float(b)}"
        parts.append(f"WHEN {x} > {float(a)} AND {x} <= {hi} THEN {i}")
    return " ".join(parts)


CELL_CTE = _CELL_SQL.format(w=_case("weight_kg * 1000", W_EDGES), v=_case("volume_cm3", V_EDGES),
                            d=_case("distance_km", D_EDGES))


def _cells_population(items):
    core = _freight_population(items).filter(
        F.col("distance_km").isNotNull() & F.col("weight_kg").isNotNull() & F.col("volumetric_weight_kg").isNotNull()
        & (F.col("weight_kg") > 0) & (F.col("volume_cm3") > 0) & (F.col("freight_value") > 0))
    return core.select("*", cut(F.col("weight_kg") * 1000, W_EDGES, [str(i) for i in range(10)]).cast("int")
                       .alias("wbin"),
                       cut("volume_cm3", V_EDGES, [str(i) for i in range(7)]).cast("int").alias("vbin"),
                       cut("distance_km", D_EDGES, [str(i) for i in range(10)]).cast("int").alias("dbin"))


def _cells(items, min_n):
    g = _cells_population(items).groupBy("wbin", "vbin", "dbin").agg(
        F.count(F.lit(1)).alias("n"), F.percentile("freight_value", 0.1).alias("p10"),
        F.median("freight_value").alias("p50"), F.percentile("freight_value", 0.9).alias("p90"))
    return g.filter(F.col("n") >= min_n).withColumn("p90_over_p10", F.col("p90") / F.col("p10"))


@query("agg32_freight_cells", f"""
WITH {CELL_CTE}
SELECT wbin, vbin, dbin, count(*) AS n, round_even(quantile_cont(freight_value, 0.1), 2) AS p10,
       round_even(median(freight_value), 2) AS p50, round_even(quantile_cont(freight_value, 0.9), 2) AS p90,
       round_even(quantile_cont(freight_value, 0.9) / quantile_cont(freight_value, 0.1), 2) AS p90_over_p10
FROM f_cells WHERE wbin IS NOT NULL AND vbin IS NOT NULL AND dbin IS NOT NULL
GROUP BY 1, 2, 3 HAVING count(*) >= 10
""")
def agg32_freight_cells(spark, sf, min_n: int = 10):
    """AGG-32: freight percentiles in weight x volume x distance cells (right-closed bands, n >= min_n)."""
    c = _cells(item_star(_m(spark, sf)), min_n).filter(
        F.col("wbin").isNotNull() & F.col("vbin").isNotNull() & F.col("dbin").isNotNull())
    return c.select("wbin", "vbin", "dbin", "n", r("p10", 2).alias("p10"), r("p50", 2).alias("p50"),
                    r("p90", 2).alias("p90"), r("p90_over_p10", 2).alias("p90_over_p10"))


@query("agg33_cells_explained", f"""
WITH {CELL_CTE},
c AS (SELECT wbin, vbin, dbin, count(*) AS n, quantile_cont(freight_value, 0.1) AS p10,
             quantile_cont(freight_value, 0.9) AS p90, avg(freight_value) AS mu
      FROM f_cells WHERE wbin IS NOT NULL AND vbin IS NOT NULL AND dbin IS NOT NULL GROUP BY 1, 2, 3
      HAVING count(*) >= 10),
x AS (SELECT f.freight_value AS v, c.mu FROM f_cells f JOIN c USING (wbin, vbin, dbin))
SELECT (SELECT count(*) FROM c) AS n_cells,
       (SELECT round_even(median(p10), 1) FROM c) AS p10, (SELECT round_even(median(p90), 1) FROM c) AS p90,
       (SELECT round_even(median(p90 / p10), 2) FROM c) AS ratio,
       round_even(1 - sum((v - mu) * (v - mu)) / (sum(v * v) - sum(v) * sum(v) / count(*)), 4) AS explained
FROM x
""")
def agg33_cells_explained(spark, sf, min_n: int = 10):
    """AGG-33 / WIN-11: cell count, median cell p10 / p90 / ratio and the variance explained by cell means
    (1 - within SS / total SS over rows in well-populated cells).  Cell means are joined back from a
    group-by, so a hot cell is combined map-side instead of buffered in one window task."""
    items = item_star(_m(spark, sf))
    pop = _cells_population(items)
    cells = (pop.groupBy("wbin", "vbin", "dbin").agg(
        F.count(F.lit(1)).alias("n"), F.percentile("freight_value", 0.1).alias("p10"),
        F.percentile("freight_value", 0.9).alias("p90"), F.avg("freight_value").alias("mu"))
        .filter((F.col("n") >= min_n) & F.col("wbin").isNotNull() & F.col("vbin").isNotNull()
                & F.col("dbin").isNotNull()))
    summary = cells.agg(F.count(F.lit(1)).alias("n_cells"), r(F.median("p10"), 1).alias("p10"),
                        r(F.median("p90"), 1).alias("p90"), r(F.median(F.col("p90") / F.col("p10")), 2).alias("ratio"))
    x = pop.join(F.broadcast(cells.select("wbin", "vbin", "dbin", "mu")), ["wbin", "vbin", "dbin"])
    v = F.col("freight_value")
    ss = x.agg(r(F.lit(1) - F.sum((v - F.col("mu")) * (v - F.col("mu")))
                 / (F.sum(v * v) - F.sum(v) * F.sum(v) / F.count(F.lit(1))), 4).alias("explained"))
    return _one_row_pair(summary, ss)


def _one_row_pair(a, b):
    """Put two one-row aggregates side by side (both are single-row; equi-join on a constant key)."""
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one").drop("_one")


@query("agg34_largest_cell_sample", f"""
WITH {CELL_CTE},
big AS (SELECT wbin, vbin, dbin FROM f_cells WHERE wbin IS NOT NULL AND vbin IS NOT NULL AND dbin IS NOT NULL
        GROUP BY 1, 2, 3 ORDER BY count(*) DESC, wbin, vbin, dbin LIMIT 1)
SELECT round_even(weight_kg, 1) AS weight_kg, round_even(volume_cm3, 1) AS volume_cm3,
       round_even(distance_km, 1) AS distance_km, round_even(freight_value, 1) AS freight_value, category
FROM f_cells JOIN big USING (wbin, vbin, dbin)
ORDER BY md5(CAST(order_id AS VARCHAR) || '-' || CAST(order_item_id AS VARCHAR) || '-3') LIMIT 8
""")
def agg34_largest_cell_sample(spark, sf, k: int = 8, seed: int = 3):
    """AGG-34 / SMP-1: the most populated cell and a seeded sample of k of its lines (md5 order: repeatable
    on any partitioning)."""
    pop = _cells_population(item_star(_m(spark, sf))).filter(
        F.col("wbin").isNotNull() & F.col("vbin").isNotNull() & F.col("dbin").isNotNull())
    big = (pop.groupBy("wbin", "vbin", "dbin").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "wbin", "vbin", "dbin").limit(1).drop("n"))
    key = F.md5(F.concat_ws("-", F.col("order_id").cast("string"), F.col("order_item_id").cast("string"),
                            F.lit(str(seed))))
    return (pop.join(F.broadcast(big), ["wbin", "vbin", "dbin"]).orderBy(key).limit(k)
            .select(r("weight_kg", 1).alias("weight_kg"), r("volume_cm3", 1).alias("volume_cm3"),
                    r("distance_km", 1).alias("distance_km"), r("freight_value", 1).alias("freight_value"),
                    "category"))


# ---------------------------------------------------------------- reviews (AGG-35..39, AGG-45)
@query("agg35_review_scores", """
SELECT review_score, count(*) AS n FROM f_reviews GROUP BY 1
""")
def agg35_review_scores(spark, sf):
    """AGG-35: reviews per score."""
    return _m(spark, sf).reviews.groupBy("review_score").agg(F.count(F.lit(1)).alias("n"))


@query("agg35_review_text_nulls", """
SELECT count(*) AS n_reviews, round_even(avg((review_comment_title IS NULL)::INT) * 100, 2) AS review_title_null,
       round_even(avg((review_comment_message IS NULL)::INT) * 100, 2) AS review_msg_null
FROM f_reviews
""")
def agg35_review_text_nulls(spark, sf):
    """AGG-35: share of reviews without title / message."""
    rv = _m(spark, sf).reviews
    return rv.agg(F.count(F.lit(1)).alias("n_reviews"),
                  r(pct(F.col("review_comment_title").isNull()), 2).alias("review_title_null"),
                  r(pct(F.col("review_comment_message").isNull()), 2).alias("review_msg_null"))


@query("agg36_review_monthly", """
WITH rv AS (SELECT strftime(review_answer_timestamp, '%Y-%m') AS month, count(review_id) AS num_reviews
            FROM f_reviews WHERE review_answer_timestamp IS NOT NULL GROUP BY 1),
od AS (SELECT strftime(order_delivered_customer_date, '%Y-%m') AS month, count(DISTINCT order_id) AS num_orders
       FROM f_orders WHERE order_delivered_customer_date IS NOT NULL GROUP BY 1)
SELECT coalesce(rv.month, od.month) AS month, rv.num_reviews, od.num_orders
FROM rv FULL JOIN od ON rv.month = od.month
""")
def agg36_review_monthly(spark, sf):
    """AGG-36 / JON-5: reviews per answer month vs orders per delivery month (full outer join, null month dropped)."""
    m = _m(spark, sf)
    rv = (m.reviews.filter(F.col("review_answer_timestamp").isNotNull())
          .groupBy(F.date_format("review_answer_timestamp", "yyyy-MM").alias("month"))
          .agg(F.count("review_id").alias("num_reviews")))
    od = (m.orders.filter(F.col("order_delivered_customer_date").isNotNull())
          .groupBy(F.date_format("order_delivered_customer_date", "yyyy-MM").alias("month"))
          .agg(F.count_distinct("order_id").alias("num_orders")))
    return rv.join(od, "month", "full").orderBy("month")


def _rel(m):
    """Delivered orders with a review (the population of the review reports)."""
    return delivered_orders(m).filter(F.col("review_score").isNotNull())


# band definitions: (column, inner edges, labels, lower outer edge rule, upper outer edge rule)
# Band edges and labels.
DRIVER_BANDS = {
    "delivery": ("delivery_days", [0, 5, 10, 15, 20, 30], ["0-5", "6-10", "11-15", "16-20", "21-30", ">30"],
                 None, 1.0),
    "days_late": ("days_late", [-10, -5, 0, 5, 10, 20],
                  ["< -10", "-10 to -5", "-5 to 0", "0 to 5", "5 to 10", "10 to 20", "> 20"], -1.0, 1.0),
    "freight": ("freight_total", [0, 15, 25, 40, 60], ["0-15", "15-25", "25-40", "40-60", ">60"], None, 1.0),
    "freight_ratio": ("freight_ratio", [0, 0.1, 0.2, 0.3, 0.5, 1.0],
                      ["0-0.1", "0.1-0.2", "0.2-0.3", "0.3-0.5", "0.5-1.0", ">1.0"], None, 0.1),
}


def _band_edges_spark(rel, key):
    col, inner, labels, lo_off, hi_off = DRIVER_BANDS[key]
    st = rel.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    edges = ([F.col("_lo") + F.lit(lo_off)] if lo_off is not None else []) + [float(e) for e in inner] + \
        [F.col("_hi") + F.lit(hi_off)]
    x = _attach_stats(rel, st)
    return x.withColumn("band", cut(col, edges, labels, right=False)), col


def _attach_stats(df, one_row):
    """Attach a one-row aggregate (data-driven outer band edges) to every row via a broadcast equi-join."""
    s = one_row.select(F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.lit(1).alias("_one"))
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(s), "_one").drop("_one")


def _band_sql(key):
    col, inner, labels, lo_off, hi_off = DRIVER_BANDS[key]
    edges = ([f"(SELECT min({col}) FROM f_delivered WHERE review_score IS NOT NULL) + {lo_off}"]
             if lo_off is not None else []) + [str(float(e)) for e in inner] + \
        [f"(SELECT max({col}) FROM f_delivered WHERE review_score IS NOT NULL) + {hi_off}"]
    parts = [f"WHEN {col} >= {a} AND {col} < {b} THEN '{lab}'" for a, b, lab in zip(edges[:-1], edges[1:], labels)]
    return f"CASE {' '.join(parts)} END"


def _binned_mean_sql(key, name):
    return f"""
WITH x AS (SELECT review_score, {_band_sql(key)} AS band FROM f_delivered WHERE review_score IS NOT NULL)
SELECT band AS {name}, round_even(avg(review_score), 2) AS mean_review, count(review_score) AS n
FROM x WHERE band IS NOT NULL GROUP BY 1
"""


def _binned_box_sql(key, name):
    return f"""
WITH x AS (SELECT review_score::DOUBLE AS s, {_band_sql(key)} AS band FROM f_delivered
           WHERE review_score IS NOT NULL),
q AS (SELECT band, quantile_cont(s, 0.25) AS q1, median(s) AS med, quantile_cont(s, 0.75) AS q3, count(s) AS n
      FROM x WHERE band IS NOT NULL GROUP BY 1)
SELECT q.band AS {name}, q.q1, q.med AS median, q.q3,
       min(x.s) FILTER (WHERE x.s >= q.q1 - 1.5 * (q.q3 - q.q1)) AS lowerfence,
       max(x.s) FILTER (WHERE x.s <= q.q3 + 1.5 * (q.q3 - q.q1)) AS upperfence, q.n
FROM q JOIN x ON q.band = x.band GROUP BY q.band, q.q1, q.med, q.q3, q.n
"""


def _binned_mean(spark, sf, key, name):
    x, _ = _band_edges_spark(_rel(_m(spark, sf)), key)
    return (x.filter(F.col("band").isNotNull()).groupBy(F.col("band").alias(name))
            .agg(r(F.avg("review_score"), 2).alias("mean_review"), F.count("review_score").alias("n")))


def _binned_box(spark, sf, key, name):
    x, _ = _band_edges_spark(_rel(_m(spark, sf)), key)
    x = x.filter(F.col("band").isNotNull()).withColumn("s", F.col("review_score").cast("double"))
    q = x.groupBy("band").agg(F.percentile("s", 0.25).alias("q1"), F.median("s").alias("median"),
                              F.percentile("s", 0.75).alias("q3"), F.count("s").alias("n"))
    j = x.select("band", "s").join(F.broadcast(q), "band")
    iqr = F.col("q3") - F.col("q1")
    return (j.groupBy("band", "q1", "median", "q3", "n")
            .agg(F.min(F.when(F.col("s") >= F.col("q1") - 1.5 * iqr, F.col("s"))).alias("lowerfence"),
                 F.max(F.when(F.col("s") <= F.col("q3") + 1.5 * iqr, F.col("s"))).alias("upperfence"))
            .withColumnRenamed("band", name))


for _key, _name in (("delivery", "delivery_bin"), ("days_late", "days_late_bin"), ("freight", "freight_bin"),
                    ("freight_ratio", "freight_ratio_bin")):
    def _mk_mean(key=_key, name=_name):
        def fn(spark, sf):
            return _binned_mean(spark, sf, key, name)
        fn.__doc__ = f"AGG-37 / PRJ-13: mean review score and n per {key} band (left-closed, data-driven outer edges)."
        fn.__name__ = f"agg37_review_by_{key}"
        return fn

    def _mk_box(key=_key, name=_name):
        def fn(spark, sf):
            return _binned_box(spark, sf, key, name)
        fn.__doc__ = f"AGG-38: box-plot statistics of review score per {key} band (Tukey fences clipped to data)."
        fn.__name__ = f"agg38_review_box_{key}"
        return fn
    query(f"agg37_review_by_{_key}", _binned_mean_sql(_key, _name))(_mk_mean())
    query(f"agg38_review_box_{_key}", _binned_box_sql(_key, _name))(_mk_box())


DELIVERY_BANDS = [0, 7, 14, 21, INF]
DELIVERY_LABELS = ["<7d", "7-14d", "14-21d", "21d+"]
BURDEN_BANDS = [0, 15, 30, 50, INF]
BURDEN_LABELS = ["<15%", "15-30%", "30-50%", "50%+"]


@query("agg39_review_delivery_x_burden", """
WITH x AS (
  SELECT review_score,
         CASE WHEN delivery_days >= 0 AND delivery_days < 7 THEN '<7d' WHEN delivery_days >= 7 AND delivery_days < 14
              THEN '7-14d' WHEN delivery_days >= 14 AND delivery_days < 21 THEN '14-21d'
              WHEN delivery_days >= 21 THEN '21d+' END AS delivery_band,
         CASE WHEN burden > 0 AND burden <= 15 THEN '<15%' WHEN burden > 15 AND burden <= 30 THEN '15-30%'
              WHEN burden > 30 AND burden <= 50 THEN '30-50%' WHEN burden > 50 THEN '50%+' END AS burden_band
  FROM (SELECT *, 100 * freight_total / item_total AS burden FROM f_delivered
        WHERE review_score IS NOT NULL AND delivery_days IS NOT NULL AND item_total > 0)),
g AS (SELECT delivery_band, burden_band, avg(review_score) AS mean_review, count(*) AS n FROM x
      WHERE delivery_band IS NOT NULL AND burden_band IS NOT NULL GROUP BY 1, 2)
SELECT delivery_band, burden_band, round_even(mean_review, 2) AS mean_review, n,
       round_even(max(mean_review) OVER (PARTITION BY delivery_band) - min(mean_review) OVER (PARTITION BY delivery_band), 2)
           AS row_spread,
       round_even(max(mean_review) OVER (PARTITION BY burden_band) - min(mean_review) OVER (PARTITION BY burden_band), 2)
           AS col_spread
FROM g
""")
def agg39_review_delivery_x_burden(spark, sf):
    """AGG-39 / SHP-1: mean review by delivery-time band x freight-burden band, with counts and the spread
    across each row (burden effect) and column (delivery effect).  Long form; ``pivot`` gives the grid."""
    d = delivered_orders(_m(spark, sf)).filter(
        F.col("review_score").isNotNull() & F.col("delivery_days").isNotNull() & (F.col("item_total") > 0))
    d = d.withColumn("burden", 100 * F.col("freight_total") / F.col("item_total"))
    x = d.select("review_score", cut("delivery_days", DELIVERY_BANDS, DELIVERY_LABELS, right=False)
                 .alias("delivery_band"), cut("burden", BURDEN_BANDS, BURDEN_LABELS).alias("burden_band"))
    g = (x.filter(F.col("delivery_band").isNotNull() & F.col("burden_band").isNotNull())
         .groupBy("delivery_band", "burden_band").agg(F.avg("review_score").alias("mr"), F.count(F.lit(1)).alias("n")))
    wr, wc = Window.partitionBy("delivery_band"), Window.partitionBy("burden_band")
    return g.select("delivery_band", "burden_band", r("mr", 2).alias("mean_review"), "n",
                    r(F.max("mr").over(wr) - F.min("mr").over(wr), 2).alias("row_spread"),
                    r(F.max("mr").over(wc) - F.min("mr").over(wc), 2).alias("col_spread"))


@query("shp01_review_grid", """
WITH x AS (
  SELECT review_score,
         CASE WHEN delivery_days >= 0 AND delivery_days < 7 THEN '<7d' WHEN delivery_days >= 7 AND delivery_days < 14
              THEN '7-14d' WHEN delivery_days >= 14 AND delivery_days < 21 THEN '14-21d'
              WHEN delivery_days >= 21 THEN '21d+' END AS delivery_band,
         CASE WHEN burden > 0 AND burden <= 15 THEN '<15%' WHEN burden > 15 AND burden <= 30 THEN '15-30%'
              WHEN burden > 30 AND burden <= 50 THEN '30-50%' WHEN burden > 50 THEN '50%+' END AS burden_band
  FROM (SELECT *, 100 * freight_total / item_total AS burden FROM f_delivered
        WHERE review_score IS NOT NULL AND delivery_days IS NOT NULL AND item_total > 0))
SELECT delivery_band,
       round_even(avg(review_score) FILTER (WHERE burden_band = '<15%'), 2) AS "<15%",
       round_even(avg(review_score) FILTER (WHERE burden_band = '15-30%'), 2) AS "15-30%",
       round_even(avg(review_score) FILTER (WHERE burden_band = '30-50%'), 2) AS "30-50%",
       round_even(avg(review_score) FILTER (WHERE burden_band = '50%+'), 2) AS "50%+"
FROM x WHERE delivery_band IS NOT NULL GROUP BY 1
""")
def shp01_review_grid(spark, sf):
    """SHP-1: long-to-wide pivot of mean review (delivery band rows x burden band columns, explicit values)."""
    d = delivered_orders(_m(spark, sf)).filter(
        F.col("review_score").isNotNull() & F.col("delivery_days").isNotNull() & (F.col("item_total") > 0))
    d = d.withColumn("burden", 100 * F.col("freight_total") / F.col("item_total"))
    x = d.select("review_score", cut("delivery_days", DELIVERY_BANDS, DELIVERY_LABELS, right=False)
                 .alias("delivery_band"), cut("burden", BURDEN_BANDS, BURDEN_LABELS).alias("burden_band"))
    p = (x.filter(F.col("delivery_band").isNotNull()).groupBy("delivery_band")
         .pivot("burden_band", BURDEN_LABELS).agg(F.avg("review_score")))
    return p.select("delivery_band", *[r(F.col(f"`{c}`"), 2).alias(c) for c in BURDEN_LABELS])


@query("agg45_satisfaction_link", """
WITH d AS (SELECT o.order_id, (f.days_late > 0)::INT AS late, (r.review_score <= 2)::INT AS low, r.review_score
           FROM (SELECT order_id, CAST(floor((epoch_us(order_delivered_customer_date)
                        - epoch_us(order_estimated_delivery_date)) / 86400000000.0) AS BIGINT) AS days_late
                 FROM f_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL) f
           JOIN f_orders o ON o.order_id = f.order_id
           JOIN (SELECT order_id, arg_max(review_score, (review_creation_date, review_id)) AS review_score
                 FROM f_reviews GROUP BY 1) r ON r.order_id = o.order_id)
SELECT count(*) AS orders_with_review,
       round_even(avg(review_score) FILTER (WHERE late = 0), 4) AS mean_review_ontime,
       round_even(avg(review_score) FILTER (WHERE late = 1), 4) AS mean_review_late,
       round_even(avg(low), 6) AS low_rate_all,
       round_even(avg(low) FILTER (WHERE late = 1), 6) AS low_rate_late,
       round_even(avg(low) FILTER (WHERE late = 0), 6) AS low_rate_ontime,
       round_even(sum(low) FILTER (WHERE late = 1) / sum(low), 6) AS low_share_from_late
FROM d
""")
def agg45_satisfaction_link(spark, sf):
    """AGG-45 / JON-9 / WIN-2: delivered orders with a (latest) review: mean score on-time vs late,
    low-review (1-2 stars) rates and the share of low reviews that come from late orders."""
    d = dated_delivered(_m(spark, sf)).filter(F.col("review_score").isNotNull())
    late = F.col("days_late") > 0
    low = (F.col("review_score") <= 2).cast("int")
    return d.agg(F.count(F.lit(1)).alias("orders_with_review"),
                 r(F.avg(F.when(~late, F.col("review_score"))), 4).alias("mean_review_ontime"),
                 r(F.avg(F.when(late, F.col("review_score"))), 4).alias("mean_review_late"),
                 r(F.avg(low), 6).alias("low_rate_all"),
                 r(F.avg(F.when(late, low)), 6).alias("low_rate_late"),
                 r(F.avg(F.when(~late, low)), 6).alias("low_rate_ontime"),
                 r(F.sum(F.when(late, low)) / F.sum(low), 6).alias("low_share_from_late"))


# ---------------------------------------------------------------- consolidation and overpayment (AGG-40, AGG-41)
def _middle(values):
    """Median of the few values of one order, from their sorted array."""
    v = F.sort_array(values)
    n = F.size(v)
    return F.when(n > 0, (F.element_at(v, ((n + 1) / 2).cast("int")) + F.element_at(v, (n / 2 + 1).cast("int"))) / 2)


def _per_order_freight(items):
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("product_id").alias("n_products"),
        F.count_distinct("seller_id").alias("n_sellers"), F.sum("freight_value").alias("total"),
        _middle(F.collect_list("freight_value")).alias("per_line"), F.count_distinct("freight_value").alias("distinct_values"))


_PER_ORDER_SQL = """
g AS (SELECT order_id, count(*) AS n, count(DISTINCT product_id) AS n_products, count(DISTINCT seller_id) AS n_sellers,
             sum(freight_value) AS total, median(freight_value) AS per_line,
             count(DISTINCT freight_value) AS distinct_values
      FROM f_items GROUP BY 1)"""


@query("agg40_consolidation", f"""
WITH {_PER_ORDER_SQL}
SELECT n, count(*) AS orders, round_even(median(total), 4) AS median_total,
       round_even(median(per_line), 4) AS median_per_line,
       round_even((SELECT median(total) FROM g WHERE n = 1) * n, 4) AS linear_reference
FROM g WHERE n > 1 AND n_products = 1 AND n_sellers = 1 AND n <= 6 GROUP BY n
""")
def agg40_consolidation(spark, sf):
    """AGG-40: orders of n copies of one product from one seller (n = 2..6): median total and per-line freight,
    against the linear reference n x median single-line freight."""
    g = _per_order_freight(_m(spark, sf).items)
    single = exact_quantile(g.filter(F.col("n") == 1), "total", 0.5, "single")
    same = g.filter((F.col("n") > 1) & (F.col("n_products") == 1) & (F.col("n_sellers") == 1) & (F.col("n") <= 6))
    tab = agg_with_quantiles(same, ["n"], [F.count(F.lit(1)).alias("orders")], {"mt": ("total", 0.5), "ml": ("per_line", 0.5)})
    tab = tab.select("n", "orders", r("mt", 4).alias("median_total"), r("ml", 4).alias("median_per_line"))
    return (tab.withColumn("_one", F.lit(1)).join(F.broadcast(single.withColumn("_one", F.lit(1))), "_one")
            .select("n", "orders", "median_total", "median_per_line",
                    r(F.col("single") * F.col("n"), 4).alias("linear_reference")))


@query("agg41_overpayment", f"""
WITH {_PER_ORDER_SQL},
m AS (SELECT *, greatest(total - per_line * n_sellers, 0) AS overpay FROM g WHERE n > 1)
SELECT (SELECT count(*) FROM m) AS multi_line_orders,
       round_even((SELECT count(*) FROM m) / (SELECT count(*) FROM g) * 100, 3) AS multi_line_pct,
       round_even((SELECT avg((distinct_values = 1)::INT) FROM m) * 100, 3) AS same_freight_pct,
       round_even((SELECT sum(overpay::DECIMAL(18,3))::DOUBLE FROM m), 2) AS overpay_total,
       round_even((SELECT sum(overpay::DECIMAL(18,3))::DOUBLE FROM m) / (SELECT sum(freight_value) FROM f_items) * 100, 3)
           AS overpay_pct,
       (SELECT median(overpay) FROM m WHERE overpay > 0) AS median_overpay
""")
def agg41_overpayment(spark, sf):
    """AGG-41: overpayment against one charge per seller per order: max(total - median line x sellers, 0);
    sum, share of all freight and median of the positive ones."""
    items = _m(spark, sf).items
    g = _per_order_freight(items)
    mm = g.withColumn("overpay", F.greatest(F.col("total") - F.col("per_line") * F.col("n_sellers"), F.lit(0.0)))
    a = agg_with_quantiles(mm, [], [
               F.count(F.when(F.col("n") > 1, F.lit(1))).alias("multi_line_orders"),
               r(pct(F.col("n") > 1), 3).alias("multi_line_pct"),
               r(F.avg(F.when(F.col("n") > 1, (F.col("distinct_values") == 1).cast("int"))) * 100, 3)
               .alias("same_freight_pct"),
               # exact decimal sum (order-independent); inputs have at most three decimals
               F.sum(F.when(F.col("n") > 1, F.col("overpay").cast("decimal(18,3)"))).cast("double").alias("_op"),
               F.sum("total").alias("_all")],
               {"median_overpay": (F.when((F.col("n") > 1) & (F.col("overpay") > 0), F.col("overpay")), 0.5)})
    return a.select("multi_line_orders", "multi_line_pct", "same_freight_pct", r("_op", 2).alias("overpay_total"),
                    r(F.col("_op") / F.col("_all") * 100, 3).alias("overpay_pct"), "median_overpay")


@query("agg42_destination_spend", """
SELECT customer_state, count(*) AS lines, round_even(sum(freight_value), 2) AS spend,
       round_even(median(freight_ratio * 100), 3) AS median_burden
FROM f_item_star WHERE distance_km IS NOT NULL AND customer_state IS NOT NULL GROUP BY 1 HAVING count(*) >= 300
""")
def agg42_destination_spend(spark, sf, min_lines: int = 300):
    """AGG-42: freight spend and median burden by destination state (lines >= min_lines)."""
    it = item_star(_m(spark, sf)).filter(F.col("distance_km").isNotNull() & F.col("customer_state").isNotNull())
    g = agg_with_quantiles(it, ["customer_state"], [F.count(F.lit(1)).alias("lines"), r(F.sum("freight_value"), 2).alias("spend")],
                           {"mb": (F.col("freight_ratio") * 100, 0.5)})
    return g.filter(F.col("lines") >= min_lines).select("customer_state", "lines", "spend", r("mb", 3).alias("median_burden"))


# ---------------------------------------------------------------- seller tenure and panel (AGG-43, AGG-44)
def _seller_base(m):
    """Delivered order lines with review, lateness by timestamp (PRJ-10) and fractional delivery days."""
    o = delivered_orders(m).select(
        "order_id", "review_score", "purchase_month",
        F.coalesce(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"), F.lit(False))
        .cast("int").alias("is_late_ts"),
        (micros("order_delivered_customer_date") - micros("order_purchase_timestamp")).alias("delivery_us"))
    return m.items.select("order_id", "order_item_id", "seller_id", "price", "freight_value").join(o, "order_id")


_SELLER_BASE_SQL = """
base AS (SELECT i.order_id, i.order_item_id, i.seller_id, i.price, i.freight_value, o.review_score, o.purchase_month,
                coalesce(o.order_delivered_customer_date > o.order_estimated_delivery_date, false)::INT AS is_late_ts,
                epoch_us(o.order_delivered_customer_date) - epoch_us(o.order_purchase_timestamp) AS delivery_us
         FROM f_items i JOIN f_delivered o ON i.order_id = o.order_id),
sm AS (SELECT seller_id, count(DISTINCT purchase_month) AS n_active_months FROM base GROUP BY 1)"""


@query("agg43_seller_tenure", f"""
WITH {_SELLER_BASE_SQL}
SELECT count(*) AS sellers, round_even(avg((n_active_months < 3)::INT) * 100, 3) AS pct_short_tenure,
       count(*) FILTER (WHERE n_active_months >= 3) AS eligible_sellers,
       median(n_active_months) AS median_active_months, max(n_active_months) AS max_active_months
FROM sm
""")
def agg43_seller_tenure(spark, sf, min_months: int = 3):
    """AGG-43: distinct active months per seller; share below ``min_months``; eligible sellers."""
    sm = _seller_base(_m(spark, sf)).groupBy("seller_id").agg(F.count_distinct("purchase_month").alias("k"))
    return sm.agg(F.count(F.lit(1)).alias("sellers"), r(pct(F.col("k") < min_months), 3).alias("pct_short_tenure"),
                  F.count(F.when(F.col("k") >= min_months, F.lit(1))).alias("eligible_sellers"),
                  F.median("k").alias("median_active_months"), F.max("k").alias("max_active_months"))


def seller_month_panel(m, min_months: int = 3):
    """One row per seller and month, written once: several reports read it, some of them many times.  A seller's lines of
    an order are summed first, where they stand (buckets of the order); they move once, by seller and month."""
    def build():
        sums = {"revenue": F.sum("price"), "n_items": F.count("order_item_id"), "_freight": F.sum("freight_value"),
                "_freights": F.count("freight_value"), "_review": F.sum("review_score"), "_reviews": F.count("review_score"),
                "_late": F.sum("is_late_ts"), "_us": F.sum("delivery_us"), "_timed": F.count("delivery_us")}
        orders = _seller_base(m).filter(F.col("seller_id").isNotNull()).groupBy("order_id", "seller_id", "purchase_month").agg(
            *[v.alias(k) for k, v in sums.items()])
        p = orders.groupBy("seller_id", "purchase_month").agg(F.count(F.lit(1)).alias("n_orders"), *[F.sum(k).alias(k) for k in sums])
        active = F.count("purchase_month").over(Window.partitionBy("seller_id"))        # a seller has a row per calendar month
        return p.withColumn("_active", active).filter(F.col("_active") >= min_months).select(
            "seller_id", "purchase_month", "revenue", "n_orders", "n_items",
            F.try_divide("_review", "_reviews").alias("avg_review_score"), (F.col("_late") / F.col("n_items")).alias("late_rate"),
            # mean of exact integer microseconds: the sum is order-independent, so the result is repeatable
            F.try_divide(F.try_divide("_us", "_timed"), F.lit(86_400_000_000.0)).alias("avg_delivery_days"),
            F.try_divide("_freight", "_freights").alias("avg_freight"))
    return _cached(m, f"seller_month_panel:{min_months}", build)


@query("agg44_seller_month_panel", f"""
WITH {_SELLER_BASE_SQL}
SELECT seller_id, purchase_month, round_even(sum(price), 2) AS revenue, count(DISTINCT order_id) AS n_orders,
       count(order_item_id) AS n_items, round_even(avg(review_score), 6) AS avg_review_score,
       round_even(avg(is_late_ts), 6) AS late_rate, round_even(sum(delivery_us) / count(delivery_us) / 86400000000.0, 6) AS avg_delivery_days,
       round_even(avg(freight_value), 6) AS avg_freight
FROM base WHERE seller_id IN (SELECT seller_id FROM sm WHERE n_active_months >= 3)
GROUP BY 1, 2
""")
def agg44_seller_month_panel(spark, sf):
    """AGG-44 / JON-7: seller-month panel of eligible sellers: revenue, orders, lines, mean review,
    late rate (timestamp rule), mean delivery days, mean freight."""
    p = seller_month_panel(_m(spark, sf))
    return p.select("seller_id", "purchase_month", r("revenue", 2).alias("revenue"), "n_orders", "n_items",
                    *[r(c, 6).alias(c) for c in ("avg_review_score", "late_rate", "avg_delivery_days", "avg_freight")])


# ---------------------------------------------------------------- promise and lateness trends (AGG-46..49, 53..55)
@query("agg46_promise_timeline", """
WITH o AS (SELECT * FROM f_order_features),
w AS (SELECT CAST(date_trunc('week', order_purchase_timestamp) AS DATE) + 6 AS week_ending, promised_days, clf_target
      FROM o),
g AS (SELECT week_ending, count(*) AS orders, median(promised_days) AS median, quantile_cont(promised_days, 0.25) AS p25,
             quantile_cont(promised_days, 0.75) AS p75, avg(clf_target) AS late_rate FROM w GROUP BY 1)
SELECT week_ending, orders, round_even(median, 6) AS median, round_even(p25, 6) AS p25, round_even(p75, 6) AS p75,
       round_even(late_rate, 6) AS late_rate
FROM g WHERE week_ending <= (SELECT CAST(max(order_purchase_timestamp) AS DATE) FROM o) AND orders >= 5
""")
def agg46_promise_timeline(spark, sf, min_orders: int = 5):
    """AGG-46: weekly (weeks ending Sunday) promise median, p25, p75 and late rate of delivered orders;
    complete weeks with at least ``min_orders`` orders."""
    o = order_features(_m(spark, sf), with_loads=False)
    ts = F.col("order_purchase_timestamp")
    w = o.select(F.date_add(F.to_date(F.date_trunc("week", ts)), 6).alias("week_ending"), "promised_days",
                 "clf_target", F.to_date(ts).alias("_day"))
    g = agg_with_quantiles(w, ["week_ending"], [F.count(F.lit(1)).alias("orders"), F.avg("clf_target").alias("late_rate"),
                                                F.max("_day").alias("_last")],
                           {"median": ("promised_days", 0.5), "p25": ("promised_days", 0.25), "p75": ("promised_days", 0.75)})
    g = g.withColumn("_last", F.max("_last").over(Window.partitionBy()))
    return (g.filter((F.col("week_ending") <= F.col("_last")) & (F.col("orders") >= min_orders))
            .select("week_ending", "orders", *[r(c, 6).alias(c) for c in ("median", "p25", "p75", "late_rate")]))


@query("agg47_monthly_late_promise", """
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, count(*) AS orders,
       round_even(avg(clf_target), 6) AS late_rate, round_even(median(promised_days), 6) AS promised_days
FROM f_order_features GROUP BY 1 HAVING count(*) >= 100
""")
def agg47_monthly_late_promise(spark, sf, min_orders: int = 100):
    """AGG-47: monthly late rate and median promise of delivered orders (months with >= min_orders)."""
    o = order_features(_m(spark, sf), with_loads=False)
    g = agg_with_quantiles(
        o.select(F.date_format("order_purchase_timestamp", "yyyy-MM").alias("month"), "clf_target", "promised_days"), ["month"],
        [F.count(F.lit(1)).alias("orders"), r(F.avg("clf_target"), 6).alias("late_rate")], {"mp": ("promised_days", 0.5)})
    return g.filter(F.col("orders") >= min_orders).select("month", "orders", "late_rate", r("mp", 6).alias("promised_days"))


@query("agg48_freight_drift", """
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, count(*) AS n,
       round_even(median(freight_value / greatest(chargeable_kg, 0.1)), 6) AS per_kg,
       round_even(avg(freight_value), 6) AS mean_freight
FROM f_item_features GROUP BY 1 HAVING count(*) >= 300
""")
def agg48_freight_drift(spark, sf, min_n: int = 300):
    """AGG-48: monthly median freight per chargeable kg (kg floored at 0.1) and mean freight."""
    from .core import item_features
    it = item_features(_m(spark, sf))
    x = it.select(F.date_format("order_purchase_timestamp", "yyyy-MM").alias("month"), "freight_value",
                  (F.col("freight_value") / F.greatest("chargeable_kg", F.lit(0.1))).alias("_kg"))
    g = agg_with_quantiles(x, ["month"], [F.count(F.lit(1)).alias("n"), r(F.avg("freight_value"), 6).alias("mean_freight")],
                           {"mk": ("_kg", 0.5)})
    return g.filter(F.col("n") >= min_n).select("month", "n", r("mk", 6).alias("per_kg"), "mean_freight")


@query("agg49_late_by_installment_band", """
SELECT CASE WHEN max_installments > -1 AND max_installments <= 0 THEN '0'
            WHEN max_installments > 0 AND max_installments <= 3 THEN '1-3'
            WHEN max_installments > 3 AND max_installments <= 6 THEN '4-6'
            WHEN max_installments > 6 AND max_installments <= 100 THEN '7+' END AS installment_band,
       round_even(avg(is_late::INT) * 100, 2) AS late_rate, count(*) AS orders
FROM f_d WHERE max_installments IS NOT NULL GROUP BY 1 HAVING installment_band IS NOT NULL
""")
def agg49_late_by_installment_band(spark, sf):
    """AGG-49: late rate of delivered orders by instalment band (right-closed)."""
    d = dated_delivered(_m(spark, sf)).filter(F.col("max_installments").isNotNull())
    d = d.withColumn("installment_band", cut("max_installments", [-1, 0, 3, 6, 100], ["0", "1-3", "4-6", "7+"]))
    return (d.filter(F.col("installment_band").isNotNull()).groupBy("installment_band")
            .agg(r(F.avg(F.col("is_late").cast("int")) * 100, 2).alias("late_rate"), F.count(F.lit(1)).alias("orders")))


@query("agg49_late_by_weekday", """
SELECT purchase_dow AS day_of_week, round_even(avg(is_late::INT) * 100, 2) AS late_rate, count(*) AS orders
FROM f_d GROUP BY 1
""")
def agg49_late_by_weekday(spark, sf):
    """AGG-49: late rate by purchase weekday."""
    d = dated_delivered(_m(spark, sf))
    return d.groupBy(F.col("purchase_dow").alias("day_of_week")).agg(
        r(F.avg(F.col("is_late").cast("int")) * 100, 2).alias("late_rate"), F.count(F.lit(1)).alias("orders"))


@query("agg49_status_mix", """
SELECT order_status, count(*) AS orders, round_even(count(*) / sum(count(*)) OVER () * 100, 3) AS pct
FROM f_orders GROUP BY 1
""")
def agg49_status_mix(spark, sf):
    """AGG-49: order status mix."""
    g = _m(spark, sf).orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))
    return g.select("order_status", "orders",
                    r(F.col("orders") / F.sum("orders").over(Window.partitionBy()) * 100, 3).alias("pct"))


@query("agg53_monthly_leadtime", """
SELECT purchase_month, count(order_id) AS n_orders,
       round_even(avg((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp))
                      / 86400000000.0), 6) AS avg_lead_time,
       round_even(avg(coalesce(order_delivered_customer_date > order_estimated_delivery_date, false)::INT), 6)
           AS late_rate
FROM f_delivered GROUP BY 1
""")
def agg53_monthly_leadtime(spark, sf):
    """AGG-53 / PRJ-10: monthly delivered orders, mean fractional lead time and late rate (timestamp rule)."""
    d = delivered_orders(_m(spark, sf))
    late_ts = F.coalesce(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"), F.lit(False))
    return d.groupBy("purchase_month").agg(
        F.count("order_id").alias("n_orders"),
        r(F.avg(frac_days("order_delivered_customer_date", "order_purchase_timestamp")), 6).alias("avg_lead_time"),
        r(F.avg(late_ts.cast("int")), 6).alias("late_rate"))


@query("agg54_freight_ratio_by_lateness", """
WITH fr AS (SELECT order_id, avg(freight_value / nullif(price, 0)) AS avg_freight_ratio FROM f_items GROUP BY 1),
x AS (SELECT d.is_late, fr.avg_freight_ratio FROM f_d d LEFT JOIN fr ON d.order_id = fr.order_id)
SELECT is_late, count(*) AS orders, round_even(median(avg_freight_ratio), 6) AS median_ratio,
       round_even(quantile_cont(avg_freight_ratio, 0.25), 6) AS p25_ratio,
       round_even(quantile_cont(avg_freight_ratio, 0.75), 6) AS p75_ratio
FROM x GROUP BY 1
""")
def agg54_freight_ratio_by_lateness(spark, sf):
    """AGG-54: per-order mean item freight ratio; its median and quartiles for on-time vs late orders."""
    m = _m(spark, sf)
    from ..functions.columns import ratio
    fr = m.items.groupBy("order_id").agg(F.avg(ratio("freight_value", "price")).alias("avg_freight_ratio"))
    x = dated_delivered(m).select("order_id", "is_late").join(fr, "order_id", "left")
    g = agg_with_quantiles(x, ["is_late"], [F.count(F.lit(1)).alias("orders")], {
        "median_ratio": ("avg_freight_ratio", 0.5), "p25_ratio": ("avg_freight_ratio", 0.25), "p75_ratio": ("avg_freight_ratio", 0.75)})
    return g.select("is_late", "orders", *[r(c, 6).alias(c) for c in ("median_ratio", "p25_ratio", "p75_ratio")])


@query("agg55_basket_size", """
WITH b AS (SELECT order_id, count(order_item_id) AS items FROM f_items GROUP BY 1)
SELECT items, count(*) AS orders, round_even(count(*) / sum(count(*)) OVER () * 100, 3) AS pct FROM b GROUP BY 1
""")
def agg55_basket_size(spark, sf):
    """AGG-55: orders by number of lines."""
    b = _m(spark, sf).items.groupBy("order_id").agg(F.count("order_item_id").alias("items"))
    g = b.groupBy("items").agg(F.count(F.lit(1)).alias("orders"))
    return g.select("items", "orders", r(F.col("orders") / F.sum("orders").over(Window.partitionBy()) * 100, 3)
                    .alias("pct"))


__all__ = ["M", "micros"]
