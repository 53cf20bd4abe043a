"""Aggregate mart, part 1: temporal, delivery, geography, customers, sellers,
categories (AGG-7 .. AGG-22, WIN-4..7, WIN-15, TOP-1).

Each report is a group-by over the item star or the master order table.
Published numbers are rounded half to even (``bround`` / ``round_even``).
Groups with a null key are dropped, as pandas' ``groupby`` does.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import frac_days, r
from ..operators import mart as M
from ..registry import query
from ..sources.fixtures import market
from .core import dated_delivered, delivered_orders, item_star, order_master


def _m(spark, sf):
    return market(spark, sf)


# ---------------------------------------------------------------- AGG-13 (flagship)
@query("agg13_lane_summary", """
SELECT i.customer_state, i.seller_state, count(*) AS n,
       round_even(median(i.freight_value), 1) AS median_freight,
       round_even(median(i.distance_km), 1) AS median_distance,
       round_even(median(o.delivery_days), 1) AS median_delivery_days
FROM f_item_star i LEFT JOIN f_order_master o ON i.order_id = o.order_id
WHERE i.customer_state IS NOT NULL AND i.seller_state IS NOT NULL
GROUP BY 1, 2
""")
def agg13_lane_summary(spark, sf):
    """AGG-13: customer_state x seller_state lanes: n and medians of freight, distance, delivery days."""
    m = _m(spark, sf)
    return M.lane_summary(item_star(m), order_master(m))


# ---------------------------------------------------------------- temporal (AGG-7..9)
@query("agg07_monthly", """
WITH g AS (
  SELECT purchase_month, count(DISTINCT order_id) AS orders, round_even(sum(order_total), 2) AS revenue,
         round_even(avg(is_late::INT) * 100, 1) AS late_rate
  FROM f_delivered GROUP BY 1)
SELECT * FROM g WHERE purchase_month < (SELECT max(purchase_month) FROM g)
""")
def agg07_monthly(spark, sf):
    """AGG-7: monthly orders, revenue, late rate of delivered orders; last (partial) month dropped."""
    return M.monthly(delivered_orders(_m(spark, sf)))


@query("agg08_orders_by_month_year", """
SELECT month(order_purchase_timestamp) AS mon, year(order_purchase_timestamp) AS year, count(order_id) AS orders
FROM f_orders GROUP BY 1, 2
""")
def agg08_orders_by_month_year(spark, sf):
    """AGG-8: orders by calendar month and year (long form)."""
    o = _m(spark, sf).orders
    ts = F.col("order_purchase_timestamp")
    return (o.groupBy(F.month(ts).alias("mon"), F.year(ts).alias("year"))
            .agg(F.count("order_id").alias("orders")))


@query("agg09_dow_hour", """
SELECT purchase_dow AS dow, purchase_hour AS hour, count(*) AS orders FROM f_order_master GROUP BY 1, 2
""")
def agg09_dow_hour(spark, sf):
    """AGG-9: orders by weekday name and hour."""
    o = order_master(_m(spark, sf))
    return o.groupBy(F.col("purchase_dow").alias("dow"), F.col("purchase_hour").alias("hour")).agg(
        F.count(F.lit(1)).alias("orders"))


# ---------------------------------------------------------------- delivery (AGG-10..12)
@query("agg10_leadtime", """
WITH s AS (
  SELECT avg((epoch_us(order_approved_at) - epoch_us(order_purchase_timestamp)) / 86400000000.0) AS a,
         avg((epoch_us(order_delivered_carrier_date) - epoch_us(order_approved_at)) / 86400000000.0) AS b,
         avg((epoch_us(order_delivered_customer_date) - epoch_us(order_delivered_carrier_date)) / 86400000000.0)
             AS c
  FROM f_delivered)
SELECT 'purchase->approval' AS stage, round_even(a, 2) AS avg_days FROM s
UNION ALL SELECT 'approval->carrier', round_even(b, 2) FROM s
UNION ALL SELECT 'carrier->customer', round_even(c, 2) FROM s
""")
def agg10_leadtime(spark, sf):
    """AGG-10: mean fractional days per stage, purchase -> approval -> carrier -> customer (SHP-3 long form)."""
    d = delivered_orders(_m(spark, sf))
    s = d.agg(F.avg(frac_days("order_approved_at", "order_purchase_timestamp")).alias("a"),
              F.avg(frac_days("order_delivered_carrier_date", "order_approved_at")).alias("b"),
              F.avg(frac_days("order_delivered_customer_date", "order_delivered_carrier_date")).alias("c"))
    return s.select(F.explode(F.array(
        F.struct(F.lit("purchase->approval").alias("stage"), r("a", 2).alias("avg_days")),
        F.struct(F.lit("approval->carrier").alias("stage"), r("b", 2).alias("avg_days")),
        F.struct(F.lit("carrier->customer").alias("stage"), r("c", 2).alias("avg_days")))).alias("s")
    ).select("s.*")


@query("agg11_delivery_days_hist", """
WITH x AS (SELECT least(greatest(delivery_days, 0), 60)::DOUBLE AS v FROM f_d),
b AS (SELECT least(CAST(floor((v - 0) / 1.5::DOUBLE) AS BIGINT), 39) AS bin, count(*) AS n FROM x GROUP BY 1)
SELECT round_even((0 + g.range * 1.5::DOUBLE + 0 + (g.range + 1) * 1.5::DOUBLE) / 2, 2) AS bin_mid,
       coalesce(b.n, 0) AS count
FROM range(40) g LEFT JOIN b ON g.range = b.bin
""")
def agg11_delivery_days_hist(spark, sf):
    """AGG-11: 40-bin histogram of delivery days clipped to [0, 60], empty bins kept."""
    d = dated_delivered(_m(spark, sf))
    return M.histogram(spark, d.select(F.col("delivery_days").alias("v")), 0.0, 60.0, 40)


@query("agg11_days_late_hist", """
WITH x AS (SELECT days_late::DOUBLE AS v FROM f_d WHERE days_late BETWEEN -30 AND 30),
b AS (SELECT least(CAST(floor((v - -30.0) / 1.5::DOUBLE) AS BIGINT), 39) AS bin, count(*) AS n FROM x GROUP BY 1)
SELECT round_even((-30.0 + g.range * 1.5::DOUBLE + -30.0 + (g.range + 1) * 1.5::DOUBLE) / 2, 2) AS bin_mid,
       coalesce(b.n, 0) AS count
FROM range(40) g LEFT JOIN b ON g.range = b.bin
""")
def agg11_days_late_hist(spark, sf):
    """AGG-11: 40-bin histogram of days late within +-30 days."""
    d = dated_delivered(_m(spark, sf)).filter(F.col("days_late").between(-30, 30))
    return M.histogram(spark, d.select(F.col("days_late").alias("v")), -30.0, 30.0, 40)


@query("agg12_state_summary", """
WITH s AS (
  SELECT customer_state, count(order_id) AS orders, median(delivery_days) AS median_delivery_days,
         round_even(avg(is_late::INT) * 100, 1) AS late_rate
  FROM f_d WHERE customer_state IS NOT NULL GROUP BY 1),
f AS (
  SELECT customer_state, round_even(median(freight_value), 2) AS median_freight,
         round_even(median(distance_km), 1) AS median_distance,
         round_even(median(freight_ratio) * 100, 1) AS median_burden
  FROM f_item_star WHERE freight_value IS NOT NULL AND customer_state IS NOT NULL GROUP BY 1)
SELECT s.*, f.median_freight, f.median_distance, f.median_burden
FROM s LEFT JOIN f ON s.customer_state = f.customer_state
""")
def agg12_state_summary(spark, sf):
    """AGG-12: per customer state: orders, median delivery days, late %, median freight, distance, burden."""
    m = _m(spark, sf)
    return M.state_summary(dated_delivered(m), item_star(m))


# ---------------------------------------------------------------- lanes (AGG-14, AGG-15)
@query("agg14_lane_spend", """
WITH g AS (
  SELECT seller_state || '->' || customer_state AS lane, count(*) AS lines,
         round_even(sum(freight_value), 2) AS freight_spend, sum(freight_value) AS s
  FROM f_item_star WHERE seller_state IS NOT NULL AND customer_state IS NOT NULL GROUP BY 1)
SELECT lane, lines, freight_spend, round_even(s / sum(s) OVER () * 100, 3) AS pct_of_spend,
       row_number() OVER (ORDER BY s DESC, lane) AS spend_rank
FROM g
""")
def agg14_lane_spend(spark, sf):
    """AGG-14 / PRJ-18 / WIN-15: lanes (seller -> customer state) ranked by freight spend with share of total."""
    return M.lane_spend(item_star(_m(spark, sf)))


@query("agg15_corridor", """
WITH top AS (
  SELECT seller_state FROM f_item_star WHERE seller_state IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, seller_state LIMIT 1),
x AS (SELECT i.*, i.seller_state = t.seller_state AS from_hub, i.customer_state = t.seller_state AS to_hub
      FROM f_item_star i, top t WHERE i.seller_state IS NOT NULL AND i.customer_state IS NOT NULL)
SELECT round_even(avg((from_hub AND to_hub)::INT) * 100, 3) AS hub_hub_line_pct,
       round_even(avg((from_hub AND NOT to_hub)::INT) * 100, 3) AS hub_out_line_pct,
       round_even(sum(freight_value) FILTER (WHERE from_hub AND to_hub) / sum(freight_value) * 100, 3)
           AS hub_hub_freight_pct,
       round_even(sum(freight_value) FILTER (WHERE from_hub AND NOT to_hub) / sum(freight_value) * 100, 3)
           AS hub_out_freight_pct,
       round_even(median(distance_km) FILTER (WHERE from_hub AND to_hub), 3) AS hub_hub_median_km,
       round_even(median(distance_km) FILTER (WHERE from_hub AND NOT to_hub), 3) AS hub_out_median_km
FROM x
""")
def agg15_corridor(spark, sf):
    """AGG-15: the busiest origin state (the hub) shipping inside itself vs to other states:
    share of lines and freight, median km."""
    return M.corridor(item_star(_m(spark, sf)))


# ---------------------------------------------------------------- customers (AGG-16..19, WIN-4, WIN-5)
@query("agg16_orders_per_customer", """
WITH c AS (SELECT customer_unique_id, count(DISTINCT order_id) AS orders FROM f_order_master GROUP BY 1)
SELECT CASE WHEN orders >= 5 THEN '5+' ELSE CAST(orders AS VARCHAR) END AS orders_placed, count(*) AS customers
FROM c GROUP BY 1
""")
def agg16_orders_per_customer(spark, sf):
    """AGG-16: customers by number of orders placed, 1..4 and 5+."""
    return M.orders_per_customer(order_master(_m(spark, sf)))


@query("agg16_repeat_rate", """
WITH c AS (SELECT customer_unique_id, count(DISTINCT order_id) AS orders, sum(order_total) AS spend
           FROM f_order_master GROUP BY 1)
SELECT count(*) AS customers, round_even(avg((orders > 1)::INT) * 100, 2) AS repeat_rate,
       round_even(sum(spend) FILTER (WHERE orders > 1) / sum(spend) * 100, 1) AS repeat_rev_share
FROM c
""")
def agg16_repeat_rate(spark, sf):
    """AGG-16: repeat rate and repeat customers' share of revenue."""
    return M.repeat_rate(order_master(_m(spark, sf)))


@query("win04_repeat_gap", """
WITH r AS (
  SELECT customer_unique_id, order_purchase_timestamp AS ts,
         row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id) AS k
  FROM f_order_master),
g AS (SELECT customer_unique_id,
             CAST(floor((epoch_us(max(ts) FILTER (WHERE k = 2)) - epoch_us(max(ts) FILTER (WHERE k = 1)))
                        / 86400000000.0) AS BIGINT) AS gap_days
      FROM r WHERE k <= 2 GROUP BY 1 HAVING count(*) = 2)
SELECT count(*) AS repeat_customers, median(gap_days) AS gap_median,
       quantile_cont(gap_days, 0.25) AS gap_p25, quantile_cont(gap_days, 0.75) AS gap_p75
FROM g
""")
def win04_repeat_gap(spark, sf):
    """WIN-4: whole days between a person's first and second order; median, p25, p75."""
    return M.repeat_gap(order_master(_m(spark, sf)))


@query("win05_new_vs_returning", """
WITH o AS (
  SELECT purchase_month, purchase_month > min(purchase_month) OVER (PARTITION BY customer_unique_id) AS is_ret
  FROM f_order_master)
SELECT purchase_month, count(*) FILTER (WHERE NOT is_ret) AS new_orders,
       count(*) FILTER (WHERE is_ret) AS returning_orders,
       round_even(avg(is_ret::INT) * 100, 3) AS returning_pct
FROM o GROUP BY 1
""")
def win05_new_vs_returning(spark, sf):
    """WIN-5 / JON-16: orders per month from new vs returning people (month after their first month)."""
    return M.new_vs_returning(order_master(_m(spark, sf)))


@query("agg17_segments", """
WITH c AS (SELECT customer_unique_id, count(DISTINCT order_id) AS n, sum(order_total) AS spend
           FROM f_order_master GROUP BY 1),
o AS (SELECT o.*, CASE WHEN c.n > 1 THEN 'repeat' ELSE 'one-time' END AS segment
      FROM f_order_master o JOIN c ON o.customer_unique_id = c.customer_unique_id)
SELECT s.segment, s.customers, s.mean_spend, o2.mean_order_value, o2.late_rate, o2.mean_delivery_days
FROM (SELECT CASE WHEN n > 1 THEN 'repeat' ELSE 'one-time' END AS segment, count(*) AS customers,
             round_even(avg(spend), 4) AS mean_spend FROM c GROUP BY 1) s
JOIN (SELECT segment, round_even(avg(order_total), 4) AS mean_order_value,
             round_even(avg(is_late::INT) FILTER (WHERE order_status = 'delivered' AND delivery_days IS NOT NULL)
                        * 100, 3) AS late_rate,
             round_even(avg(delivery_days), 4) AS mean_delivery_days
      FROM o GROUP BY 1) o2 ON s.segment = o2.segment
""")
def agg17_segments(spark, sf):
    """AGG-17: one-time vs repeat people: mean spend, mean order value, late rate, delivery days."""
    return M.segments(order_master(_m(spark, sf)))


@query("agg18_demand_top_states", """
SELECT customer_state, round_even(count(*) / (SELECT count(*) FROM f_order_master) * 100, 1) AS pct_orders
FROM f_order_master WHERE customer_state IS NOT NULL
GROUP BY 1 ORDER BY count(*) DESC, customer_state LIMIT 10
""")
def agg18_demand_top_states(spark, sf):
    """AGG-18 / TOP-1: the ten states with most orders, as % of all orders."""
    return M.demand_top(order_master(_m(spark, sf)), 10)


@query("agg19_supply_demand_gap", """
WITH s AS (SELECT seller_state AS state, count(*) / sum(count(*)) OVER () * 100 AS supply_pct
           FROM f_sellers WHERE seller_state IS NOT NULL GROUP BY 1),
d AS (SELECT customer_state AS state, count(*) / sum(count(*)) OVER () * 100 AS demand_pct
      FROM f_order_master WHERE customer_state IS NOT NULL GROUP BY 1),
j AS (SELECT coalesce(s.state, d.state) AS state, coalesce(s.supply_pct, 0) AS sp, coalesce(d.demand_pct, 0) AS dp
      FROM s FULL JOIN d ON s.state = d.state)
SELECT state, round_even(sp, 3) AS supply_pct, round_even(dp, 3) AS demand_pct,
       round_even(sp - dp, 3) AS gap_pct
FROM j ORDER BY sp + dp DESC, state LIMIT 10
""")
def agg19_supply_demand_gap(spark, sf):
    """AGG-19 / JON-6: seller share vs order share by state (full outer, null -> 0), top 10 by the sum."""
    m = _m(spark, sf)
    return M.supply_demand(m.sellers, order_master(m), 10)


# ---------------------------------------------------------------- sellers (AGG-20, WIN-6, WIN-7)
@query("agg20_seller_items", """
WITH s AS (SELECT seller_id, count(order_item_id) AS items FROM f_item_star GROUP BY 1)
SELECT count(*) AS sellers, median(items) AS items_median, quantile_cont(items, 0.9) AS items_p90,
       max(items) AS items_max, round_even(avg((items <= 10)::INT) * 100, 2) AS le10_pct
FROM s
""")
def agg20_seller_items(spark, sf):
    """AGG-20: lines per seller: median, p90, max, % with at most 10."""
    return M.seller_items(item_star(_m(spark, sf)))


@query("win06_seller_concentration", """
WITH s AS (SELECT seller_id, sum(price) AS rev FROM f_item_star GROUP BY 1),
c AS (SELECT seller_id, rev, row_number() OVER (ORDER BY rev DESC, seller_id) AS k, count(*) OVER () AS n,
             sum(rev) OVER (ORDER BY rev DESC, seller_id ROWS UNBOUNDED PRECEDING) / sum(rev) OVER () AS cum
      FROM s)
SELECT count(*) FILTER (WHERE cum <= 0.8) AS sellers_80,
       round_even(count(*) FILTER (WHERE cum <= 0.8) / max(n) * 100, 3) AS sellers_80_pct,
       round_even(max(cum) FILTER (WHERE k = CASE WHEN floor(n * 0.01::DOUBLE) = 0 THEN n ELSE floor(n * 0.01::DOUBLE) END) * 100, 3) AS top1_pct,
       round_even(max(cum) FILTER (WHERE k = CASE WHEN floor(n * 0.05::DOUBLE) = 0 THEN n ELSE floor(n * 0.05::DOUBLE) END) * 100, 3) AS top5_pct,
       round_even(max(cum) FILTER (WHERE k = CASE WHEN floor(n * 0.10::DOUBLE) = 0 THEN n ELSE floor(n * 0.10::DOUBLE) END) * 100, 3) AS top10_pct,
       round_even(max(cum) FILTER (WHERE k = CASE WHEN floor(n * 0.20::DOUBLE) = 0 THEN n ELSE floor(n * 0.20::DOUBLE) END) * 100, 3) AS top20_pct
FROM c
""")
def win06_seller_concentration(spark, sf):
    """WIN-6: cumulative revenue share by revenue-ranked seller; sellers under 80%; share of top 1/5/10/20%."""
    return M.seller_concentration(item_star(_m(spark, sf)))


@query("win07_seller_pareto", """
WITH s AS (SELECT seller_id, sum(price) AS rev FROM f_item_star GROUP BY 1),
c AS (SELECT row_number() OVER (ORDER BY rev DESC, seller_id) - 1 AS i, count(*) OVER () AS n,
             sum(rev) OVER (ORDER BY rev DESC, seller_id ROWS UNBOUNDED PRECEDING) / sum(rev) OVER () AS cum
      FROM s),
p AS (SELECT DISTINCT CASE WHEN g.range = 249 THEN n - 1
                            ELSE CAST(floor(g.range * ((n - 1) / 249.0::DOUBLE)) AS BIGINT) END AS i
      FROM (SELECT max(n) AS n FROM c) t, range(250) g)
SELECT round_even((c.i + 1) / c.n * 100, 3) AS pct_sellers, round_even(c.cum * 100, 3) AS cum_revenue
FROM c JOIN p ON c.i = p.i
""")
def win07_seller_pareto(spark, sf):
    """WIN-7: the concentration curve thinned to about 250 evenly spaced ranks."""
    return M.seller_pareto(item_star(_m(spark, sf)), 250)


# ---------------------------------------------------------------- inter-state, categories (AGG-21, AGG-22)
@query("agg21_interstate", """
WITH x AS (SELECT *, seller_state <> customer_state AS interstate FROM f_item_star
           WHERE seller_state IS NOT NULL AND customer_state IS NOT NULL)
SELECT interstate, round_even(count(*) / (SELECT count(*) FROM x) * 100, 4) AS share,
       median(freight_value) AS med_freight, round_even(median(distance_km), 4) AS med_dist,
       round_even(median(freight_ratio), 6) AS med_ratio
FROM x GROUP BY 1
""")
def agg21_interstate(spark, sf):
    """AGG-21 / PRJ-5: inter- vs intra-state lines: share, median freight, distance, ratio."""
    return M.interstate(item_star(_m(spark, sf)))


@query("agg22_category_summary", """
SELECT category, count(order_item_id) AS lines, round_even(sum(price), 3) AS revenue,
       round_even(median(price), 3) AS med_price, round_even(median(freight_value), 3) AS med_freight,
       round_even(median(freight_ratio), 3) AS med_ratio, round_even(median(weight_kg), 3) AS med_weight
FROM f_item_star WHERE category IS NOT NULL GROUP BY 1
""")
def agg22_category_summary(spark, sf):
    """AGG-22: per category: lines, revenue, median price, freight, ratio, weight."""
    return M.category_summary(item_star(_m(spark, sf)))


@query("agg22_top10_shares", """
WITH c AS (SELECT category, count(order_item_id) AS lines, sum(price) AS revenue FROM f_item_star
           WHERE category IS NOT NULL GROUP BY 1)
SELECT count(*) AS n_categories,
       round_even((SELECT sum(lines) FROM (SELECT lines FROM c ORDER BY lines DESC, category LIMIT 10))
                  / sum(lines) * 100, 3) AS top10_vol_pct,
       round_even((SELECT sum(revenue) FROM (SELECT revenue FROM c ORDER BY revenue DESC, category LIMIT 10))
                  / sum(revenue) * 100, 3) AS top10_rev_pct
FROM c
""")
def agg22_top10_shares(spark, sf):
    """AGG-22 / WIN-15: share of lines and of revenue in the top-10 categories."""
    return M.category_top_shares(item_star(_m(spark, sf)), 10)


__all__ = ["Window"]
