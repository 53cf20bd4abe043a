"""Core-table and feature queries: JON-1..4, JON-10..12, AGG-1..6, WIN-1..3,
PRJ-1..24, WIN-14."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import (clip, cut, epoch_seconds, expm1_floor0, floor_days, frac_days, late_flag, r,
                                 ratio)
from ..functions.geo import lane, normalise_zip, region_table
from ..operators.mart import pct
from ..operators.ranking import agg_with_quantiles, exact_quantiles, global_running
from ..registry import query
from ..sources.fixtures import market
from .core import (item_features, item_frame, item_star, order_features, order_master, platform_loads,
                   seller_loads)
from .q_sources import ntz


def round_floats(df, digits=6):
    """Round every double column (output only; keeps the two engines' last-bit sum differences out)."""
    return df.select(*[r(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


def _sql_round_all(view, cols):
    """``SELECT * REPLACE`` rounding the listed double columns of ``view`` to 6 dp."""
    return f"SELECT * REPLACE ({', '.join(f'round_even({c}, 6) AS {c}' for c in cols)}) FROM {view}"


@query("jon01_item_star", _sql_round_all("f_item_star", [
    "price", "freight_value", "weight_kg", "volumetric_weight_kg", "volume_cm3", "chargeable_kg", "sell_lat",
    "sell_lng", "cust_lat", "cust_lng", "distance_km", "freight_ratio"]))
def jon01_item_star(spark, sf):
    """JON-1: the item star table (lines left-joined to orders, products, seller and customer geography)."""
    return round_floats(ntz(item_star(market(spark, sf))))


@query("jon03_order_master", _sql_round_all("f_order_master", [
    "item_total", "freight_total", "payment_total", "order_total", "freight_ratio"]))
def jon03_order_master(spark, sf):
    """JON-3: the master order table (children pre-aggregated to order grain, then left-joined)."""
    return round_floats(ntz(order_master(market(spark, sf))))


@query("jon02_item_frame", _sql_round_all("f_item_frame", ["price", "freight_value", "weight_kg", "volume_cm3",
                                                           "chargeable_kg", "photos_qty", "name_len", "desc_len",
                                                           "distance_km"]))
def jon02_item_frame(spark, sf):
    """JON-2: lines inner-joined to orders, customers, sellers, left to products, with basket counts
    (price > 0)."""
    return round_floats(ntz(item_frame(market(spark, sf))))


@query("agg06_item_features", _sql_round_all("f_item_features", [
    "purchase_ts", "freight_value", "freight_ratio", "reg_target", "chargeable_kg", "desc_len", "distance_km",
    "name_len", "photos_qty", "price", "volume_cm3", "weight_kg"]))
def agg06_item_features(spark, sf):
    """AGG-6 / PRJ-11 / PRJ-23: the fair-freight model table, target log1p(freight)."""
    return round_floats(ntz(item_features(market(spark, sf))))


_LOADS_SQL = """
SELECT l.order_id, l.platform_load_7d,
       round_even(least(greatest(l.platform_load_7d / greatest(l.load_28d / 4.0, 1.0), 0.0), 3.0), 6)
           AS platform_surge_7d,
       l.seller_load_7d
FROM f_order_loads l"""


@query("jon10_platform_load", "SELECT order_id, platform_load_7d FROM f_order_loads")
def jon10_platform_load(spark, sf):
    """JON-10: orders of any status placed in [t - 7 days, t) for every delivered, dated order."""
    return platform_loads(market(spark, sf)).select("order_id", "platform_load_7d")


@query("jon11_platform_surge", """
SELECT order_id, round_even(least(greatest(platform_load_7d / greatest(load_28d / 4.0, 1.0), 0.0), 3.0), 6)
    AS platform_surge_7d FROM f_order_loads
""")
def jon11_platform_surge(spark, sf):
    """JON-11: last 7 days against the average week of the 28 days before them (floor 1), clipped to [0, 3]."""
    return platform_loads(market(spark, sf)).select("order_id", r("platform_surge_7d", 6).alias("platform_surge_7d"))


@query("jon12_seller_load", "SELECT order_id, seller_load_7d FROM f_order_loads")
def jon12_seller_load(spark, sf):
    """JON-12: the main seller's distinct orders (any status) in [t - 7 days, t)."""
    return seller_loads(market(spark, sf)).select("order_id", "seller_load_7d")


@query("agg05_order_features", """
SELECT * REPLACE (round_even(price_total, 6) AS price_total, round_even(freight_total, 6) AS freight_total,
                  round_even(weight_kg, 6) AS weight_kg, round_even(volume_cm3, 6) AS volume_cm3,
                  round_even(chargeable_kg, 6) AS chargeable_kg, round_even(distance_km, 6) AS distance_km,
                  round_even(freight_ratio, 6) AS freight_ratio, round_even(promised_days, 6) AS promised_days,
                  round_even(purchase_ts, 6) AS purchase_ts)
FROM (SELECT f.*, l.platform_load_7d,
             round_even(least(greatest(l.platform_load_7d / greatest(l.load_28d / 4.0, 1.0), 0.0), 3.0), 6)
                 AS platform_surge_7d, l.seller_load_7d
      FROM f_order_features f LEFT JOIN f_order_loads l ON f.order_id = l.order_id)
""")
def agg05_order_features(spark, sf):
    """AGG-5: the late-delivery model table, one row per delivered and dated order: main-line attributes,
    summed parcel, promise, target, trailing loads."""
    o = order_features(market(spark, sf))
    return round_floats(ntz(o.withColumn("platform_surge_7d", r("platform_surge_7d", 6))))


# ---------------------------------------------------------------- AGG-1..4, JON-4, WIN-1..3
@query("agg01_zip_centroids", """
SELECT zip, round_even(lat, 6) AS lat, round_even(lng, 6) AS lng, n_points FROM f_centroids
""")
def agg01_zip_centroids(spark, sf):
    """AGG-1: zip centroid = median lat/lng of the points inside the coordinate box, with point count."""
    c = market(spark, sf).zip_centroids
    return c.select("zip", r("lat", 6).alias("lat"), r("lng", 6).alias("lng"), "n_points")


@query("agg02_zip_state_and_state_centre", """
WITH zs AS (SELECT geolocation_zip_code_prefix AS zip, geolocation_state AS state, count(*) AS n FROM f_geo GROUP BY 1, 2),
zm AS (SELECT zip, arg_max(state, (n, state)) AS state FROM zs GROUP BY 1),
sc AS (SELECT z.state, median(c.lat) AS state_lat, median(c.lng) AS state_lng
       FROM zm z JOIN f_centroids c ON z.zip = c.zip GROUP BY 1)
SELECT z.zip, z.state, round_even(sc.state_lat, 6) AS state_lat, round_even(sc.state_lng, 6) AS state_lng
FROM zm z LEFT JOIN sc ON z.state = sc.state
""")
def agg02_zip_state_and_state_centre(spark, sf):
    """AGG-2: most frequent state per zip (ties to the larger name) and the median centre of each state's zips."""
    m = market(spark, sf)
    g = m.geolocation
    zs = g.groupBy(F.col("geolocation_zip_code_prefix").alias("zip"), F.col("geolocation_state").alias("state")).agg(
        F.count(F.lit(1)).alias("n"))
    zm = zs.groupBy("zip").agg(F.max_by("state", F.struct("n", "state")).alias("state"))
    sc = (zm.join(m.zip_centroids, "zip").groupBy("state")
          .agg(F.median("lat").alias("state_lat"), F.median("lng").alias("state_lng")))
    return zm.join(sc, "state", "left").select("zip", "state", r("state_lat", 6).alias("state_lat"),
                                               r("state_lng", 6).alias("state_lng"))


@query("agg03_basket_per_order", """
SELECT order_id, count(order_item_id) AS n_items, count(DISTINCT seller_id) AS n_sellers,
       count(DISTINCT product_id) AS n_products, round_even(sum(price), 6) AS item_total,
       round_even(sum(freight_value), 6) AS freight_total
FROM f_items GROUP BY 1
""")
def agg03_basket_per_order(spark, sf):
    """AGG-3: per order: lines, distinct sellers and products, item and freight totals."""
    it = market(spark, sf).items
    return it.groupBy("order_id").agg(
        F.count("order_item_id").alias("n_items"), F.count_distinct("seller_id").alias("n_sellers"),
        F.count_distinct("product_id").alias("n_products"), r(F.sum("price"), 6).alias("item_total"),
        r(F.sum("freight_value"), 6).alias("freight_total"))


@query("agg04_payments_per_order", """
SELECT order_id, round_even(sum(payment_value), 6) AS payment_total, max(payment_installments) AS max_installments,
       count(payment_sequential) AS n_payment_rows
FROM f_payments GROUP BY 1
""")
def agg04_payments_per_order(spark, sf):
    """AGG-4: per order: payment total, max instalments, payment rows."""
    p = market(spark, sf).payments
    return p.groupBy("order_id").agg(r(F.sum("payment_value"), 6).alias("payment_total"),
                                     F.max("payment_installments").alias("max_installments"),
                                     F.count("payment_sequential").alias("n_payment_rows"))


@query("jon04_geo_resolution", """
SELECT 'seller' AS party, count(*) AS rows, count(sell_lat) AS resolved, count(*) - count(sell_lat) AS unresolved
FROM f_seller_geo
UNION ALL
SELECT 'customer', count(*), count(cust_lat), count(*) - count(cust_lat) FROM f_customer_geo
""")
def jon04_geo_resolution(spark, sf):
    """JON-4: seller and customer zip -> centroid (broadcast left joins; null when the zip is unknown)."""
    m = market(spark, sf)
    s = m.seller_geo.agg(F.lit("seller").alias("party"), F.count(F.lit(1)).alias("rows"),
                         F.count("sell_lat").alias("resolved"),
                         (F.count(F.lit(1)) - F.count("sell_lat")).alias("unresolved"))
    c = m.customer_geo.agg(F.lit("customer").alias("party"), F.count(F.lit(1)).alias("rows"),
                           F.count("cust_lat").alias("resolved"),
                           (F.count(F.lit(1)) - F.count("cust_lat")).alias("unresolved"))
    return s.unionByName(c)


@query("win01_main_item", """
SELECT order_id, arg_max(seller_id, (price, -order_item_id)) AS seller_id,
       arg_max(seller_state, (price, -order_item_id)) AS seller_state,
       arg_max(category, (price, -order_item_id)) AS category, max(price) AS price
FROM f_item_star GROUP BY 1
""")
def win01_main_item(spark, sf):
    """WIN-1: main line per order = highest price (ties: first line), with its seller, state and category.
    ``max_by`` over a (price, -line) key is a partial aggregate: no per-order sort."""
    it = item_star(market(spark, sf))
    key = F.struct(F.col("price"), -F.col("order_item_id"))
    return it.groupBy("order_id").agg(F.max_by("seller_id", key).alias("seller_id"),
                                      F.max_by("seller_state", key).alias("seller_state"),
                                      F.max_by("category", key).alias("category"), F.max("price").alias("price"))


@query("win02_latest_review", """
SELECT order_id, arg_max(review_score, (review_creation_date, review_id)) AS review_score,
       (arg_max(review_score, (review_creation_date, review_id)) <= 2)::INT AS low
FROM f_reviews GROUP BY 1
""")
def win02_latest_review(spark, sf):
    """WIN-2: latest review per order (ties: last row) and the low-review flag (score <= 2)."""
    rv = market(spark, sf).reviews
    g = rv.groupBy("order_id").agg(F.max_by("review_score", F.struct("review_creation_date", "review_id"))
                                   .alias("review_score"))
    return g.withColumn("low", (F.col("review_score") <= 2).cast("int"))


@query("win03_main_payment", """
SELECT order_id, arg_max(payment_type, (payment_value, -payment_sequential)) AS primary_payment_type
FROM f_payments GROUP BY 1
""")
def win03_main_payment(spark, sf):
    """WIN-3: main payment type per order = largest payment (ties: first row)."""
    p = market(spark, sf).payments
    return p.groupBy("order_id").agg(
        F.max_by("payment_type", F.struct(F.col("payment_value"), -F.col("payment_sequential")))
        .alias("primary_payment_type"))


# ---------------------------------------------------------------- PRJ columns
TARIFF = {"intercept": 9.614, "per_kg": 1.846, "per_100km": 0.811, "same_state": -3.985}  # fixed values


def tariff(ckg, km, same_state, coef=TARIFF):
    """STA-10: linear tariff with literal coefficients, floored at 0; null distance gives null
    (``greatest`` alone would skip the null)."""
    ckg, km, same_state = (F.col(c) if isinstance(c, str) else c for c in (ckg, km, same_state))
    est = (F.lit(coef["intercept"]) + F.lit(coef["per_kg"]) * ckg + F.lit(coef["per_100km"]) * km / 100
           + F.lit(coef["same_state"]) * same_state)
    return F.when(km.isNull(), F.lit(None)).otherwise(F.greatest(est, F.lit(0.0)))


@query("prj_item_columns", """
SELECT order_id, order_item_id,
  round_even(distance_km, 6) AS distance_km,
  round_even(volumetric_weight_kg, 6) AS volumetric_weight_kg, round_even(chargeable_kg, 6) AS chargeable_kg,
  category,
  round_even(freight_ratio, 6) AS freight_ratio, round_even(freight_ratio * 100, 6) AS burden_pct,
  (seller_state = customer_state)::INT AS same_state, (seller_state <> customer_state)::INT AS interstate,
  month(order_purchase_timestamp) AS purchase_month, isodow(order_purchase_timestamp) - 1 AS purchase_dow,
  strftime(order_purchase_timestamp, '%A') AS purchase_day_name, hour(order_purchase_timestamp) AS purchase_hour,
  year(order_purchase_timestamp) AS purchase_year, strftime(order_purchase_timestamp, '%Y-%m') AS purchase_ym,
  round_even(epoch_us(order_purchase_timestamp) / 1e6, 6) AS purchase_ts,
  round_even(ln(1 + freight_value), 6) AS log_freight,
  round_even(greatest(exp(ln(1 + freight_value)) - 1, 0), 6) AS freight_back,
  CASE WHEN price > 0 AND price <= 30 THEN '<30' WHEN price > 30 AND price <= 60 THEN '30-60'
       WHEN price > 60 AND price <= 100 THEN '60-100' WHEN price > 100 AND price <= 200 THEN '100-200'
       WHEN price > 200 AND price <= 500 THEN '200-500' WHEN price > 500 THEN '500+' END AS price_band_right,
  CASE WHEN price >= 0 AND price < 30 THEN '<30' WHEN price >= 30 AND price < 60 THEN '30-60'
       WHEN price >= 60 AND price < 100 THEN '60-100' WHEN price >= 100 AND price < 200 THEN '100-200'
       WHEN price >= 200 AND price < 500 THEN '200-500' WHEN price >= 500 THEN '500+' END AS price_band_left,
  least(greatest(freight_value, 0.0), 100.0) AS freight_clipped,
  seller_state || '->' || customer_state AS lane,
  (freight_ratio > 0.25)::INT AS high_freight,
  round_even(CASE WHEN distance_km IS NULL THEN NULL
             ELSE greatest(9.614 + 1.846 * chargeable_kg + 0.811 * distance_km / 100
                           + -3.985 * (seller_state = customer_state)::INT, 0.0) END, 6) AS tariff
FROM f_item_star
""")
def prj_item_columns(spark, sf):
    """PRJ-1..6, 11..13, 15, 18..20, 23 and STA-10 as columns of the item table: distance, parcel size,
    ratio / burden, state flags, calendar parts, epoch seconds, log1p target and its back-transform,
    right- and left-closed price bands, clipping, lane, high-freight target, the literal tariff."""
    it = item_star(market(spark, sf))
    ts = F.col("order_purchase_timestamp")
    same = (F.col("seller_state") == F.col("customer_state")).cast("int")
    labels = ["<30", "30-60", "60-100", "100-200", "200-500", "500+"]
    edges = [0, 30, 60, 100, 200, 500, float("inf")]
    return it.select(
        "order_id", "order_item_id", r("distance_km", 6).alias("distance_km"),
        r("volumetric_weight_kg", 6).alias("volumetric_weight_kg"), r("chargeable_kg", 6).alias("chargeable_kg"),
        "category", r("freight_ratio", 6).alias("freight_ratio"),
        r(F.col("freight_ratio") * 100, 6).alias("burden_pct"),
        same.alias("same_state"), (F.col("seller_state") != F.col("customer_state")).cast("int").alias("interstate"),
        F.month(ts).alias("purchase_month"), F.weekday(ts).alias("purchase_dow"),
        F.date_format(ts, "EEEE").alias("purchase_day_name"), F.hour(ts).alias("purchase_hour"),
        F.year(ts).alias("purchase_year"), F.date_format(ts, "yyyy-MM").alias("purchase_ym"),
        r(epoch_seconds(ts), 6).alias("purchase_ts"),
        r(F.log1p("freight_value"), 6).alias("log_freight"),
        r(expm1_floor0(F.log1p("freight_value")), 6).alias("freight_back"),
        cut("price", edges, labels, right=True).alias("price_band_right"),
        cut("price", edges, labels, right=False).alias("price_band_left"),
        clip("freight_value", 0.0, 100.0).alias("freight_clipped"),
        lane("seller_state", "customer_state").alias("lane"),
        (F.col("freight_ratio") > 0.25).cast("int").alias("high_freight"),
        r(tariff("chargeable_kg", "distance_km", same), 6).alias("tariff"))


@query("prj_order_columns", """
SELECT order_id, delivery_days, est_days, days_late,
  round_even((epoch_us(order_estimated_delivery_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0, 6)
      AS promised_days,
  is_late, coalesce(order_delivered_customer_date > order_estimated_delivery_date, false) AS is_late_ts,
  round_even(order_total, 6) AS order_total, order_status = 'delivered' AS delivered
FROM f_order_master
""")
def prj_order_columns(spark, sf):
    """PRJ-7 (floor days), PRJ-8 (fractional days), PRJ-9 / PRJ-10 (two late rules), PRJ-21 (delivered
    population flag), PRJ-24 (totals with null as zero) on the order table."""
    o = order_master(market(spark, sf))
    return o.select("order_id", "delivery_days", "est_days", "days_late",
                    r(frac_days("order_estimated_delivery_date", "order_purchase_timestamp"), 6).alias("promised_days"),
                    "is_late",
                    F.coalesce(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"),
                               F.lit(False)).alias("is_late_ts"),
                    r("order_total", 6).alias("order_total"), (F.col("order_status") == "delivered").alias("delivered"))


@query("prj14_rank_strata", """
WITH k AS (SELECT freight_value, row_number() OVER (ORDER BY freight_value, order_id, order_item_id) AS rk,
                  count(*) OVER () AS n FROM f_items),
s AS (SELECT freight_value, (rk > 1 + 1 * (n - 1) / 5.0)::INT + (rk > 1 + 2 * (n - 1) / 5.0)::INT
             + (rk > 1 + 3 * (n - 1) / 5.0)::INT + (rk > 1 + 4 * (n - 1) / 5.0)::INT AS stratum FROM k)
SELECT stratum, count(*) AS n, min(freight_value) AS min_freight, max(freight_value) AS max_freight FROM s GROUP BY 1
""")
def prj14_rank_strata(spark, sf, k: int = 5):
    """PRJ-14: equal-count strata on first-ranks (``qcut(rank(first), 5)``: rank r goes to the number of
    interior edges 1 + j(n-1)/5 below it).  The global rank is the two-phase running count, not a window
    over all rows."""
    it = market(spark, sf).items.select("order_id", "order_item_id", "freight_value")
    g = global_running(it, ["freight_value", "order_id", "order_item_id"])
    n = F.col("_total_n")
    stratum = sum(((F.col("_k") > F.lit(1) + F.lit(j) * (n - 1) / F.lit(float(k))).cast("int")
                   for j in range(1, k)), F.lit(0))
    s = g.select("freight_value", stratum.alias("stratum"))
    return s.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.min("freight_value").alias("min_freight"),
                                    F.max("freight_value").alias("max_freight"))


@query("win14_binned_median_trend", """
WITH e AS (SELECT list_distinct(quantile_cont(distance_km, [0.0, 1/12, 2/12, 3/12, 4/12, 5/12, 6/12, 7/12, 8/12,
                                                            9/12, 10/12, 11/12, 1.0])) AS edges
           FROM f_item_star WHERE distance_km IS NOT NULL AND freight_value IS NOT NULL),
b AS (SELECT i.distance_km, i.freight_value, greatest(len(list_filter(e.edges, lambda x: x < i.distance_km)), 1) AS bin
      FROM f_item_star i, e WHERE i.distance_km IS NOT NULL AND i.freight_value IS NOT NULL)
SELECT bin, count(*) AS n, round_even(median(distance_km), 6) AS median_x, round_even(median(freight_value), 6) AS median_y
FROM b GROUP BY 1
""")
def win14_binned_median_trend(spark, sf, bins: int = 12):
    """WIN-14 / PRJ-14: 12 equal-count bins of distance (quantile edges, duplicates dropped, right-closed,
    lowest edge included), median distance and median freight per bin."""
    it = item_star(market(spark, sf)).filter(F.col("distance_km").isNotNull() & F.col("freight_value").isNotNull())
    qs = [j / bins for j in range(bins + 1)]
    e = exact_quantiles(it, {f"q{j}": ("distance_km", q) for j, q in enumerate(qs)}).select(
        F.array_distinct(F.array(*[f"q{j}" for j in range(bins + 1)])).alias("edges"))
    j = (it.withColumn("_one", F.lit(1)).join(F.broadcast(e.withColumn("_one", F.lit(1))), "_one")
         .withColumn("bin", F.greatest(F.size(F.filter("edges", lambda x: x < F.col("distance_km"))), F.lit(1))))
    g = agg_with_quantiles(j, ["bin"], [F.count(F.lit(1)).alias("n")], {"mx": ("distance_km", 0.5), "my": ("freight_value", 0.5)})
    return g.select("bin", "n", r("mx", 6).alias("median_x"), r("my", 6).alias("median_y"))


@query("prj16_region_map", """
WITH rt AS (SELECT n.n_name AS state, r.r_name AS region FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT rt.region, count(*) AS orders, round_even(avg(o.is_late::INT) * 100, 3) AS late_rate
FROM f_order_master o LEFT JOIN rt ON o.customer_state = rt.state
WHERE o.order_status = 'delivered' AND o.delivery_days IS NOT NULL GROUP BY 1
""")
def prj16_region_map(spark, sf):
    """PRJ-16: customer state -> region (unmapped -> null) through a broadcast lookup table, then late rate
    per region of delivered orders."""
    m = market(spark, sf)
    rt = region_table(m.raw("nation"), m.raw("region"))
    o = order_master(m).filter((F.col("order_status") == "delivered") & F.col("delivery_days").isNotNull())
    j = o.join(F.broadcast(rt), o.customer_state == rt.state, "left")
    return j.groupBy("region").agg(F.count(F.lit(1)).alias("orders"),
                                   r(F.avg(F.col("is_late").cast("int")) * 100, 3).alias("late_rate"))


_RAW_ZIP_SQL = """
CASE c_custkey % 6
  WHEN 0 THEN lpad(CAST(c_custkey * 7919 % 100000 AS VARCHAR), 5, '0')
  WHEN 1 THEN substr(lpad(CAST(c_custkey * 104729 % 100000000 AS VARCHAR), 8, '0'), 1, 5) || '-'
              || substr(lpad(CAST(c_custkey * 104729 % 100000000 AS VARCHAR), 8, '0'), 6, 3)
  WHEN 2 THEN CAST(c_custkey * 7919 % 100000 AS VARCHAR)
  WHEN 3 THEN CAST(c_custkey * 104729 % 100000000 AS VARCHAR)
  WHEN 4 THEN 'n/a ' || CAST(c_custkey % 100 AS VARCHAR)
  ELSE '' END"""


@query("prj17_zip_normalise", f"""
WITH z AS (SELECT c_custkey, {_RAW_ZIP_SQL} AS raw FROM customer),
d AS (SELECT c_custkey, raw, regexp_replace(raw, '[^0-9]', '', 'g') AS digits FROM z),
p AS (SELECT *, CASE WHEN length(digits) IN (4, 5) THEN CAST(digits AS INTEGER)
                     WHEN length(digits) IN (7, 8) THEN CAST(substr(lpad(digits, 8, '0'), 1, 5) AS INTEGER) END AS prefix
      FROM d)
SELECT CASE WHEN trim(raw) = '' THEN 'empty' WHEN prefix IS NULL THEN 'not a zip' WHEN prefix < 1000 THEN 'out of range'
            ELSE 'ok' END AS outcome,
       count(*) AS n, min(CASE WHEN trim(raw) <> '' AND prefix >= 1000 THEN lpad(CAST(prefix AS VARCHAR), 5, '0') END)
           AS min_zip,
       max(CASE WHEN trim(raw) <> '' AND prefix >= 1000 THEN lpad(CAST(prefix AS VARCHAR), 5, '0') END) AS max_zip
FROM p GROUP BY 1
""")
def prj17_zip_normalise(spark, sf):
    """PRJ-17: postal-code normalisation of raw zip texts (five spellings derived from the customer keys:
    prefix, dashed full code, dropped leading zero, undashed full code, junk, empty): outcome counts and the
    range of valid prefixes."""
    c = market(spark, sf).raw("customer").select("c_custkey")
    k = F.col("c_custkey")
    full = F.lpad((k * 104729 % 100000000).cast("string"), 8, "0")
    raw = (F.when(k % 6 == 0, F.lpad((k * 7919 % 100000).cast("string"), 5, "0"))
           .when(k % 6 == 1, F.concat(F.substring(full, 1, 5), F.lit("-"), F.substring(full, 6, 3)))
           .when(k % 6 == 2, (k * 7919 % 100000).cast("string"))
           .when(k % 6 == 3, (k * 104729 % 100000000).cast("string"))
           .when(k % 6 == 4, F.concat(F.lit("n/a "), (k % 100).cast("string")))
           .otherwise(F.lit("")))
    zipc, err = normalise_zip(raw)
    out = c.select(raw.alias("raw"), zipc.alias("zip"), err.alias("error"))
    outcome = (F.when(F.trim("raw") == "", F.lit("empty"))
               .when(F.col("error").contains("not a zip"), F.lit("not a zip"))
               .when(F.col("error").isNotNull(), F.lit("out of range")).otherwise(F.lit("ok")))
    return out.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.min("zip").alias("min_zip"),
                                                      F.max("zip").alias("max_zip"))


@query("prj19_high_freight_target", """
SELECT (freight_ratio > 0.25)::INT AS high_freight, count(*) AS n FROM f_item_star GROUP BY 1
""")
def prj19_high_freight_target(spark, sf):
    """PRJ-19: binary target freight > 25% of price (null when the ratio is null, three-valued logic kept)."""
    it = item_star(market(spark, sf))
    return it.groupBy((F.col("freight_ratio") > 0.25).cast("int").alias("high_freight")).agg(
        F.count(F.lit(1)).alias("n"))


@query("prj22_small_group_suppression", """
SELECT customer_state, seller_state, count(*) AS n FROM f_item_star
WHERE customer_state IS NOT NULL AND seller_state IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 100
""")
def prj22_small_group_suppression(spark, sf, k: int = 100):
    """PRJ-22: keep only groups with n >= k (a having-style filter after the aggregate)."""
    it = item_star(market(spark, sf)).filter(F.col("customer_state").isNotNull() & F.col("seller_state").isNotNull())
    return it.groupBy("customer_state", "seller_state").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)


__all__ = ["Window", "floor_days", "late_flag", "pct", "ratio", "tariff"]
