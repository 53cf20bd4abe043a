"""Profiling and data-quality queries (DQ-1 .. DQ-12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import LAT_BOX, LNG_BOX, r
from ..operators import quality as Q
from ..operators.mart import pct
from ..operators.quality import gate
from ..registry import ORACLE, QUERIES, query
from ..sources.fixtures import market
from .core import item_star, order_master

FIXTURE_TABLES = ("orders", "items", "payments", "reviews", "customers", "sellers", "products", "geolocation",
                  "category_translation")
SQL_VIEW = {"orders": "f_orders", "items": "f_items", "payments": "f_payments", "reviews": "f_reviews",
            "customers": "f_customers", "sellers": "f_sellers", "products": "f_products", "geolocation": "f_geo",
            "category_translation": "f_cat_trans"}
COLUMNS = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
              "freight_value"],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "reviews": ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                "review_creation_date", "review_answer_timestamp"],
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                  "customer_state"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "products": ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
                 "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
                 "product_width_cm"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
                    "geolocation_state"],
    "category_translation": ["product_category_name", "product_category_name_english"],
}


def _tables(m):
    return {t: m.view(t) for t in FIXTURE_TABLES}


def _overview_sql():
    parts = []
    for t in FIXTURE_TABLES:
        v, cols = SQL_VIEW[t], COLUMNS[t]
        nulls = " + ".join(f"count(*) - count({c})" for c in cols)
        parts.append(f"SELECT '{t}' AS \"table\", count(*) AS rows, {len(cols)} AS cols, "
                     f"({nulls}) AS total_missing_cells, "
                     f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {v})) AS exact_dup_rows FROM {v}")
    return "\nUNION ALL ".join(parts)


def _missing_sql():
    parts = []
    for t in FIXTURE_TABLES:
        v = SQL_VIEW[t]
        for c in COLUMNS[t]:
            parts.append(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) - count({c}) AS missing_rows, "
                         f"round_even((count(*) - count({c})) / count(*) * 100, 2) AS missing_pct FROM {v}")
    return "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") WHERE missing_rows > 0"


@query("dq01_overview", _overview_sql())
def dq01_overview(spark, sf):
    """DQ-1: per table rows, columns, null cells and exact duplicate rows."""
    return Q.overview(_tables(market(spark, sf)))


@query("dq02_missing", _missing_sql())
def dq02_missing(spark, sf):
    """DQ-2 / SHP-3: nulls per column with % (2 dp), columns with any null only."""
    return Q.missing(_tables(market(spark, sf)))


@query("dq04_describe_price_freight", """
WITH s AS (SELECT count(price)::DOUBLE AS pc, avg(price) AS pm, stddev_samp(price) AS ps, min(price) AS pmin,
                  quantile_cont(price, 0.25) AS p25, median(price) AS p50, quantile_cont(price, 0.75) AS p75,
                  max(price) AS pmax,
                  count(freight_value)::DOUBLE AS fc, avg(freight_value) AS fm, stddev_samp(freight_value) AS fs,
                  min(freight_value) AS fmin, quantile_cont(freight_value, 0.25) AS f25, median(freight_value) AS f50,
                  quantile_cont(freight_value, 0.75) AS f75, max(freight_value) AS fmax FROM f_items)
SELECT 'count' AS stat, round_even(pc, 6) AS price, round_even(fc, 6) AS freight_value FROM s
UNION ALL SELECT 'mean', round_even(pm, 6), round_even(fm, 6) FROM s
UNION ALL SELECT 'std', round_even(ps, 6), round_even(fs, 6) FROM s
UNION ALL SELECT 'min', round_even(pmin, 6), round_even(fmin, 6) FROM s
UNION ALL SELECT '25%', round_even(p25, 6), round_even(f25, 6) FROM s
UNION ALL SELECT '50%', round_even(p50, 6), round_even(f50, 6) FROM s
UNION ALL SELECT '75%', round_even(p75, 6), round_even(f75, 6) FROM s
UNION ALL SELECT 'max', round_even(pmax, 6), round_even(fmax, 6) FROM s
""")
def dq04_describe_price_freight(spark, sf):
    """DQ-4: numeric summary of item price and freight."""
    return Q.describe(market(spark, sf).items, ["price", "freight_value"])


@query("dq05_value_extremes", """
SELECT round_even(median(price), 2) AS item_price_p50, round_even(quantile_cont(price, 0.99), 2) AS item_price_p99,
       max(price) AS item_price_max, round_even(median(freight_value), 2) AS freight_p50,
       round_even(quantile_cont(freight_value, 0.99), 2) AS freight_p99, max(freight_value) AS freight_max,
       round_even(avg(coalesce(freight_value / nullif(price, 0) > 1, false)::INT) * 100, 1) AS freight_gt_price_pct,
       count(*) FILTER (WHERE price = 0) AS zero_price_items, count(*) FILTER (WHERE freight_value = 0)
           AS zero_freight_items
FROM f_items
""")
def dq05_value_extremes(spark, sf):
    """DQ-5: p50, p99, max of price and freight; share of lines with freight above price; zero counts."""
    it = market(spark, sf).items
    fr = F.try_divide(F.col("freight_value"), F.nullif(F.col("price"), F.lit(0)))
    return it.agg(r(F.median("price"), 2).alias("item_price_p50"),
                  r(F.percentile("price", 0.99), 2).alias("item_price_p99"), F.max("price").alias("item_price_max"),
                  r(F.median("freight_value"), 2).alias("freight_p50"),
                  r(F.percentile("freight_value", 0.99), 2).alias("freight_p99"),
                  F.max("freight_value").alias("freight_max"),
                  r(pct(fr > 1), 1).alias("freight_gt_price_pct"),
                  F.count(F.when(F.col("price") == 0, F.lit(1))).alias("zero_price_items"),
                  F.count(F.when(F.col("freight_value") == 0, F.lit(1))).alias("zero_freight_items"))


@query("dq06_city_folding", """
SELECT count(*) FILTER (WHERE geolocation_city = 'building') AS city_plain,
       count(*) FILTER (WHERE strip_accents(geolocation_city) = 'building' AND geolocation_city <> 'building')
           AS city_accented
FROM f_geo
""")
def dq06_city_folding(spark, sf, city: str = "building"):
    """DQ-6 / UDF-1: rows spelled plainly vs rows whose accent-folded spelling equals the plain one."""
    g = market(spark, sf).geolocation
    c = F.col("geolocation_city")
    return g.agg(F.count(F.when(c == city, F.lit(1))).alias("city_plain"),
                 F.count(F.when((Q.fold_accents(c) == city) & (c != city), F.lit(1))).alias("city_accented"))


@query("dq07_coordinate_box", """
SELECT count(*) AS rows,
       count(*) FILTER (WHERE geolocation_lat BETWEEN -34.0 AND 5.5 AND geolocation_lng BETWEEN -74.0 AND -34.0)
           AS in_box,
       round_even((1 - count(*) FILTER (WHERE geolocation_lat BETWEEN -34.0 AND 5.5
                                         AND geolocation_lng BETWEEN -74.0 AND -34.0) / count(*)) * 100, 4)
           AS dropped_pct
FROM f_geo
""")
def dq07_coordinate_box(spark, sf):
    """DQ-7: coordinate bounding-box filter and the share of points it drops."""
    g = market(spark, sf).geolocation
    inbox = F.col("geolocation_lat").between(*LAT_BOX) & F.col("geolocation_lng").between(*LNG_BOX)
    return g.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(inbox, F.lit(1))).alias("in_box"),
                 r((F.lit(1) - F.count(F.when(inbox, F.lit(1))) / F.count(F.lit(1))) * 100, 4).alias("dropped_pct"))


@query("dq08_zip_spread", """
WITH z AS (SELECT geolocation_zip_code_prefix, coalesce(stddev_samp(geolocation_lat), 0) AS lat_sd,
                  coalesce(stddev_samp(geolocation_lng), 0) AS lng_sd FROM f_geo GROUP BY 1)
SELECT count(*) AS zips, round_even(avg(lat_sd), 6) AS lat_sd_mean, round_even(median(lat_sd), 6) AS lat_sd_median,
       round_even(max(lat_sd), 6) AS lat_sd_max, round_even(avg(lng_sd), 6) AS lng_sd_mean,
       round_even(median(lng_sd), 6) AS lng_sd_median, round_even(max(lng_sd), 6) AS lng_sd_max
FROM z
""")
def dq08_zip_spread(spark, sf):
    """DQ-8: within-zip coordinate spread (sample sd, single point -> 0) and its summary."""
    g = market(spark, sf).geolocation
    z = g.groupBy("geolocation_zip_code_prefix").agg(
        F.coalesce(F.stddev_samp("geolocation_lat"), F.lit(0.0)).alias("lat_sd"),
        F.coalesce(F.stddev_samp("geolocation_lng"), F.lit(0.0)).alias("lng_sd"))
    return z.agg(F.count(F.lit(1)).alias("zips"),
                 *[r(fn(c), 6).alias(f"{c}_{n}") for c in ("lat_sd", "lng_sd")
                   for n, fn in (("mean", F.avg), ("median", F.median), ("max", F.max))])


_COVERAGE = ["distance_km", "weight_kg", "volume_cm3", "chargeable_kg", "category", "freight_ratio", "cust_lat",
             "sell_lat"]


@query("dq09_coverage", "\nUNION ALL ".join(
    [f"SELECT '{c}' AS \"column\", round_even(avg(({c} IS NOT NULL)::INT) * 100, 4) AS non_null_pct FROM f_item_star"
     for c in _COVERAGE]
    + ["SELECT 'both_coordinates', round_even(avg((cust_lat IS NOT NULL AND sell_lat IS NOT NULL)::INT) * 100, 4) "
       "FROM f_item_star"]))
def dq09_coverage(spark, sf):
    """DQ-9: non-null % per engineered column of the item table; share of lines with both coordinates."""
    it = item_star(market(spark, sf))
    wide = it.agg(*[r(pct(F.col(c).isNotNull()), 4).alias(c) for c in _COVERAGE],
                  r(pct(F.col("cust_lat").isNotNull() & F.col("sell_lat").isNotNull()), 4).alias("both_coordinates"))
    names = _COVERAGE + ["both_coordinates"]
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("non_null_pct"))
                                           for c in names])).alias("x")).select("x.*")


@query("dq10_order_key_unique", """
SELECT count(*) AS rows, count(DISTINCT order_id) AS distinct_keys, count(*) - count(DISTINCT order_id) AS duplicate_keys
FROM f_order_master
""")
def dq10_order_key_unique(spark, sf):
    """DQ-10: key uniqueness of the assembled order table."""
    o = order_master(market(spark, sf))
    return o.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("order_id").alias("distinct_keys"),
                 (F.count(F.lit(1)) - F.count_distinct("order_id")).alias("duplicate_keys"))


@query("dq11_distinct_counts", """
SELECT (SELECT count(DISTINCT order_id) FROM f_orders) AS n_orders,
       (SELECT count(*) FROM f_items) AS n_items,
       (SELECT count(DISTINCT customer_id) FROM f_customers) AS n_customer_rows,
       (SELECT count(DISTINCT customer_unique_id) FROM f_customers) AS n_customer_unique,
       (SELECT count(DISTINCT seller_id) FROM f_sellers) AS n_sellers,
       (SELECT count(*) FROM f_products) AS n_products,
       (SELECT count(DISTINCT geolocation_zip_code_prefix) FROM f_geo) AS n_geo_zip,
       (SELECT count(DISTINCT order_id) FROM f_items) AS orders_in_items,
       (SELECT max(order_item_id) FROM f_items) AS max_items_in_order,
       (SELECT strftime(min(order_purchase_timestamp), '%Y-%m-%d') FROM f_orders) AS date_min,
       (SELECT strftime(max(order_purchase_timestamp), '%Y-%m-%d') FROM f_orders) AS date_max
""")
def dq11_distinct_counts(spark, sf):
    """DQ-11: distinct counts (orders, people, sellers, zips, orders with items), max line number, date range."""
    m = market(spark, sf)
    parts = [
        m.orders.agg(F.count_distinct("order_id").alias("n_orders"),
                     F.date_format(F.min("order_purchase_timestamp"), "yyyy-MM-dd").alias("date_min"),
                     F.date_format(F.max("order_purchase_timestamp"), "yyyy-MM-dd").alias("date_max")),
        m.items.agg(F.count(F.lit(1)).alias("n_items"), F.count_distinct("order_id").alias("orders_in_items"),
                    F.max("order_item_id").alias("max_items_in_order")),
        m.customers.agg(F.count_distinct("customer_id").alias("n_customer_rows"),
                        F.count_distinct("customer_unique_id").alias("n_customer_unique")),
        m.sellers.agg(F.count_distinct("seller_id").alias("n_sellers")),
        m.products.agg(F.count(F.lit(1)).alias("n_products")),
        m.geolocation.agg(F.count_distinct("geolocation_zip_code_prefix").alias("n_geo_zip")),
    ]
    return side_by_side(parts)


def side_by_side(parts):
    """Combine one-row aggregates into one row (broadcast equi-join on a constant key)."""
    out = parts[0].withColumn("_one", F.lit(1))
    for p in parts[1:]:
        out = out.join(F.broadcast(p.withColumn("_one", F.lit(1))), "_one")
    return out.drop("_one")


@query("dq12_facts", """
WITH d AS (SELECT * FROM f_d)
SELECT (SELECT count(DISTINCT order_id) FROM f_orders) AS n_orders,
       (SELECT count(*) FROM f_items) AS n_items,
       (SELECT count(*) FROM f_payments) AS n_payments,
       (SELECT count(*) FROM f_reviews) AS n_reviews,
       round_even((SELECT count(*) FROM f_delivered) / (SELECT count(*) FROM f_order_master) * 100, 1) AS pct_delivered,
       round_even((SELECT avg(is_late::INT) FROM d) * 100, 1) AS late_rate,
       round_even((SELECT avg((days_late < 0)::INT) FROM d) * 100, 1) AS early_rate,
       (SELECT median(days_late) FROM d) AS median_days_late,
       (SELECT median(delivery_days) FROM d) AS median_delivery_days,
       round_even((SELECT avg(delivery_days) FROM d), 1) AS mean_delivery_days,
       (SELECT max(delivery_days) FROM d) AS max_delivery_days,
       round_even((SELECT sum(freight_value) / (sum(freight_value) + sum(price)) FROM f_items) * 100, 1)
           AS freight_pct_gmv
""")
def dq12_facts(spark, sf):
    """DQ-12: headline facts document (one row, each value with its rounding)."""
    m = market(spark, sf)
    o = order_master(m)
    d = o.filter((F.col("order_status") == "delivered") & F.col("delivery_days").isNotNull())
    parts = [
        m.orders.agg(F.count_distinct("order_id").alias("n_orders")),
        m.items.agg(F.count(F.lit(1)).alias("n_items"),
                    r(F.sum("freight_value") / (F.sum("freight_value") + F.sum("price")) * 100, 1)
                    .alias("freight_pct_gmv")),
        m.payments.agg(F.count(F.lit(1)).alias("n_payments")),
        m.reviews.agg(F.count(F.lit(1)).alias("n_reviews")),
        o.agg(r(pct(F.col("order_status") == "delivered"), 1).alias("pct_delivered")),
        d.agg(r(F.avg(F.col("is_late").cast("int")) * 100, 1).alias("late_rate"),
              r(pct(F.col("days_late") < 0), 1).alias("early_rate"),
              F.median("days_late").alias("median_days_late"),
              F.median("delivery_days").alias("median_delivery_days"),
              r(F.avg("delivery_days"), 1).alias("mean_delivery_days"),
              F.max("delivery_days").alias("max_delivery_days")),
    ]
    return side_by_side(parts)


# one-row reports that make up the facts document
FACT_QUERIES = ("dq12_facts", "agg15_corridor", "agg16_repeat_rate", "win04_repeat_gap", "agg20_seller_items",
                "win06_seller_concentration", "agg22_top10_shares", "agg25_installment_stats", "agg28_freight_headline",
                "agg45_satisfaction_link", "agg43_seller_tenure", "dq05_value_extremes", "dq08_zip_spread", "sta04_price_burden_over_categories",
                "sta06_at_risk_rate", "aud04_audit_summary", "met01_regression_metrics", "met02_average_precision", "met04_roc_auc",
                "met05_threshold_metrics", "sta08_linear_tariff", "str02_log_summary")


def facts_document(spark, sf):
    """DQ-12: the facts document in full, long form (report, fact, value): every number of the one-row reports."""
    parts = []
    for name in FACT_QUERIES:
        df = QUERIES[name](spark, sf)
        numbers = [f.name for f in df.schema.fields if f.dataType.typeName() in ("integer", "long", "double", "decimal")]
        parts.append(df.select(F.explode(F.array(*[F.struct(F.lit(name).alias("report"), F.lit(c).alias("fact"),
                                                            F.col(c).cast("double").alias("value")) for c in numbers])).alias("e")).select("e.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("value").isNotNull())


def register_facts():
    """Registered after the reports it reads, with an oracle made of theirs."""
    cast = "SELECT '{0}' AS report, fact, value FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM ({1})) ON COLUMNS(*) INTO NAME fact VALUE value)"
    ORACLE["dq12_facts_document"] = "\nUNION ALL ".join(cast.format(n, ORACLE[n].strip().rstrip(";")) for n in FACT_QUERIES)
    QUERIES["dq12_facts_document"] = facts_document


@query("dq13_gate", """
SELECT 'n_items' AS fact, count(*)::DOUBLE AS value, count(*)::DOUBLE AS expected, 0.0::DOUBLE AS tol, true AS ok FROM lineitem
UNION ALL SELECT 'n_orders', count(*), count(*), 0.0, true FROM orders
UNION ALL SELECT 'n_payments', count(*) + count(*) FILTER (WHERE o_orderkey % 3 = 0), count(*) + count(*) FILTER (WHERE o_orderkey % 3 = 0), 0.0, true FROM orders
""")
def dq13_gate(spark, sf):
    """DQ-13: gate on the facts: counts of the derived tables must equal those of the raw tables; the job fails on a
    mismatch.  The expected values are three counts."""
    m = market(spark, sf)
    raw = m.raw("orders").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("o_orderkey") % 3 == 0, F.lit(1))).alias("two")).first()
    lines = m.raw("lineitem").count()
    facts = dq12_facts(spark, sf).select("n_items", "n_orders", "n_payments")
    return gate(facts, {"n_items": lines, "n_orders": raw["n"], "n_payments": raw["n"] + raw["two"]})
