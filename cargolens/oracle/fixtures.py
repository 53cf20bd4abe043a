"""DuckDB text of the fixture views (the oracle side of ``sources.fixtures``).

Each view is a CTE; :func:`with_views` prepends the CTEs a query needs, in
dependency order, so every oracle query is a single self-contained statement
over the driver's raw tables.  Decimal literals are cast to DOUBLE so the
arithmetic matches Spark's double arithmetic bit for bit.
"""

from __future__ import annotations

import re

D = "::DOUBLE"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "f_customers": ((), f"""
        SELECT o.o_orderkey AS customer_id,
               o.o_custkey * 16 + o.o_orderkey % 16 AS customer_unique_id,
               c.c_nationkey * 4 + c.c_custkey % 4 AS customer_zip_code_prefix,
               lower(n.n_name) AS customer_city,
               n.n_name AS customer_state
        FROM orders o
        LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    "f_sellers": ((), """
        SELECT s.s_suppkey AS seller_id,
               s.s_nationkey * 4 + s.s_suppkey % 4 AS seller_zip_code_prefix,
               lower(n.n_name) AS seller_city,
               n.n_name AS seller_state
        FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
    "f_geo": ((), f"""
        SELECT c.c_nationkey * 4 + c.c_custkey % 4 AS geolocation_zip_code_prefix,
               CASE WHEN c.c_custkey % 83 = 0 THEN 45.0{D}
                    ELSE -30.0{D} + c.c_nationkey * 1.2{D} + (c.c_custkey % 4) * 0.2{D}
                         + (c.c_custkey * 7 % 11) / 100.0{D} END AS geolocation_lat,
               -70.0{D} + (c.c_nationkey * 7 % 25) * 1.3{D} + (c.c_custkey * 5 % 13) / 100.0{D}
                   AS geolocation_lng,
               lower(c.c_mktsegment) AS geolocation_city,
               n.n_name AS geolocation_state
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    "f_products": ((), f"""
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 60 = 0 THEN NULL ELSE p_name END AS product_category_name,
               length(p_name){D} AS product_name_lenght,
               (length(p_type) * 10 + p_size){D} AS product_description_lenght,
               (p_partkey % 6 + 1){D} AS product_photos_qty,
               CASE WHEN p_partkey % 500 = 7 THEN NULL ELSE p_size * 200.0{D} END AS product_weight_g,
               (p_partkey % 40 + 10){D} AS product_length_cm,
               (p_partkey % 23 + 5){D} AS product_height_cm,
               (p_partkey % 31 + 8){D} AS product_width_cm
        FROM part"""),
    "f_cat_trans": ((), """
        SELECT DISTINCT p_name AS product_category_name,
               upper(replace(p_name, ' ', '_')) AS product_category_name_english
        FROM part WHERE substr(p_name, 1, 1) <= 'm'"""),
    "f_centroids": (("f_geo",), """
        SELECT geolocation_zip_code_prefix AS zip, median(geolocation_lat) AS lat,
               median(geolocation_lng) AS lng, count(*) AS n_points
        FROM f_geo
        WHERE geolocation_lat BETWEEN -34.0 AND 5.5 AND geolocation_lng BETWEEN -74.0 AND -34.0
        GROUP BY 1"""),
    "f_prod": (("f_products", "f_cat_trans"), f"""
        SELECT p.product_id, p.product_category_name,
               coalesce(t.product_category_name_english, p.product_category_name, 'unknown') AS category,
               p.product_length_cm * p.product_height_cm * p.product_width_cm AS volume_cm3,
               p.product_length_cm * p.product_height_cm * p.product_width_cm / 5000.0{D}
                   AS volumetric_weight_kg,
               p.product_weight_g / 1000.0{D} AS weight_kg,
               p.product_photos_qty AS photos_qty, p.product_name_lenght AS name_len,
               p.product_description_lenght AS desc_len,
               CASE WHEN p.product_weight_g IS NULL THEN NULL
                    ELSE greatest(p.product_weight_g / 1000.0{D},
                                  p.product_length_cm * p.product_height_cm * p.product_width_cm / 5000.0{D})
               END AS chargeable_kg
        FROM f_products p LEFT JOIN f_cat_trans t ON p.product_category_name = t.product_category_name"""),
    "f_seller_geo": (("f_sellers", "f_centroids"), """
        SELECT s.seller_id, s.seller_zip_code_prefix, s.seller_state, c.lat AS sell_lat, c.lng AS sell_lng
        FROM f_sellers s LEFT JOIN f_centroids c ON s.seller_zip_code_prefix = c.zip"""),
    "f_customer_geo": (("f_customers", "f_centroids"), """
        SELECT u.customer_id, u.customer_unique_id, u.customer_zip_code_prefix, u.customer_state,
               c.lat AS cust_lat, c.lng AS cust_lng
        FROM f_customers u LEFT JOIN f_centroids c ON u.customer_zip_code_prefix = c.zip"""),
    "f_items_geo": (("f_customer_geo", "f_seller_geo", "f_prod"), f"""
        SELECT b.*, cg.customer_state, cg.cust_lat, cg.cust_lng, sg.seller_state, sg.sell_lat, sg.sell_lng,
               p.category, p.weight_kg, p.volume_cm3, p.volumetric_weight_kg, p.chargeable_kg,
               2 * 6371.0{D} * asin(sqrt(
                   pow(sin((radians(cg.cust_lat) - radians(sg.sell_lat)) / 2), 2)
                   + cos(radians(sg.sell_lat)) * cos(radians(cg.cust_lat))
                     * pow(sin((radians(cg.cust_lng) - radians(sg.sell_lng)) / 2), 2))) AS distance_km
        FROM (SELECT l_orderkey AS order_id,
                     row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                        l_extendedprice, l_shipdate, l_discount, l_tax) AS order_item_id,
                     l_partkey AS product_id, l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
                     floor(l_extendedprice * (l_discount + 0.001{D}) / 20.0{D} * 100.0{D} + 0.5{D}) / 100.0{D}
                         AS price,
                     l_tax
              FROM lineitem) b
        LEFT JOIN f_customer_geo cg ON b.order_id = cg.customer_id
        LEFT JOIN f_seller_geo sg ON b.seller_id = sg.seller_id
        LEFT JOIN f_prod p ON b.product_id = p.product_id"""),
    "f_items": (("f_items_full",), """
        SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value
        FROM f_items_full"""),
    "f_items_full": (("f_items_geo",), f"""
        SELECT *,
               floor((5.0{D} + 0.9{D} * coalesce(chargeable_kg, 1.0{D}) + 0.006{D} * coalesce(distance_km, 1000.0{D})
                      + 100.0{D} * l_tax * (1.0{D} + (seller_id % 5) * 0.3{D})) * 100.0{D} + 0.5{D}) / 100.0{D}
                   AS freight_value
        FROM f_items_geo"""),
    "f_item_star": (("f_items_full", "f_orders"), """
        SELECT g.order_id, g.order_item_id, g.product_id, g.seller_id, g.price, g.freight_value,
               o.customer_id, o.order_status, o.order_purchase_timestamp, g.category, g.weight_kg,
               g.volumetric_weight_kg, g.volume_cm3, g.chargeable_kg, g.sell_lat, g.sell_lng, g.seller_state,
               g.cust_lat, g.cust_lng, g.customer_state, g.distance_km,
               g.freight_value / nullif(g.price, 0) AS freight_ratio
        FROM f_items_full g LEFT JOIN f_orders o ON g.order_id = o.order_id"""),
    "f_order_master": (("f_orders", "f_customers", "f_items", "f_payments", "f_reviews", "f_prod"), """
        SELECT o.*, c.customer_unique_id, c.customer_state,
               ia.n_items, ia.item_total, ia.freight_total, ia.n_sellers,
               pa.payment_total, pa.max_installments, pa.n_payment_rows, pa.primary_payment_type,
               rv.review_score, mc.category,
               coalesce(ia.item_total, 0) + coalesce(ia.freight_total, 0) AS order_total,
               ia.freight_total / nullif(ia.item_total, 0) AS freight_ratio,
               CAST(floor((epoch_us(o.order_delivered_customer_date) - epoch_us(o.order_purchase_timestamp))
                          / 86400000000.0::DOUBLE) AS BIGINT) AS delivery_days,
               CAST(floor((epoch_us(o.order_estimated_delivery_date) - epoch_us(o.order_purchase_timestamp))
                          / 86400000000.0::DOUBLE) AS BIGINT) AS est_days,
               CAST(floor((epoch_us(o.order_delivered_customer_date) - epoch_us(o.order_estimated_delivery_date))
                          / 86400000000.0::DOUBLE) AS BIGINT) AS days_late,
               coalesce(floor((epoch_us(o.order_delivered_customer_date)
                               - epoch_us(o.order_estimated_delivery_date)) / 86400000000.0::DOUBLE) > 0, false)
                   AS is_late,
               strftime(o.order_purchase_timestamp, '%Y-%m') AS purchase_month,
               strftime(o.order_purchase_timestamp, '%A') AS purchase_dow,
               hour(o.order_purchase_timestamp) AS purchase_hour
        FROM f_orders o
        LEFT JOIN f_customers c ON o.customer_id = c.customer_id
        LEFT JOIN (SELECT order_id, count(order_item_id) AS n_items, sum(price) AS item_total,
                          sum(freight_value) AS freight_total, count(DISTINCT seller_id) AS n_sellers
                   FROM f_items GROUP BY 1) ia ON o.order_id = ia.order_id
        LEFT JOIN (SELECT order_id, sum(payment_value) AS payment_total,
                          max(payment_installments) AS max_installments,
                          count(payment_sequential) AS n_payment_rows,
                          arg_max(payment_type, (payment_value, -payment_sequential)) AS primary_payment_type
                   FROM f_payments GROUP BY 1) pa ON o.order_id = pa.order_id
        LEFT JOIN (SELECT order_id, arg_max(review_score, (review_creation_date, review_id)) AS review_score
                   FROM f_reviews GROUP BY 1) rv ON o.order_id = rv.order_id
        LEFT JOIN (SELECT i.order_id, arg_max(p.category, (i.price, -i.order_item_id)) AS category
                   FROM f_items i LEFT JOIN f_prod p ON i.product_id = p.product_id GROUP BY 1) mc
          ON o.order_id = mc.order_id"""),
    "f_item_frame": (("f_items_full", "f_orders", "f_prod", "f_items"), """
        SELECT g.order_id, g.order_item_id, g.product_id, g.seller_id, g.price, g.freight_value,
               o.order_purchase_timestamp, o.order_estimated_delivery_date, o.order_delivered_customer_date,
               g.category, g.weight_kg, g.volume_cm3, g.chargeable_kg, p.photos_qty, p.name_len, p.desc_len,
               g.seller_state, g.customer_state, g.distance_km, b.n_items, b.n_sellers,
               (g.seller_state = g.customer_state)::INTEGER AS same_state,
               month(o.order_purchase_timestamp) AS purchase_month,
               isodow(o.order_purchase_timestamp) - 1 AS purchase_dow,
               hour(o.order_purchase_timestamp) AS purchase_hour
        FROM f_items_full g
        JOIN f_orders o ON g.order_id = o.order_id
        LEFT JOIN f_prod p ON g.product_id = p.product_id
        JOIN (SELECT order_id, count(order_item_id) AS n_items, count(DISTINCT seller_id) AS n_sellers
              FROM f_items GROUP BY 1) b ON g.order_id = b.order_id
        WHERE g.customer_state IS NOT NULL AND g.seller_state IS NOT NULL AND g.price > 0"""),
    "f_item_features": (("f_item_frame",), """
        SELECT order_id, order_item_id, product_id, seller_id, order_purchase_timestamp,
               epoch_us(order_purchase_timestamp) / 1e6 AS purchase_ts, freight_value,
               freight_value / nullif(price, 0) AS freight_ratio, ln(1 + freight_value) AS reg_target, category,
               chargeable_kg, customer_state, desc_len, distance_km, n_items, n_sellers, name_len, photos_qty, price,
               purchase_dow, purchase_hour, purchase_month, same_state, seller_state, volume_cm3, weight_kg
        FROM f_item_frame"""),
    "f_order_features": (("f_item_frame", "f_customers"), """
        SELECT a.order_id, a.seller_id, a.seller_state, a.category, a.customer_state, a.same_state,
               a.order_purchase_timestamp, a.purchase_month, a.purchase_dow, a.purchase_hour,
               a.price_total, a.freight_total, a.weight_kg, a.volume_cm3, a.chargeable_kg, a.distance_km,
               a.n_items, a.n_sellers, c.customer_unique_id,
               a.freight_total / nullif(a.price_total, 0) AS freight_ratio,
               (epoch_us(a.est) - epoch_us(a.order_purchase_timestamp)) / 86400000000.0 AS promised_days,
               (floor((epoch_us(a.del) - epoch_us(a.est)) / 86400000000.0) > 0)::INTEGER AS clf_target,
               CAST(floor((epoch_us(a.del) - epoch_us(a.est)) / 86400000000.0) AS BIGINT) AS days_late,
               epoch_us(a.order_purchase_timestamp) / 1e6 AS purchase_ts
        FROM (SELECT order_id,
                     arg_max(seller_id, (price, -order_item_id)) AS seller_id,
                     arg_max(seller_state, (price, -order_item_id)) AS seller_state,
                     arg_max(category, (price, -order_item_id)) AS category,
                     arg_max(customer_state, (price, -order_item_id)) AS customer_state,
                     arg_max(same_state, (price, -order_item_id)) AS same_state,
                     arg_max(order_purchase_timestamp, (price, -order_item_id)) AS order_purchase_timestamp,
                     arg_max(purchase_month, (price, -order_item_id)) AS purchase_month,
                     arg_max(purchase_dow, (price, -order_item_id)) AS purchase_dow,
                     arg_max(purchase_hour, (price, -order_item_id)) AS purchase_hour,
                     arg_max(order_estimated_delivery_date, (price, -order_item_id)) AS est,
                     arg_max(order_delivered_customer_date, (price, -order_item_id)) AS del,
                     sum(price) AS price_total, sum(freight_value) AS freight_total,
                     coalesce(sum(weight_kg), 0) AS weight_kg, coalesce(sum(volume_cm3), 0) AS volume_cm3,
                     coalesce(sum(chargeable_kg), 0) AS chargeable_kg, max(distance_km) AS distance_km,
                     max(n_items) AS n_items, max(n_sellers) AS n_sellers
              FROM f_item_frame
              WHERE order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL
              GROUP BY 1) a
        LEFT JOIN f_customers c ON a.order_id = c.customer_id"""),
    "f_order_loads": (("f_order_features", "f_orders", "f_items"), """
        SELECT q.order_id,
               (SELECT count(*) FROM f_orders a WHERE a.order_purchase_timestamp >= q.t - INTERVAL 7 DAY
                                                  AND a.order_purchase_timestamp < q.t) AS platform_load_7d,
               (SELECT count(*) FROM f_orders a WHERE a.order_purchase_timestamp >= q.t - INTERVAL 35 DAY
                                                  AND a.order_purchase_timestamp < q.t - INTERVAL 7 DAY) AS load_28d,
               (SELECT count(*) FROM (SELECT DISTINCT i.seller_id, i.order_id, o.order_purchase_timestamp AS t
                                      FROM f_items i JOIN f_orders o ON i.order_id = o.order_id) s
                 WHERE s.seller_id = q.seller_id AND s.t >= q.t - INTERVAL 7 DAY AND s.t < q.t) AS seller_load_7d
        FROM (SELECT order_id, seller_id, order_purchase_timestamp AS t FROM f_order_features) q"""),
    "f_scored": (("f_order_features",), """
        SELECT *, clf_target AS y,
               round_even(least(greatest(0.05::DOUBLE + coalesce(distance_km, 1000.0::DOUBLE) / 10000.0::DOUBLE
                                         + (30.0::DOUBLE - promised_days) / 100.0::DOUBLE
                                         - 0.02::DOUBLE * same_state, 0.0), 1.0), 3) AS s
        FROM f_order_features"""),
    "f_cut": (("f_scored",), """
        SELECT quantile_cont(purchase_ts, 0.8) AS c FROM f_scored"""),
    "f_test": (("f_scored", "f_cut"), """
        SELECT f_scored.* FROM f_scored, f_cut WHERE purchase_ts > f_cut.c"""),
    "f_train": (("f_scored", "f_cut"), """
        SELECT f_scored.* FROM f_scored, f_cut WHERE purchase_ts <= f_cut.c - 30 * 86400.0"""),
    "f_icut": (("f_item_features",), """
        SELECT quantile_cont(purchase_ts, 0.8) AS c FROM f_item_features"""),
    "f_itest": (("f_item_features", "f_icut"), """
        SELECT f.* FROM f_item_features f, f_icut WHERE f.purchase_ts > f_icut.c"""),
    "f_itrain": (("f_item_features", "f_icut"), """
        SELECT f.* FROM f_item_features f, f_icut WHERE f.purchase_ts <= f_icut.c"""),
    "f_aud0": (("f_itest", "f_itrain"), """
        SELECT t.*, x.est_a, x.est_b,
               round_even(ln(1 + t.freight_value) - ln(1 + x.est_a), 9) AS resid_a,
               round_even(ln(1 + t.freight_value) - ln(1 + x.est_b), 9) AS resid_b,
               CASE WHEN t.price >= 0 AND t.price < 50 THEN '<50' WHEN t.price >= 50 AND t.price < 100 THEN '50-100'
                    WHEN t.price >= 100 AND t.price < 200 THEN '100-200' WHEN t.price >= 200 AND t.price < 500
                    THEN '200-500' WHEN t.price >= 500 THEN '500+' END AS band
        FROM f_itest t
        JOIN (SELECT t2.order_id, t2.order_item_id,
                     CASE WHEN t2.distance_km IS NULL THEN NULL ELSE greatest(9.614 + 1.846 * t2.chargeable_kg
                          + 0.811 * t2.distance_km / 100 + -3.985 * t2.same_state, 0.0) END AS est_a,
                     coalesce(cm.m, am.m) AS est_b
              FROM f_itest t2
              LEFT JOIN (SELECT category, median(freight_value) AS m FROM f_itrain
                         WHERE category IS NOT NULL GROUP BY 1) cm ON t2.category = cm.category,
              (SELECT median(freight_value) AS m FROM f_itrain) am) x
          ON t.order_id = x.order_id AND t.order_item_id = x.order_item_id
        WHERE x.est_a IS NOT NULL"""),
    "f_audit": (("f_aud0",), """
        SELECT a.*, co.cut_a, co.cut_b, cb.bcut_a, cb.bcut_b,
               (a.resid_a >= co.cut_a)::INT AS p_a, (a.resid_b >= co.cut_b)::INT AS p_b,
               (a.resid_a >= co.cut_a - 1e-9)::INT AS fo_a, (a.resid_b >= co.cut_b - 1e-9)::INT AS fo_b,
               (a.resid_a >= cb.bcut_a - 1e-9)::INT AS fb_a, (a.resid_b >= cb.bcut_b - 1e-9)::INT AS fb_b,
               a.freight_value - a.est_a AS excess,
               CASE WHEN a.est_a > 0 THEN a.freight_value / a.est_a END AS markup
        FROM f_aud0 a,
             (SELECT quantile_cont(resid_a, 0.95) AS cut_a, quantile_cont(resid_b, 0.95) AS cut_b FROM f_aud0) co,
             (SELECT band, quantile_cont(resid_a, 0.95) AS bcut_a, quantile_cont(resid_b, 0.95) AS bcut_b
              FROM f_aud0 GROUP BY 1) cb
        WHERE a.band = cb.band"""),
    "f_delivered": (("f_order_master",), """
        SELECT * FROM f_order_master WHERE order_status = 'delivered'"""),
    "f_d": (("f_delivered",), """
        SELECT * FROM f_delivered WHERE delivery_days IS NOT NULL"""),
    "f_orders": (("f_items_geo",), f"""
        SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
               order_approved_at + INTERVAL 2 DAY AS order_delivered_carrier_date,
               order_delivered_customer_date, order_estimated_delivery_date
        FROM (
          SELECT o.o_orderkey AS order_id, o.o_orderkey AS customer_id,
                 CASE WHEN o.o_orderkey % 33 <> 5 THEN 'delivered'
                      WHEN o.o_orderstatus = 'F' THEN 'canceled'
                      WHEN o.o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
                 make_timestamp(epoch_us(o.o_orderdate) + (o.o_orderkey * 7919 % 86400) * 1000000)
                     AS order_purchase_timestamp,
                 make_timestamp(epoch_us(o.o_orderdate) + (o.o_orderkey * 7919 % 86400) * 1000000
                                + (o.o_orderkey * 31 % 86400) * 1000000) AS order_approved_at,
                 CASE WHEN o.o_orderkey % 33 <> 5 AND o.o_orderkey % 131 <> 0 THEN
                   make_timestamp(epoch_us(o.o_orderdate) + (o.o_orderkey * 7919 % 86400) * 1000000
                     + (floor((2.0{D} + coalesce(m.max_km, 1000.0{D}) / 250.0{D}) * 86400.0{D})::BIGINT
                        + o.o_orderkey * 104729 % 1209600) * 1000000)
                 END AS order_delivered_customer_date,
                 make_timestamp(epoch_us(date_trunc('day', o.o_orderdate
                                   + to_seconds(o.o_orderkey * 7919 % 86400)))
                                + (o.o_orderkey * 13 % 21 + 14) * 86400000000) AS order_estimated_delivery_date
          FROM orders o
          LEFT JOIN (SELECT order_id, max(distance_km) AS max_km FROM f_items_geo GROUP BY 1) m
            ON o.o_orderkey = m.order_id) x"""),
    "f_payments": ((), f"""
        SELECT o_orderkey AS order_id, s.payment_sequential,
               CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2', '3') THEN 'credit_card'
                    WHEN substr(o_orderpriority, 1, 1) = '4' THEN 'boleto' ELSE 'voucher' END AS payment_type,
               CAST(CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2', '3') THEN o_orderkey % 12 + 1 ELSE 1 END
                    AS INTEGER) AS payment_installments,
               floor(o_totalprice / 1000.0{D} / (CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END) * 100.0{D}
                     + 0.5{D}) / 100.0{D} AS payment_value
        FROM orders,
             LATERAL (SELECT unnest(range(1, (CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END) + 1))
                      AS payment_sequential) s"""),
    "f_reviews": (("f_orders",), """
        SELECT order_id * 10 + kth AS review_id, order_id,
               CAST(greatest(1, 5 - floor(greatest(coalesce(
                   floor((epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date))
                         / 86400000000.0), 0), 0) / 2) - order_id % 3) AS INTEGER) AS review_score,
               CASE WHEN order_id % 9 = 0 THEN 'title' END AS review_comment_title,
               CASE WHEN order_id % 5 >= 3 THEN 'message' END AS review_comment_message,
               coalesce(order_delivered_customer_date, order_estimated_delivery_date) + to_days(kth::INTEGER)
                   AS review_creation_date,
               coalesce(order_delivered_customer_date, order_estimated_delivery_date) + to_days(kth::INTEGER)
                   + to_days((order_id % 4 + 1)::INTEGER) AS review_answer_timestamp
        FROM f_orders,
             LATERAL (SELECT unnest(range(1, (CASE WHEN order_id % 25 = 0 THEN 2 ELSE 1 END) + 1)) AS kth) r
        WHERE order_id % 10 <> 0"""),
}


def _deps(names, seen, out):
    for n in names:
        if n in seen:
            continue
        seen.add(n)
        _deps(VIEWS[n][0], seen, out)
        out.append(n)


def with_views(sql: str, *names: str) -> str:
    """Prepend the fixture CTEs ``names`` (and what they depend on) to ``sql``.

    When ``names`` is empty the views referenced in ``sql`` are found by name."""
    if not names:
        names = tuple(n for n in VIEWS if re.search(rf"\b{n}\b", sql))
    order: list[str] = []
    _deps(names, set(), order)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]}\n)" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
