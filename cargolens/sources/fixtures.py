"""Fixture views: the marketplace tables derived from the driver's tables.

The driver ships TPC-H-like tables without freight, delivery, review or
coordinate columns; these views derive the nine marketplace tables from them
with integer ``%``, ``floor`` and fixed rounding so that Spark and the DuckDB
oracle (``cargolens.oracle.fixtures``) produce identical rows.  Both dialects
implement the same definitions independently.

Scale notes
-----------
* ``nation`` (25 rows) is the only side broadcast by hint; it is fixed-size.
* Zip centroids are keyed by a 5-digit zip prefix, so they hold at most
  100,000 rows whatever the data size; they are broadcast as well.
* ``lineitem`` is the big side.  It moves narrow to its product and then to its
  order; the line counter, the customer lookup, the per-order distance maximum
  and the written buckets share that partitioning.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import (LAT_BOX, LNG_BOX, add_seconds, fixed_round, floor_days, haversine_km,
                                 micros, nan_max)
from ..operators.ranking import agg_with_quantiles
from ..session import buckets, stored, stored_by
from .tables import read_table


PERSIST_CONF = "spark.cargolens.persistCore"


class Market:
    """Lazy handle on the fixture tables of one data folder.

    Each property is a DataFrame.  With ``persist`` on (the default, see
    :data:`PERSIST_CONF`) the wide core tables (lines with geography and
    freight, orders, and the item / order tables built on them) are written
    once as Parquet to the cluster's shared folder when they are first used;
    every query built from this handle then scans the columns it needs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, persist: bool | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        if persist is None:
            persist = spark.conf.get(PERSIST_CONF, "true").lower() == "true"
        self.persist = persist

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def n_buckets(self) -> int:
        return buckets(self.raw("lineitem"))

    def _keep(self, df: DataFrame, by: str | None = None) -> DataFrame:
        if not self.persist:
            return df
        return stored(df, "core") if by is None else stored_by(df, "core", by, self.n_buckets)

    # ------------------------------------------------------------------ small dimension views
    @cached_property
    def nation(self) -> DataFrame:
        return F.broadcast(self.raw("nation").select("n_nationkey", "n_name", "n_regionkey"))

    @cached_property
    def customers(self) -> DataFrame:
        """f_customers: one customer row per order (customer_id = order key), in buckets of it."""
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        n = self.nation
        # only keys move; the names are looked up when the table is read
        kept = self._keep(o.join(c, o.o_custkey == c.c_custkey, "left").select(
            F.col("o_orderkey").alias("customer_id"),
            (F.col("o_custkey") * 16 + F.col("o_orderkey") % 16).alias("customer_unique_id"),
            (F.col("c_nationkey") * 4 + F.col("c_custkey") % 4).alias("customer_zip_code_prefix"), "c_nationkey"), "customer_id")
        return (kept.join(n, F.col("c_nationkey") == n.n_nationkey, "left")
                .select("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                        F.lower(F.col("n_name")).alias("customer_city"), F.col("n_name").alias("customer_state")))

    @cached_property
    def sellers(self) -> DataFrame:
        s = self.raw("supplier").select("s_suppkey", "s_nationkey")
        n = self.nation
        return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
                .select(F.col("s_suppkey").alias("seller_id"),
                        (F.col("s_nationkey") * 4 + F.col("s_suppkey") % 4).alias("seller_zip_code_prefix"),
                        F.lower(F.col("n_name")).alias("seller_city"),
                        F.col("n_name").alias("seller_state")))

    @cached_property
    def geolocation(self) -> DataFrame:
        """f_geo: one point per customer; every 83rd point lies outside the box."""
        c = self.raw("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        n = self.nation
        lat = (F.lit(-30.0) + F.col("c_nationkey") * F.lit(1.2) + (F.col("c_custkey") % 4) * F.lit(0.2)
               + (F.col("c_custkey") * 7 % 11) / F.lit(100.0))
        lng = (F.lit(-70.0) + (F.col("c_nationkey") * 7 % 25) * F.lit(1.3)
               + (F.col("c_custkey") * 5 % 13) / F.lit(100.0))
        return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
                .select((F.col("c_nationkey") * 4 + F.col("c_custkey") % 4).alias("geolocation_zip_code_prefix"),
                        F.when(F.col("c_custkey") % 83 == 0, F.lit(45.0)).otherwise(lat).alias("geolocation_lat"),
                        lng.alias("geolocation_lng"),
                        F.lower(F.col("c_mktsegment")).alias("geolocation_city"),
                        F.col("n_name").alias("geolocation_state")))

    @cached_property
    def products(self) -> DataFrame:
        p = self.raw("part").select("p_partkey", "p_name", "p_type", "p_size")
        k = F.col("p_partkey")
        return p.select(
            k.alias("product_id"),
            F.when(k % 60 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("product_category_name"),
            F.length("p_name").cast("double").alias("product_name_lenght"),
            (F.length("p_type") * 10 + F.col("p_size")).cast("double").alias("product_description_lenght"),
            (k % 6 + 1).cast("double").alias("product_photos_qty"),
            F.when(k % 500 == 7, F.lit(None)).otherwise(F.col("p_size") * F.lit(200.0)).alias("product_weight_g"),
            (k % 40 + 10).cast("double").alias("product_length_cm"),
            (k % 23 + 5).cast("double").alias("product_height_cm"),
            (k % 31 + 8).cast("double").alias("product_width_cm"))

    @cached_property
    def category_translation(self) -> DataFrame:
        """Translation of category names; names starting with a-m are translated."""
        names = self.raw("part").select(F.col("p_name").alias("product_category_name")).distinct()
        return (names.filter(F.substring("product_category_name", 1, 1) <= F.lit("m"))
                .select("product_category_name",
                        F.upper(F.regexp_replace("product_category_name", " ", "_"))
                        .alias("product_category_name_english")))

    # ------------------------------------------------------------------ derived geography (AGG-1, PRJ-2/3)
    @cached_property
    def zip_centroids(self) -> DataFrame:
        """AGG-1: median lat/lng per zip over in-box points (at most 100k zips: broadcastable)."""
        g = self.geolocation
        inside = g.filter(F.col("geolocation_lat").between(*LAT_BOX) & F.col("geolocation_lng").between(*LNG_BOX))
        return agg_with_quantiles(inside.withColumnRenamed("geolocation_zip_code_prefix", "zip"), ["zip"],
                                  [F.count(F.lit(1)).alias("n_points")],
                                  {"lat": ("geolocation_lat", 0.5), "lng": ("geolocation_lng", 0.5)}).select(
            "zip", "lat", "lng", "n_points")

    @cached_property
    def product_features(self) -> DataFrame:
        """PRJ-2/PRJ-3: category (translated, else original, else 'unknown') and parcel size."""
        p = self.products
        t = self.category_translation
        vol = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
        return (p.join(t, "product_category_name", "left")
                .select("product_id", "product_category_name",
                        F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown"))
                        .alias("category"),
                        vol.alias("volume_cm3"),
                        (vol / F.lit(5000.0)).alias("volumetric_weight_kg"),
                        (F.col("product_weight_g") / F.lit(1000.0)).alias("weight_kg"),
                        F.col("product_photos_qty").alias("photos_qty"),
                        F.col("product_name_lenght").alias("name_len"),
                        F.col("product_description_lenght").alias("desc_len"))
                .withColumn("chargeable_kg", nan_max("weight_kg", "volumetric_weight_kg")))

    @cached_property
    def seller_geo(self) -> DataFrame:
        cen = F.broadcast(self.zip_centroids)
        s = self.sellers
        # written, so that the planner knows its true size and broadcasts it while it is small
        return self._keep(s.join(cen, s.seller_zip_code_prefix == cen.zip, "left")
                          .select("seller_id", "seller_zip_code_prefix", "seller_state",
                                  F.col("lat").alias("sell_lat"), F.col("lng").alias("sell_lng")))

    @cached_property
    def customer_geo(self) -> DataFrame:
        cen = F.broadcast(self.zip_centroids)
        c = self.customers
        return (c.join(cen, c.customer_zip_code_prefix == cen.zip, "left")
                .select("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_state",
                        F.col("lat").alias("cust_lat"), F.col("lng").alias("cust_lng")))

    # ------------------------------------------------------------------ items and orders
    @cached_property
    def items_geo(self) -> DataFrame:
        """Order lines with line counter, price, parcel, both geographies and distance.

        This is the internal base of f_items; freight is derived from it."""
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                        "l_extendedprice", "l_shipdate", "l_discount", "l_tax")
        line_order = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_discount", "l_tax", "_line")
        cg = self.customer_geo.select("customer_id", "customer_state", "cust_lat", "cust_lng")
        sg = self.seller_geo.select("seller_id", "seller_state", "sell_lat", "sell_lng")
        pf = self.product_features.select("product_id", "category", "weight_kg", "volume_cm3", "photos_qty", "name_len",
                                          "desc_len")
        # by product, then by order: the line counter, the customer and the written buckets share the second move
        parcel = (li.withColumn("_line", F.monotonically_increasing_id())
                  .join(pf, li.l_partkey == pf.product_id, "left").drop("product_id"))
        if self.persist:
            parcel = parcel.repartition(self.n_buckets, "l_orderkey")
        base = parcel.select(
            F.col("l_orderkey").alias("order_id"),
            F.dense_rank().over(line_order).alias("order_item_id"),      # a row number of the lines, were a product there twice
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
            fixed_round(F.col("l_extendedprice") * (F.col("l_discount") + F.lit(0.001)) / F.lit(20.0), 2)
            .alias("price"),
            "l_tax", *[c for c in pf.columns if c != "product_id"])
        df = base.join(cg, base.order_id == cg.customer_id, "left").join(sg, "seller_id", "left")
        return (df.drop("customer_id")
                .withColumn("volumetric_weight_kg", F.col("volume_cm3") / F.lit(5000.0))
                .withColumn("chargeable_kg", nan_max("weight_kg", "volumetric_weight_kg"))
                .withColumn("distance_km", haversine_km("sell_lat", "sell_lng", "cust_lat", "cust_lng")))

    @cached_property
    def items_full(self) -> DataFrame:
        """Order lines with geography, parcel and the freight charge (internal)."""
        g = self.items_geo
        freight = (F.lit(5.0) + F.lit(0.9) * F.coalesce("chargeable_kg", F.lit(1.0))
                   + F.lit(0.006) * F.coalesce("distance_km", F.lit(1000.0))
                   + F.lit(100.0) * F.col("l_tax") * (F.lit(1.0) + (F.col("seller_id") % 5) * F.lit(0.3)))
        return self._keep(g.withColumn("freight_value", fixed_round(freight, 2)), "order_id")

    @cached_property
    def items(self) -> DataFrame:
        """f_items: the order-items table with its freight charge."""
        return self.items_full.select("order_id", "order_item_id", "product_id", "seller_id",
                                      "shipping_limit_date", "price", "freight_value")

    @cached_property
    def orders(self) -> DataFrame:
        """f_orders: purchase, approval, carrier, delivery and promised times per order."""
        o = self.raw("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
        k = F.col("o_orderkey")
        max_km = self.items_full.groupBy("order_id").agg(F.max("distance_km").alias("max_km"))
        purchase = add_seconds(F.col("o_orderdate"), k * 7919 % 86400)
        day0 = F.date_trunc("day", purchase)
        estimated = F.timestamp_micros(micros(day0) + (k * 13 % 21 + 14) * F.lit(86_400_000_000))
        status = (F.when(k % 33 != 5, F.lit("delivered"))
                  .when(F.col("o_orderstatus") == "F", F.lit("canceled"))
                  .when(F.col("o_orderstatus") == "O", F.lit("shipped"))
                  .otherwise(F.lit("processing")))
        transit_s = F.floor((F.lit(2.0) + F.coalesce("max_km", F.lit(1000.0)) / F.lit(250.0)) * F.lit(86400.0))
        delivered = add_seconds(purchase, transit_s + k * 104729 % 1209600)
        approved = add_seconds(purchase, k * 31 % 86400)
        df = (o.join(max_km, o.o_orderkey == max_km.order_id, "left")
              .select(k.alias("order_id"), k.alias("customer_id"), status.alias("order_status"),
                      purchase.alias("order_purchase_timestamp"), approved.alias("order_approved_at"),
                      F.when((status == "delivered") & (k % 131 != 0), delivered)
                      .alias("order_delivered_customer_date"),
                      estimated.alias("order_estimated_delivery_date")))
        return self._keep(df.select("order_id", "customer_id", "order_status", "order_purchase_timestamp",
                                    "order_approved_at",
                                    add_seconds("order_approved_at", F.lit(2 * 86400))
                                    .alias("order_delivered_carrier_date"),
                                    "order_delivered_customer_date", "order_estimated_delivery_date"), "order_id")

    @cached_property
    def payments(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
        k = F.col("o_orderkey")
        rows = F.when(k % 3 == 0, F.lit(2)).otherwise(F.lit(1))
        prio = F.substring("o_orderpriority", 1, 1)
        ptype = (F.when(prio.isin("1", "2", "3"), F.lit("credit_card"))
                 .when(prio == "4", F.lit("boleto")).otherwise(F.lit("voucher")))
        return o.select(
            k.alias("order_id"),
            F.explode(F.sequence(F.lit(1), rows)).alias("payment_sequential"),
            ptype.alias("payment_type"),
            F.when(ptype == "credit_card", k % 12 + 1).otherwise(F.lit(1)).cast("int").alias("payment_installments"),
            fixed_round(F.col("o_totalprice") / F.lit(1000.0) / rows, 2).alias("payment_value"))

    @cached_property
    def reviews(self) -> DataFrame:
        o = self.orders.select("order_id", "order_delivered_customer_date", "order_estimated_delivery_date")
        k = F.col("order_id")
        days_late = floor_days("order_delivered_customer_date", "order_estimated_delivery_date")
        n_rev = F.when(k % 10 == 0, F.lit(0)).when(k % 25 == 0, F.lit(2)).otherwise(F.lit(1))
        base = (o.filter(k % 10 != 0)
                .select("*", F.explode(F.sequence(F.lit(1), n_rev)).alias("kth"),
                        days_late.alias("_late")))
        score = F.greatest(F.lit(1), F.lit(5) - F.floor(F.greatest(F.coalesce("_late", F.lit(0)), F.lit(0)) / 2)
                           - k % 3).cast("int")
        created = add_seconds(F.coalesce("order_delivered_customer_date", "order_estimated_delivery_date"),
                              F.col("kth") * 86400)
        return base.select(
            (k * 10 + F.col("kth")).alias("review_id"),
            k.alias("order_id"),
            score.alias("review_score"),
            F.when(k % 9 == 0, F.lit("title")).alias("review_comment_title"),
            F.when(k % 5 >= 3, F.lit("message")).alias("review_comment_message"),
            created.alias("review_creation_date"),
            add_seconds(created, (k % 4 + 1) * 86400).alias("review_answer_timestamp"))

    @cached_property
    def log(self) -> DataFrame:
        """f_log: the scoring service's prediction log, derived from ``events``."""
        from ..streaming.log import log_from_events
        return log_from_events(self.raw("events"))

    # ------------------------------------------------------------------ name -> view
    def view(self, name: str) -> DataFrame:
        return getattr(self, name)

    def register(self, names=("customers", "sellers", "geolocation", "products", "category_translation",
                              "items", "orders", "payments", "reviews")) -> None:
        """Register the fixture views as temp views ``f_<name>`` for SQL users."""
        for name in names:
            self.view(name).createOrReplaceTempView(f"f_{name}")


_MARKETS: dict = {}


def market(spark: SparkSession, sf_dir: str, persist: bool | None = None) -> Market:
    """One handle per (application, folder).  The wide core tables are written
    to the shared folder unless ``spark.cargolens.persistCore`` is ``false``.
    A handle sees the files as they were when its tables were written."""
    key = (spark.sparkContext.applicationId, sf_dir, persist)
    m = _MARKETS.get(key)
    if m is None:
        m = _MARKETS[key] = Market(spark, sf_dir, persist)
    return m
