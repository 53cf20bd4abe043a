"""Mart report operators (AGG, WIN, TOP rows over the core tables).

Each function takes the core DataFrames and returns a small aggregate.
Group-bys use partial (map-side) aggregation, so hot keys are combined before
the shuffle; windows without a partition key only ever run over an already
aggregated table whose size is bounded by a small domain (months, states,
categories, bins), never over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import floor_days, r
from .ranking import agg_with_quantiles, global_running


def _all():
    """The whole (already aggregated, small) table as one window."""
    return Window.partitionBy()


def _states_known(df: DataFrame) -> DataFrame:
    return df.filter(F.col("seller_state").isNotNull() & F.col("customer_state").isNotNull())


def pct(cond) -> F.Column:
    """Share of rows meeting ``cond`` (null counts as false), in percent."""
    return F.avg(F.coalesce(cond, F.lit(False)).cast("int")) * 100


def lane_summary(items: DataFrame, orders: DataFrame) -> DataFrame:
    il = items.join(orders.select("order_id", "delivery_days"), "order_id", "left")
    g = agg_with_quantiles(_states_known(il), ["customer_state", "seller_state"], [F.count(F.lit(1)).alias("n")],
                           {"median_freight": ("freight_value", 0.5), "median_distance": ("distance_km", 0.5),
                            "median_delivery_days": ("delivery_days", 0.5)})
    return g.select("customer_state", "seller_state", "n",
                    *[r(c, 1).alias(c) for c in ("median_freight", "median_distance", "median_delivery_days")])


def monthly(delivered: DataFrame) -> DataFrame:
    g = delivered.groupBy("purchase_month").agg(
        F.count_distinct("order_id").alias("orders"), r(F.sum("order_total"), 2).alias("revenue"),
        r(F.avg(F.col("is_late").cast("int")) * 100, 1).alias("late_rate"))
    return (g.withColumn("_last", F.max("purchase_month").over(_all()))
            .filter(F.col("purchase_month") < F.col("_last")).drop("_last"))


def histogram(spark: SparkSession, values: DataFrame, lo: float, hi: float, bins: int) -> DataFrame:
    """AGG-11: fixed-width bins over [lo, hi] (values clipped), last bin closed, empty bins kept."""
    w = (hi - lo) / bins
    x = F.least(F.greatest(F.col("v").cast("double"), F.lit(lo)), F.lit(hi))
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(w)), F.lit(bins - 1))
    counts = values.filter(F.col("v").isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(bins).withColumnRenamed("id", "bin")
    mid = (F.lit(lo) + F.col("bin") * F.lit(w) + F.lit(lo) + (F.col("bin") + 1) * F.lit(w)) / 2
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select(r(mid, 2).alias("bin_mid"), F.coalesce("n", F.lit(0)).alias("count")))


def state_summary(dated: DataFrame, items: DataFrame) -> DataFrame:
    s = (dated.filter(F.col("customer_state").isNotNull()).groupBy("customer_state")
         .agg(F.count("order_id").alias("orders"), F.median("delivery_days").alias("median_delivery_days"),
              r(F.avg(F.col("is_late").cast("int")) * 100, 1).alias("late_rate")))
    f = agg_with_quantiles(items.filter(F.col("freight_value").isNotNull() & F.col("customer_state").isNotNull()),
                           ["customer_state"], [F.count(F.lit(1)).alias("_n")],
                           {"mf": ("freight_value", 0.5), "md": ("distance_km", 0.5), "mr": ("freight_ratio", 0.5)})
    f = f.select("customer_state", r("mf", 2).alias("median_freight"), r("md", 1).alias("median_distance"),
                 r(F.col("mr") * 100, 1).alias("median_burden"))
    return s.join(f, "customer_state", "left")


def lane_spend(items: DataFrame) -> DataFrame:
    g = (_states_known(items)
         .groupBy(F.concat_ws("->", "seller_state", "customer_state").alias("lane"))
         .agg(F.count(F.lit(1)).alias("lines"), F.sum("freight_value").alias("s")))
    return g.select("lane", "lines", r("s", 2).alias("freight_spend"),
                    r(F.col("s") / F.sum("s").over(_all()) * 100, 3).alias("pct_of_spend"),
                    F.row_number().over(Window.orderBy(F.desc("s"), "lane")).alias("spend_rank"))


def corridor(items: DataFrame) -> DataFrame:
    x = _states_known(items)
    hub = (x.groupBy("seller_state").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "seller_state").limit(1).select("seller_state"))
    x = (x.join(F.broadcast(hub.select("seller_state", F.lit(True).alias("from_hub"))), "seller_state", "left")
         .join(F.broadcast(hub.select(F.col("seller_state").alias("customer_state"), F.lit(True).alias("to_hub"))),
               "customer_state", "left")
         .select("freight_value", "distance_km",
                 F.coalesce("from_hub", F.lit(False)).alias("from_hub"),
                 F.coalesce("to_hub", F.lit(False)).alias("to_hub")))
    hh = F.col("from_hub") & F.col("to_hub")
    ho = F.col("from_hub") & ~F.col("to_hub")
    g = agg_with_quantiles(x, [], [
        r(pct(hh), 3).alias("hub_hub_line_pct"), r(pct(ho), 3).alias("hub_out_line_pct"),
        r(F.sum(F.when(hh, F.col("freight_value"))) / F.sum("freight_value") * 100, 3).alias("hub_hub_freight_pct"),
        r(F.sum(F.when(ho, F.col("freight_value"))) / F.sum("freight_value") * 100, 3).alias("hub_out_freight_pct")],
        {"hh": (F.when(hh, F.col("distance_km")), 0.5), "ho": (F.when(ho, F.col("distance_km")), 0.5)})
    return g.select("hub_hub_line_pct", "hub_out_line_pct", "hub_hub_freight_pct", "hub_out_freight_pct",
                    r("hh", 3).alias("hub_hub_median_km"), r("ho", 3).alias("hub_out_median_km"))


def _per_person(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_unique_id").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("order_total").alias("spend"),
        F.min("purchase_month").alias("first_month"))


def orders_per_customer(orders: DataFrame) -> DataFrame:
    c = _per_person(orders)
    bucket = F.when(F.col("orders") >= 5, F.lit("5+")).otherwise(F.col("orders").cast("string"))
    return c.groupBy(bucket.alias("orders_placed")).agg(F.count(F.lit(1)).alias("customers"))


def repeat_rate(orders: DataFrame) -> DataFrame:
    c = _per_person(orders)
    return c.agg(F.count(F.lit(1)).alias("customers"),
                 r(pct(F.col("orders") > 1), 2).alias("repeat_rate"),
                 r(F.sum(F.when(F.col("orders") > 1, F.col("spend"))) / F.sum("spend") * 100, 1)
                 .alias("repeat_rev_share"))


def repeat_gap(orders: DataFrame) -> DataFrame:
    """WIN-4 without a per-person window: the first order is a ``min`` of
    (time, order id) per person, the second the ``min`` of the rest; both are
    partial aggregates, so a person with very many orders is no hot task."""
    key = F.struct(F.col("order_purchase_timestamp").alias("ts"), F.col("order_id").alias("id"))
    o = orders.select("customer_unique_id", key.alias("k"))
    first = o.groupBy("customer_unique_id").agg(F.min("k").alias("first"))
    second = (o.join(first, "customer_unique_id").filter(F.col("k") > F.col("first"))
              .groupBy("customer_unique_id").agg(F.min("k").alias("second"), F.min("first").alias("first")))
    g = second.select(floor_days("second.ts", "first.ts").alias("gap_days"))
    return g.agg(F.count(F.lit(1)).alias("repeat_customers"), F.median("gap_days").alias("gap_median"),
                 F.percentile("gap_days", 0.25).alias("gap_p25"), F.percentile("gap_days", 0.75).alias("gap_p75"))


def new_vs_returning(orders: DataFrame) -> DataFrame:
    first = orders.groupBy("customer_unique_id").agg(F.min("purchase_month").alias("_first"))
    o = orders.select("customer_unique_id", "purchase_month").join(first, "customer_unique_id")
    ret = F.col("purchase_month") > F.col("_first")
    return o.groupBy("purchase_month").agg(
        F.count(F.when(~ret, F.lit(1))).alias("new_orders"), F.count(F.when(ret, F.lit(1))).alias("returning_orders"),
        r(pct(ret), 3).alias("returning_pct"))


def segments(orders: DataFrame) -> DataFrame:
    c = _per_person(orders)
    seg = F.when(F.col("orders") > 1, F.lit("repeat")).otherwise(F.lit("one-time")).alias("segment")
    s = c.groupBy(seg).agg(F.count(F.lit(1)).alias("customers"), r(F.avg("spend"), 4).alias("mean_spend"))
    o = orders.join(c.select("customer_unique_id", seg), "customer_unique_id")
    dated = (F.col("order_status") == "delivered") & F.col("delivery_days").isNotNull()
    o2 = o.groupBy("segment").agg(
        r(F.avg("order_total"), 4).alias("mean_order_value"),
        r(F.avg(F.when(dated, F.col("is_late").cast("int"))) * 100, 3).alias("late_rate"),
        r(F.avg("delivery_days"), 4).alias("mean_delivery_days"))
    return s.join(o2, "segment")


def demand_top(orders: DataFrame, k: int = 10) -> DataFrame:
    g = orders.groupBy("customer_state").agg(F.count(F.lit(1)).alias("n"))
    g = g.withColumn("pct_orders", r(F.col("n") / F.sum("n").over(_all()) * 100, 1))
    return (g.filter(F.col("customer_state").isNotNull()).orderBy(F.desc("n"), "customer_state").limit(k)
            .select("customer_state", "pct_orders"))


def supply_demand(sellers: DataFrame, orders: DataFrame, k: int = 10) -> DataFrame:
    s = (sellers.filter(F.col("seller_state").isNotNull()).groupBy(F.col("seller_state").alias("state"))
         .agg(F.count(F.lit(1)).alias("n")).select("state", (F.col("n") / F.sum("n").over(_all()) * 100).alias("sp")))
    d = (orders.filter(F.col("customer_state").isNotNull()).groupBy(F.col("customer_state").alias("state"))
         .agg(F.count(F.lit(1)).alias("n")).select("state", (F.col("n") / F.sum("n").over(_all()) * 100).alias("dp")))
    j = s.join(d, "state", "full").select("state", F.coalesce("sp", F.lit(0.0)).alias("sp"),
                                           F.coalesce("dp", F.lit(0.0)).alias("dp"))
    return (j.orderBy(F.desc(F.col("sp") + F.col("dp")), "state").limit(k)
            .select("state", r("sp", 3).alias("supply_pct"), r("dp", 3).alias("demand_pct"),
                    r(F.col("sp") - F.col("dp"), 3).alias("gap_pct")))


def seller_items(items: DataFrame) -> DataFrame:
    s = items.groupBy("seller_id").agg(F.count("order_item_id").alias("items"))
    return s.agg(F.count(F.lit(1)).alias("sellers"), F.median("items").alias("items_median"),
                 F.percentile("items", 0.9).alias("items_p90"), F.max("items").alias("items_max"),
                 r(pct(F.col("items") <= 10), 2).alias("le10_pct"))


def _seller_cum(items: DataFrame) -> DataFrame:
    s = items.groupBy("seller_id").agg(F.sum("price").alias("rev"))
    c = global_running(s, [F.desc("rev"), F.asc("seller_id")], {"cum_rev": "rev"})
    return c.withColumn("cum", F.col("cum_rev") / F.col("_total_cum_rev"))


def seller_concentration(items: DataFrame) -> DataFrame:
    c = _seller_cum(items)
    n = F.col("_total_n")

    def top(p):
        k = F.floor(n * F.lit(p / 100.0))
        k = F.when(k == 0, n).otherwise(k)          # a zero position wraps to the last seller
        return r(F.max(F.when(F.col("_k") == k, F.col("cum"))) * 100, 3)
    return c.agg(F.count(F.when(F.col("cum") <= 0.8, F.lit(1))).alias("sellers_80"),
                 r(F.count(F.when(F.col("cum") <= 0.8, F.lit(1))) / F.max(n) * 100, 3).alias("sellers_80_pct"),
                 top(1).alias("top1_pct"), top(5).alias("top5_pct"), top(10).alias("top10_pct"),
                 top(20).alias("top20_pct"))


def seller_pareto(items: DataFrame, points: int = 250) -> DataFrame:
    c = _seller_cum(items).withColumn("i", F.col("_k") - 1)
    step = (F.col("n") - 1) / F.lit(float(points - 1))
    pos = (c.agg(F.max("_total_n").alias("n"))
           .select("n", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("j"))
           .select(F.when(F.col("j") == points - 1, F.col("n") - 1)
                   .otherwise(F.floor(F.col("j") * step)).alias("i"))
           .distinct())
    return (c.join(F.broadcast(pos), "i")
            .select(r((F.col("i") + 1) / F.col("_total_n") * 100, 3).alias("pct_sellers"),
                    r(F.col("cum") * 100, 3).alias("cum_revenue")))


def interstate(items: DataFrame) -> DataFrame:
    x = _states_known(items).withColumn("interstate", F.col("seller_state") != F.col("customer_state"))
    g = agg_with_quantiles(x, ["interstate"], [F.count(F.lit(1)).alias("n")],
                           {"med_freight": ("freight_value", 0.5), "med_dist": ("distance_km", 0.5), "med_ratio": ("freight_ratio", 0.5)})
    return g.select("interstate", r(F.col("n") / F.sum("n").over(_all()) * 100, 4).alias("share"),
                    "med_freight", r("med_dist", 4).alias("med_dist"), r("med_ratio", 6).alias("med_ratio"))


def category_summary(items: DataFrame) -> DataFrame:
    g = agg_with_quantiles(items.filter(F.col("category").isNotNull()), ["category"],
                           [F.count("order_item_id").alias("lines"), r(F.sum("price"), 3).alias("revenue")],
                           {"med_price": ("price", 0.5), "med_freight": ("freight_value", 0.5),
                            "med_ratio": ("freight_ratio", 0.5), "med_weight": ("weight_kg", 0.5)})
    return g.select("category", "lines", "revenue",
                    *[r(c, 3).alias(c) for c in ("med_price", "med_freight", "med_ratio", "med_weight")])


def category_top_shares(items: DataFrame, k: int = 10) -> DataFrame:
    c = (items.filter(F.col("category").isNotNull()).groupBy("category")
         .agg(F.count("order_item_id").alias("lines"), F.sum("price").alias("revenue")))
    c = c.select("*", F.row_number().over(Window.orderBy(F.desc("lines"), "category")).alias("rl"),
                 F.row_number().over(Window.orderBy(F.desc("revenue"), "category")).alias("rr"))
    return c.agg(F.count(F.lit(1)).alias("n_categories"),
                 r(F.sum(F.when(F.col("rl") <= k, F.col("lines"))) / F.sum("lines") * 100, 3).alias("top10_vol_pct"),
                 r(F.sum(F.when(F.col("rr") <= k, F.col("revenue"))) / F.sum("revenue") * 100, 3)
                 .alias("top10_rev_pct"))
