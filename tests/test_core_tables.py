"""The core tables are joined and grouped by order without moving lines; the audit table is written once."""

import re

from pyspark.sql import functions as F

from cargolens.plans import core
from cargolens.plans.q_audit import audited
from cargolens.plans.q_mart2 import _seller_base, seller_month_panel
from cargolens.sources.fixtures import Market, market
from conftest import SMOKE


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_meet_their_orders_without_a_shuffle(spark):
    m = Market(spark, SMOKE)
    lines, orders = m.items_full, m.orders
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lines.join(orders, "order_id").groupBy("order_id").agg(F.max("distance_km").alias("km"), F.count("*").alias("n"))
        assert "Exchange" not in _plan(joined)
        assert joined.agg(F.sum("n")).first()[0] == lines.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_written_tables_hold_the_rows_of_the_plain_plan(spark):
    kept, plain = Market(spark, SMOKE), Market(spark, SMOKE, persist=False)
    for name in ("customers", "items_full", "orders"):
        a, b = kept.view(name), plain.view(name).select(kept.view(name).columns)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_equal_lines_and_a_product_twice_keep_the_line_numbers(spark, tmp_path):
    for t in ("nation", "customer", "supplier", "orders"):
        spark.read.parquet(f"{SMOKE}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    part, li = (spark.read.parquet(f"{SMOKE}/{t}.parquet") for t in ("part", "lineitem"))
    part.unionByName(part.limit(5)).write.parquet(str(tmp_path / "part.parquet"))
    li.unionByName(li.filter("l_orderkey % 7 = 0")).write.parquet(str(tmp_path / "lineitem.parquet"))
    m = Market(spark, str(tmp_path))
    numbers = m.items_full.groupBy("order_id").agg(F.max("order_item_id").alias("last"))
    raw = m.raw("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.count("*").alias("last"))
    assert numbers.exceptAll(raw.withColumn("last", F.col("last").cast("int"))).isEmpty()


def test_audit_reports_scan_a_written_table(spark):
    a = audited(market(spark, SMOKE))
    assert len(re.findall(r"FileScan", _plan(a))) == 1


def test_order_tables_are_in_buckets(spark):
    m = market(spark, SMOKE)
    for df in (core.item_star(m), core.order_master(m), core.item_frame(m)):
        assert "Exchange" not in _plan(df.groupBy("order_id").count())


def test_seller_months_are_written_once_and_lines_move_once(spark):
    m = Market(spark, SMOKE)
    panel = seller_month_panel(m)
    assert len(re.findall(r"FileScan", _plan(panel))) == 1 and "Exchange" not in _plan(panel)
    b = _seller_base(m)
    long = b.groupBy("seller_id").agg(F.count_distinct("purchase_month").alias("k")).filter("k >= 3")
    want = b.join(long, "seller_id", "left_semi").groupBy("seller_id", "purchase_month").agg(
        F.count_distinct("order_id").alias("n_orders"), F.count("order_item_id").alias("n_items"), F.round(F.sum("price"), 4).alias("revenue"),
        *[F.round(F.avg(c), 6).alias(n) for c, n in (("review_score", "avg_review_score"), ("is_late_ts", "late_rate"), ("freight_value", "avg_freight"))],
        F.round(F.avg("delivery_us") / 86_400_000_000, 6).alias("avg_delivery_days"))
    got = panel.select("seller_id", "purchase_month", "n_orders", "n_items", F.round("revenue", 4), *[
        F.round(c, 6) for c in ("avg_review_score", "late_rate", "avg_freight", "avg_delivery_days")])
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not want.isEmpty()
