"""SRC-1: the nine marketplace tables as loaded (fixture views)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import query
from ..sources.fixtures import market


def ntz(df):
    """Timestamps leave the engine as TIMESTAMP_NTZ (wall-clock UTC), like DuckDB's TIMESTAMP."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp"
                       else F.col(f.name) for f in df.schema.fields])


@query("src1_orders", "SELECT * FROM f_orders")
def src1_orders(spark, sf):
    """SRC-1 / SRC-2: the orders table (explicit columns; Catalyst prunes the Parquet ReadSchema)."""
    return ntz(market(spark, sf).orders)


@query("src1_items", "SELECT * FROM f_items")
def src1_items(spark, sf):
    """SRC-1 / SRC-2: the order items table (explicit columns; Catalyst prunes the Parquet ReadSchema)."""
    return ntz(market(spark, sf).items)


@query("src1_payments", "SELECT * FROM f_payments")
def src1_payments(spark, sf):
    """SRC-1 / SRC-2: the payments table (explicit columns; Catalyst prunes the Parquet ReadSchema)."""
    return market(spark, sf).payments


@query("src1_reviews", "SELECT * FROM f_reviews")
def src1_reviews(spark, sf):
    """SRC-1 / SRC-2: the reviews table (explicit columns; Catalyst prunes the Parquet ReadSchema)."""
    return ntz(market(spark, sf).reviews)


@query("src1_customers", "SELECT * FROM f_customers")
def src1_customers(spark, sf):
    """SRC-1 / SRC-2: the customers table (explicit columns; Catalyst prunes the Parquet ReadSchema)."""
    return market(spark, sf).customers


@query("src1_sellers", "SELECT * FROM f_sellers")
def src1_sellers(spark, sf):
    """SRC-1 / SRC-2: the sellers table (explicit columns; Catalyst prunes the Parquet ReadSchema)."""
    return market(spark, sf).sellers


@query("src1_products", "SELECT * FROM f_products")
def src1_products(spark, sf):
    """SRC-1 / SRC-2: the products table (explicit columns; Catalyst prunes the Parquet ReadSchema)."""
    return market(spark, sf).products


@query("src1_geolocation", "SELECT * FROM f_geo")
def src1_geolocation(spark, sf):
    """SRC-1 / SRC-2: the geolocation table (explicit columns; Catalyst prunes the Parquet ReadSchema)."""
    return market(spark, sf).geolocation


@query("src1_category_translation", "SELECT * FROM f_cat_trans")
def src1_category_translation(spark, sf):
    """SRC-1 / SRC-2: the category translation table (explicit columns; Catalyst prunes the Parquet ReadSchema)."""
    return market(spark, sf).category_translation
