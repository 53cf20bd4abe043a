"""SRC-1 / SRC-2: raw table scans.

Every table is read lazily from Parquet; callers ``select`` only the columns
they use, and Catalyst prunes the ``ReadSchema`` and pushes filters into the
scan, so column pruning is never done by hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=RAW_TABLES) -> None:
    """One temp view per raw table, for SQL users."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
