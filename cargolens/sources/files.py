"""File sources and sinks (SRC-3, SNK-1..5).

Reads use explicit schemas (no inference); malformed text becomes null or is
dropped by the reader, never by Python code on the driver.  Writes go to the
shared storage the cluster names; small mart tables are written as one file
each (they are aggregates), everything else keeps Spark's partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..streaming.log import LOG_SCHEMA

# Accepted aliases of upload columns, and the columns an upload must have.
UPLOAD_ALIASES = {"seller_zip_code_prefix": "seller_zip", "customer_zip_code_prefix": "customer_zip"}
UPLOAD_REQUIRED = ["price", "freight_value", "weight_kg", "volume_cm3", "seller_state", "customer_state"]
UPLOAD_NUMERIC = ["price", "freight_value", "weight_kg", "volume_cm3", "n_items", "n_sellers", "distance_km"]


def read_upload(spark: SparkSession, path: str, aliases: Mapping[str, str] = UPLOAD_ALIASES):
    """SRC-3: permissive load of a user CSV: every column read as text, aliases renamed, a row number,
    numeric coercion with ``try_cast`` (bad text -> null), default ids, rows without a charge split off
    into a rejects frame, and a required-column check.  Returns (rows, rejects, messages)."""
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("inferSchema", False)
           .csv(path))
    for a, b in aliases.items():
        if a in raw.columns:
            raw = raw.withColumnRenamed(a, b)
    missing = [c for c in UPLOAD_REQUIRED if c not in raw.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    u = raw.withColumn("file_row", F.monotonically_increasing_id())
    for c in UPLOAD_NUMERIC:
        if c in u.columns:
            u = u.withColumn(c, F.expr(f"try_cast(`{c}` AS DOUBLE)"))
    u = u.withColumn("order_id", F.coalesce(F.col("order_id").cast("string"), F.concat(F.lit("row "),
                                                                                     F.col("file_row").cast("string")))
                     if "order_id" in u.columns else F.concat(F.lit("row "), F.col("file_row").cast("string")))
    u = u.withColumn("seller_id", F.coalesce(F.col("seller_id"), F.lit("unknown"))
                     if "seller_id" in u.columns else F.lit("unknown"))
    messages = []
    if "distance_km" not in u.columns and not {"seller_zip", "customer_zip"} <= set(u.columns):
        messages.append("no distance and no zip codes: distances are measured between state centres")
    rows = u.filter(F.col("freight_value").isNotNull())
    rejects = u.filter(F.col("freight_value").isNull()).withColumn("reason", F.lit("no charged freight"))
    return rows, rejects, messages


def write_table(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> None:
    """SNK-1: write a named mart table; ``single_file`` for small aggregates (one file per table)."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.format(fmt).save(path))


def write_document(df: DataFrame, path: str) -> None:
    """SNK-2: a one-row facts / metadata document as JSON (``to_json(struct(*))``)."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def round_trip(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """SNK-3: write records, read them back and compare counts per key (Parquet, so no float text
    round-off); returns rows whose counts differ (empty when equal)."""
    df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.parquet(path)
    a = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_before"))
    b = back.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_after"))
    return a.join(b, keys, "full").filter(~F.col("n_before").eqNullSafe(F.col("n_after")))


def write_log(log: DataFrame, path: str) -> None:
    """SNK-4: append-only prediction log, one JSON line per scored or rejected row, partitioned by day."""
    (log.withColumn("day", F.to_date("timestamp")).write.mode("append").partitionBy("day").json(path))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """SNK-5: read a log back with its schema, skipping malformed lines."""
    return spark.read.schema(LOG_SCHEMA).option("mode", "DROPMALFORMED").json(path)
