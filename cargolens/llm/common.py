"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Texts can be long, so Python workers get small Arrow batches.
ARROW_ROWS = 500
ARROW_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """For the Python operators: small Arrow batches, and this package on every
    executor (Spark's file server hands out the archive)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    sc = spark.sparkContext
    if not getattr(sc, "_cargolens_sent", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        root, name = os.path.split(package)
        archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="cargolens-")), name)
        sc.addPyFile(shutil.make_archive(archive, "zip", root, name))
        sc._cargolens_sent = True


def prepare_long(spark: SparkSession) -> None:
    """:func:`prepare`, and batches bounded by bytes too: a batch holds one text at least, but not many long ones."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_table(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    This cuts the lineage: what follows reads files that every executor sees,
    so a lost executor costs only its running tasks.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_row(df: DataFrame, **beside: str) -> DataFrame:
    """All columns as one struct ``_row``, so that no name of the table can clash
    with a name that an operator uses on the way; ``beside`` are columns of the
    table (by their new names) that stand beside the struct instead of in it."""
    inside = [F.col(f"`{c}`") for c in df.columns if c not in beside.values()]
    return df.select(F.struct(*(inside or [F.lit(0).alias("none")])).alias("_row"),
                     *[F.col(f"`{c}`").alias(k) for k, c in beside.items()])


def restored(df: DataFrame, but: Sequence[str] = (), **beside: str) -> list[Column]:
    """The columns of ``df`` back out of what :func:`as_row` made of it, without
    those that an operator replaces."""
    own = {c: F.col(k) for k, c in beside.items()}
    return [(own[c] if c in own else F.col("_row")[c]).alias(c) for c in df.columns if c not in but]


def bucket_count(rows: int) -> int:
    """Buckets for :func:`running`: about the square root of the row count, so
    that neither a bucket nor the list of buckets of one key grows with more
    than the square root of the data."""
    return max(16, 1 << math.ceil(math.log2(max(2.0, math.sqrt(rows)))))


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality of the named columns."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


def running(df: DataFrame, keys: Sequence[str], hash_col: str, order: Sequence[str], value: Column,
            buckets: int, alias: str) -> DataFrame:
    """Exclusive running sum of ``value`` within ``keys``, in the order of
    (hash bucket, ``order``), as ``alias``.

    Two levels instead of one window over a key: rows are summed inside small
    hash buckets, and the buckets' totals are summed inside the key.  A key
    that holds a third of all rows is spread over all buckets.
    """
    rows = df.withColumn("_b", F.pmod(F.col(hash_col), F.lit(buckets)).cast("int")).withColumn("_v", value)
    inner = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_in", F.coalesce(F.sum("_v").over(inner), F.lit(0)))
    offsets = (rows.groupBy(*keys, "_b").agg(F.sum("_v").alias("_t"))
               .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_ob"),
                       F.col("_t")))
    okeys = [f"_k_{k}" for k in keys]
    before = Window.partitionBy(*okeys).orderBy("_ob").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0)))
    cond = F.col("_b") == F.col("_ob")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return (local.join(offsets, cond)
            .select(*df.columns, (F.col("_in") + F.col("_off")).alias(alias)))
