"""SparkSession construction and session-level settings.

Everything a job needs from the session goes through here: adaptive query
execution (runtime coalescing and skew-join splitting), the UTC session time
zone that both the Spark plans and the DuckDB oracle assume, and the shared
checkpoint folder used to cut long lineages.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session gets; a cluster launcher may override any of them.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


_SHIPPING = threading.Lock()


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cargolens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a
    cluster submit keeps its own values.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_session_defaults(spark)
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    """Pin the settings result semantics depend on (time zone, ANSI)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir``.  Only a local session (tests) that has
    none gets a fresh scratch folder; on a cluster a folder that one machine
    alone sees would lose data, so the setting is required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="cargolens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def ship_package(spark: SparkSession) -> None:
    """For operators with Arrow functions: this package on every executor (Spark's file server hands out the archive)."""
    sc = spark.sparkContext
    with _SHIPPING:                                       # fits run in several threads
        if not getattr(sc, "_cargolens_shipped", False):
            package = os.path.dirname(os.path.abspath(__file__))
            root, name = os.path.split(package)
            archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="cargolens-")), f"{name}-core")
            sc.addPyFile(shutil.make_archive(archive, "zip", root, name))
            sc._cargolens_shipped = True


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later plans scan
    it with column pruning, and a lost executor costs only its running tasks."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS_A_BUCKET = 750_000


def buckets(df: DataFrame) -> int:
    """How many buckets a table with as many rows as ``df`` gets: a bucket is joined and sorted by one task, so
    their number grows with the table (a scan's row count comes from the Parquet footers)."""
    fewest = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = int(df.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(fewest, -(-df.count() // ROWS_A_BUCKET)))


def stored_by(df: DataFrame, name: str, key: str, n: int) -> DataFrame:
    """As :func:`stored`, in ``n`` buckets of ``key``: joins and groupings of such tables on ``key`` move no row."""
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{table}"
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("compression", "zstd").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
