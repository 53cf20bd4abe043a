"""Several Spark jobs at a time from one driver program.

Fits, scorings and searches are long chains of small jobs; one chain leaves most
cores idle.  :func:`concurrently` runs independent chains in a bounded pool of
threads that inherit the session's local properties, each in a FAIR pool of its
own (without the FAIR scheduler they share the queue in order of submission).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

LIMIT = 4


def concurrently(spark: SparkSession, jobs: Sequence[Callable[[], object]], limit: int = LIMIT) -> list:
    """The results of ``jobs``, in their order; at most ``limit`` run at a time.  The first error is raised."""
    def run(k: int, job: Callable[[], object]) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"cargolens-{k % limit}")
        return job()

    if len(jobs) < 2 or limit < 2:
        return [job() for job in jobs]
    with ThreadPool(min(limit, len(jobs))) as pool:
        waiting = [pool.apply_async(inheritable_thread_target(spark)(run), (k, job)) for k, job in enumerate(jobs)]
        return [w.get() for w in waiting]


def spread(df: DataFrame) -> DataFrame:
    """Rows of a small table, stored in few files, dealt out to all cores before work that is heavy a row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
