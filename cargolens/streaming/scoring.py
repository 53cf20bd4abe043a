"""STR-6: streaming scoring of new records with rejects to a side output.

``readStream`` of record files landing in a folder -> row validation (DQ-14,
a stream-static join to the small state table) -> estimate -> ``foreachBatch``
writing the scored rows and the rejected rows to two Parquet sinks.  Each
micro-batch overwrites its own ``epoch=<id>`` folder, so a retried batch
replaces its output instead of duplicating it (idempotent with the
checkpoint).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def score_batch(records: DataFrame, states: DataFrame, model=None):
    """The shared body of the batch twin and of each micro-batch: (scored, rejected).  ``model`` is a saved freight
    pipeline (:class:`operators.models.Fitted`); without one the literal tariff estimates."""
    from ..plans.q_features import tariff
    from ..plans.q_scoring import validate
    valid, rejected = validate(records, states)
    if model is None:
        scored = valid.withColumn("estimate", tariff("chargeable_kg", "distance_km", "same_state"))
    else:
        scored = model.score(valid, "_log").withColumn("estimate", F.greatest(F.expm1("_log"), F.lit(0.0))).drop("_log")
    return scored, rejected.withColumn("errors", F.concat_ws(" | ", "errors"))


def run_scoring_stream(spark: SparkSession, landing: str, schema, states: DataFrame, out_dir: str,
                       checkpoint: str, model=None, files: int | None = None) -> None:
    """Score everything that has landed (``availableNow``) into ``out_dir/scored`` and ``out_dir/rejected``, with a log line
    for each record in ``out_dir/log``; ``files``: at most that many files a micro-batch."""
    reader = spark.readStream.schema(schema)
    stream = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(landing)

    def write(batch: DataFrame, epoch_id: int) -> None:
        scored, rejected = score_batch(batch, states, model)
        written = {}
        for name, rows in (("scored", scored), ("rejected", rejected)):
            path = os.path.join(out_dir, name, f"epoch={epoch_id}")
            rows.write.mode("overwrite").parquet(path)
            written[name] = spark.read.schema(rows.schema).parquet(path)
        log = written["scored"].select("id", F.lit(200).alias("status"), F.col("estimate").alias("fair_freight")).unionByName(
            written["rejected"].select("id", F.lit(422).alias("status"), F.lit(None).cast("double").alias("fair_freight")))
        log.write.mode("overwrite").parquet(os.path.join(out_dir, "log", f"epoch={epoch_id}"))

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
