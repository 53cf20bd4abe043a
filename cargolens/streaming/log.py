"""The scoring service's prediction log (f_log), derived from ``events``.

One row per scored (or rejected) input row: request id, row number,
endpoint, status, outputs, drift inputs, latency.  The same column
expressions serve the batch view and the streaming source, so a stream and
its batch twin see identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])

# Suggested follow-ups of the late-delivery service.
FOLLOW_UPS = ["Update the delivery estimate", "Check carrier tracking", "Confirm dispatch with seller"]

LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()), T.StructField("request_id", T.LongType()),
    T.StructField("row", T.IntegerType()), T.StructField("endpoint", T.StringType()),
    T.StructField("status", T.IntegerType()), T.StructField("kind", T.StringType()),
    T.StructField("fair_freight", T.DoubleType()), T.StructField("verdict", T.StringType()),
    T.StructField("risk", T.DoubleType()), T.StructField("on_review_list", T.BooleanType()),
    T.StructField("suggested_follow_up", T.StringType()), T.StructField("has_drift", T.BooleanType()),
    T.StructField("drift_inputs", T.ArrayType(T.StringType())), T.StructField("latency_ms", T.DoubleType()),
])


def log_from_events(events: DataFrame) -> DataFrame:
    """Map events to log lines: view / click -> /freight (single / batch), purchase / signup -> /late
    (single / batch), error -> a rejected (422) batch row; the value is the estimate; drift when > 200."""
    et, v, eid = F.col("event_type"), F.col("value"), F.col("event_id")
    endpoint = (F.when(et == "view", F.lit("/freight")).when(et == "click", F.lit("/freight/batch"))
                .when(et == "purchase", F.lit("/late")).when(et == "signup", F.lit("/late/batch"))
                .otherwise(F.lit("/freight/batch")))
    status = F.when(et == "error", F.lit(422)).otherwise(F.lit(200))
    kind = F.split(endpoint, "/").getItem(1)
    ok = status == 200
    is_f, is_l = ok & (kind == "freight"), ok & (kind == "late")
    risk = v / F.lit(500.0)
    k = F.get_json_object("props", "$.k").cast("int")
    follow = F.element_at(F.array(*[F.lit(x) for x in FOLLOW_UPS]), (F.pmod(k, F.lit(3)) + 1).cast("int"))
    drift = F.array_compact(F.array(F.when(v > 200, F.lit("distance_km")), F.when(v > 400, F.lit("weight_kg"))))
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.floor(eid / 4).cast("long").alias("request_id"),
        (eid % 4).cast("int").alias("row"),
        endpoint.alias("endpoint"), status.alias("status"), kind.alias("kind"),
        F.when(is_f, v).alias("fair_freight"),
        F.when(is_f, F.when(v > 300, F.lit("unusual_both")).when(v > 250, F.lit("unusual_forest_only"))
               .otherwise(F.lit("normal"))).alias("verdict"),
        F.when(is_l, risk).alias("risk"),
        F.when(is_l, risk >= 0.5).alias("on_review_list"),
        F.when(is_l, follow).alias("suggested_follow_up"),
        F.when(ok, v > 200).alias("has_drift"),
        F.when(ok, drift).alias("drift_inputs"),
        ((eid * 37 % 600) + 20).cast("double").alias("latency_ms"))
