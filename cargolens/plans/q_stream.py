"""Prediction-log monitoring queries (STR-1..5, SNK-5): the batch twins of the
streaming jobs in ``cargolens.streaming.monitor``, checked against SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import r
from ..registry import ORACLE, query
from ..session import checkpoint_dir, stored
from ..sources.fixtures import market
from ..streaming import monitor as MON

_LOG_SQL = """
lg AS (SELECT CAST(ts AS TIMESTAMP) AS timestamp, CAST(floor(event_id / 4) AS BIGINT) AS request_id,
              CAST(event_id % 4 AS INTEGER) AS "row",
              CASE event_type WHEN 'view' THEN '/freight' WHEN 'click' THEN '/freight/batch' WHEN 'purchase' THEN '/late'
                              WHEN 'signup' THEN '/late/batch' ELSE '/freight/batch' END AS endpoint,
              CASE WHEN event_type = 'error' THEN 422 ELSE 200 END AS status,
              CASE WHEN event_type IN ('purchase', 'signup') THEN 'late' ELSE 'freight' END AS kind,
              CASE WHEN event_type IN ('view', 'click') THEN value END AS fair_freight,
              CASE WHEN event_type IN ('view', 'click') THEN CASE WHEN value > 300 THEN 'unusual_both'
                   WHEN value > 250 THEN 'unusual_forest_only' ELSE 'normal' END END AS verdict,
              CASE WHEN event_type IN ('purchase', 'signup') THEN value / 500.0 END AS risk,
              CASE WHEN event_type IN ('purchase', 'signup') THEN value / 500.0 >= 0.5 END AS on_review_list,
              CASE WHEN event_type <> 'error' THEN value > 200 END AS has_drift,
              CASE WHEN event_type <> 'error' THEN list_filter([CASE WHEN value > 200 THEN 'distance_km' END,
                                                               CASE WHEN value > 400 THEN 'weight_kg' END],
                                                              lambda x: x IS NOT NULL) END AS drift_inputs,
              CASE WHEN event_type IN ('purchase', 'signup') THEN ['Update the delivery estimate', 'Check carrier tracking',
                   'Confirm dispatch with seller'][((CAST(json_extract(props, '$.k') AS INTEGER) % 3) + 3) % 3 + 1] END AS suggested_follow_up,
              CAST(event_id * 37 % 600 + 20 AS DOUBLE) AS latency_ms
       FROM events)"""


def _log(spark, sf):
    return market(spark, sf).log


@query("str01_log_totals", f"""
WITH {_LOG_SQL}
SELECT strftime(date_trunc('day', timestamp), '%Y-%m-%d') AS day, kind, count(*) AS rows,
       count(*) FILTER (WHERE status = 200 AND "row" = 0) AS requests, count(*) FILTER (WHERE status <> 200) AS rejected,
       count(*) FILTER (WHERE status = 200) AS predictions, count(*) FILTER (WHERE has_drift) AS with_drift,
       round_even(sum(fair_freight), 6) AS fair_sum, count(*) FILTER (WHERE verdict <> 'normal') AS unusual,
       round_even(sum(risk), 6) AS risk_sum, count(*) FILTER (WHERE on_review_list) AS on_list
FROM lg GROUP BY 1, 2
""")
def str01_log_totals(spark, sf):
    """STR-1 (batch twin): daily totals per service kind over the prediction log."""
    t = MON.totals_agg(_log(spark, sf))
    return t.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "kind", "rows", "requests", "rejected",
                    "predictions", "with_drift", r("fair_sum", 6).alias("fair_sum"), "unusual",
                    r("risk_sum", 6).alias("risk_sum"), "on_list")


@query("str01_drift_by_input", f"""
WITH {_LOG_SQL}
SELECT strftime(date_trunc('day', timestamp), '%Y-%m-%d') AS day, input, count(*) AS n
FROM (SELECT timestamp, unnest(drift_inputs) AS input FROM lg) GROUP BY 1, 2
""")
def str01_drift_by_input(spark, sf):
    """STR-1 (batch twin): drifted predictions per day and input."""
    d = MON.drift_by_input_agg(_log(spark, sf))
    return d.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "input", "n")


@query("str01_follow_ups", f"""
WITH {_LOG_SQL}
SELECT strftime(date_trunc('day', timestamp), '%Y-%m-%d') AS day, suggested_follow_up, count(*) AS n
FROM lg WHERE suggested_follow_up IS NOT NULL GROUP BY 1, 2
""")
def str01_follow_ups(spark, sf):
    """STR-1 (batch twin): scored orders per day and suggested follow-up."""
    d = MON.follow_ups_agg(_log(spark, sf))
    return d.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "suggested_follow_up", "n")


@query("str02_log_summary", f"""
WITH {_LOG_SQL},
c AS (SELECT count(*) FILTER (WHERE status = 200 AND "row" = 0) AS requests, count(*) FILTER (WHERE status <> 200) AS rejected,
             count(*) FILTER (WHERE status = 200 AND kind = 'freight') AS n_f,
             count(*) FILTER (WHERE status = 200 AND kind = 'late') AS n_l,
             count(*) FILTER (WHERE has_drift) AS with_drift, sum(fair_freight) AS fair_sum,
             count(verdict) AS with_charge, count(*) FILTER (WHERE verdict IN ('unusual_both', 'unusual_forest_only')) AS unusual,
             count(*) FILTER (WHERE verdict = 'unusual_both') AS n_both, sum(risk) AS risk_sum,
             count(*) FILTER (WHERE on_review_list) AS on_list FROM lg),
lat AS (SELECT latency_ms FROM lg WHERE status = 200 AND "row" = 0 ORDER BY timestamp DESC, request_id DESC LIMIT 1000),
l AS (SELECT count(*) AS lat_n, round_even(quantile_cont(latency_ms, 0.5), 1) AS p50,
             round_even(quantile_cont(latency_ms, 0.95), 1) AS p95, round_even(max(latency_ms), 1) AS lat_max FROM lat)
SELECT requests, rejected, n_f + n_l AS predictions, n_f AS freight, n_l AS late, with_drift,
       round_even(with_drift / nullif(n_f + n_l, 0), 4) AS drift_rate, round_even(fair_sum / nullif(n_f, 0), 4) AS mean_fair_freight,
       with_charge, round_even(unusual / nullif(with_charge, 0), 4) AS unusual_rate,
       round_even(n_both / nullif(with_charge, 0), 4) AS both_models_rate, round_even(risk_sum / nullif(n_l, 0), 4) AS mean_risk,
       round_even(on_list / nullif(n_l, 0), 4) AS on_review_list_rate, lat_n, p50, p95, lat_max
FROM c, l
""")
def str02_log_summary(spark, sf, last_n: int = 1000):
    """STR-2: monitoring summary: requests, rejects, predictions by kind, drift rate, mean fair freight,
    unusual rates, mean risk, list rate (null when the denominator is 0) and latency p50 / p95 / max of the
    last 1000 requests (a top-k by time: the limit is the feature)."""
    lg = _log(spark, sf)
    added = MON.counted_flags(lg)
    c = added.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in MON.COUNTS], *[F.sum(x).alias(x) for x in MON.SUMS])
    last = added.filter("requests = 1").orderBy(F.desc("t_us"), F.desc("request_id")).limit(last_n)
    return _summary(c, last)


def _summary(c, last):
    """STR-2: rates from the counts, latencies of the last requests."""
    from ..operators.ranking import attach
    lat = last.agg(F.count(F.lit(1)).alias("lat_n"), r(F.median("latency_ms"), 1).alias("p50"),
                   r(F.percentile("latency_ms", 0.95), 1).alias("p95"), r(F.max("latency_ms"), 1).alias("lat_max"))
    j = attach(c, lat)
    n = F.col("n_f") + F.col("n_l")

    def rate(a, b):
        return r(F.try_divide(F.col(a) if isinstance(a, str) else a, b), 4)
    return j.select("requests", "rejected", n.alias("predictions"), F.col("n_f").alias("freight"),
                    F.col("n_l").alias("late"), "with_drift", rate("with_drift", n).alias("drift_rate"),
                    rate("fair_sum", F.col("n_f")).alias("mean_fair_freight"), "with_charge",
                    rate("unusual", F.col("with_charge")).alias("unusual_rate"),
                    rate("both", F.col("with_charge")).alias("both_models_rate"),
                    rate("risk_sum", F.col("n_l")).alias("mean_risk"),
                    rate("on_list", F.col("n_l")).alias("on_review_list_rate"), "lat_n", "p50", "p95", "lat_max")


@query("str03_dedupe_and_split", f"""
WITH {_LOG_SQL},
d AS (SELECT DISTINCT ON (request_id, "row") * FROM lg ORDER BY request_id, "row", timestamp)
SELECT CASE WHEN status = 422 THEN 'rejected' ELSE 'scored' END AS outcome, count(*) AS n,
       count(DISTINCT request_id) AS requests FROM d GROUP BY 1
""")
def str03_dedupe_and_split(spark, sf):
    """STR-3 (batch twin): one row per (request, row), split into scored and rejected rows."""
    d = MON.dedupe(_log(spark, sf))
    return d.groupBy(F.when(F.col("status") == 422, F.lit("rejected")).otherwise(F.lit("scored")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("request_id").alias("requests"))


@query("str04_sliding_load", f"""
WITH {_LOG_SQL},
w AS (SELECT date_trunc('day', timestamp) - to_days(k::INTEGER) AS start
      FROM lg, (SELECT unnest(range(0, 7)) AS k) ks WHERE status = 200)
SELECT strftime(start, '%Y-%m-%d') AS window_start, strftime(start + INTERVAL 7 DAY, '%Y-%m-%d') AS window_end,
       count(*) AS load FROM w GROUP BY start
""")
def str04_sliding_load(spark, sf):
    """STR-4 (batch twin): scored rows per sliding 7-day window advanced daily."""
    s = MON.sliding_load_agg(_log(spark, sf))
    return s.select(F.date_format("w.start", "yyyy-MM-dd").alias("window_start"),
                    F.date_format("w.end", "yyyy-MM-dd").alias("window_end"), "load")


@query("str05_weekly_promise_alert", """
WITH o AS (SELECT CAST(date_trunc('week', order_purchase_timestamp) AS DATE) AS week,
                  (epoch_us(order_estimated_delivery_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0 AS p
           FROM f_orders WHERE order_status = 'delivered'),
wk AS (SELECT week, count(*) AS orders, median(p) AS promise FROM o GROUP BY 1),
t AS (SELECT *, list_sort(list(promise) OVER (ORDER BY week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)) AS prev FROM wk),
m AS (SELECT *, CASE WHEN len(prev) < 2 THEN NULL WHEN len(prev) % 2 = 1 THEN prev[(len(prev) + 1) // 2]
                     ELSE (prev[len(prev) // 2] + prev[len(prev) // 2 + 1]) / 2 END AS trail FROM t)
SELECT strftime(week, '%Y-%m-%d') AS week, orders, round_even(promise, 6) AS promise, round_even(trail, 6) AS trailing,
       coalesce(abs(promise / trail - 1) > 0.2, false) AS alert
FROM m
""")
def str05_weekly_promise_alert(spark, sf):
    """STR-5 (batch twin): weekly (Monday) median promise of delivered orders and the WIN-9 alert computed on
    the small weekly table (what ``foreachBatch`` runs on each micro-batch of the weekly stream)."""
    from ..functions.columns import frac_days
    o = market(spark, sf).orders.filter(F.col("order_status") == "delivered")
    wk = (o.groupBy(F.to_date(F.date_trunc("week", "order_purchase_timestamp")).alias("week"))
          .agg(F.count(F.lit(1)).alias("orders"),
               F.median(frac_days("order_estimated_delivery_date", "order_purchase_timestamp")).alias("promise")))
    a = MON.weekly_alert_batch(wk)
    return a.select(F.date_format("week", "yyyy-MM-dd").alias("week"), "orders", r("promise", 6).alias("promise"),
                    r("trailing", 6).alias("trailing"), "alert")


@query("snk05_log_round_trip", f"""
WITH {_LOG_SQL}
SELECT strftime(date_trunc('day', timestamp), '%Y-%m-%d') AS day, kind, count(*) AS rows,
       count(*) FILTER (WHERE status = 200 AND "row" = 0) AS requests, count(*) FILTER (WHERE status <> 200) AS rejected,
       count(*) FILTER (WHERE status = 200) AS predictions, count(*) FILTER (WHERE has_drift) AS with_drift,
       round_even(sum(fair_freight), 6) AS fair_sum, count(*) FILTER (WHERE verdict <> 'normal') AS unusual,
       round_even(sum(risk), 6) AS risk_sum, count(*) FILTER (WHERE on_review_list) AS on_list
FROM lg GROUP BY 1, 2
""")
def snk05_log_round_trip(spark, sf):
    """SNK-4 / SNK-5: the log appended as JSON lines by day (plus a malformed line per rejected request) to the
    shared checkpoint folder, read back with its schema skipping bad lines, and the STR-1 totals rebuilt."""
    import os

    from ..sources.files import read_log, write_log
    lg = _log(spark, sf)
    path = os.path.join(checkpoint_dir(spark), "logs", uuid.uuid4().hex)
    write_log(lg, path)
    junk = lg.filter(F.col("status") == 422).select(F.concat(F.lit("not json "), F.col("request_id").cast("string"))
                                                    .alias("value"))
    junk.write.mode("append").text(os.path.join(path, "day=1970-01-01"))
    back = read_log(spark, path)
    t = MON.totals_agg(back)
    return t.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "kind", "rows", "requests", "rejected",
                    "predictions", "with_drift", r("fair_sum", 6).alias("fair_sum"), "unusual",
                    r("risk_sum", 6).alias("risk_sum"), "on_list")


# ---------------------------------------------------------------- the same monitors as streams
def _stream(spark, sf):
    """The log as a stream over the table's file or files, and fresh folders for output and checkpoint."""
    base = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    landing = stored(market(spark, sf).raw("events"), "landing")
    return MON.log_stream(spark, landing.inputFiles()[0].rsplit("/", 1)[0], 8), f"{base}/out", f"{base}/checkpoint"


def _twin(name):
    """The oracle of a stream is that of its batch twin."""
    def deco(fn):
        ORACLE[fn.__name__] = ORACLE[name]
        return query(fn.__name__)(fn)
    return deco


@_twin("str01_log_totals")
def str01_stream_totals(spark, sf):
    """STR-1: the daily totals by a stream in update mode; equal to the batch twin row by row."""
    t = MON.stream_totals(*_stream(spark, sf))
    return t.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "kind", "rows", "requests", "rejected",
                    "predictions", "with_drift", r("fair_sum", 6).alias("fair_sum"), "unusual",
                    r("risk_sum", 6).alias("risk_sum"), "on_list")


@_twin("str02_log_summary")
def str02_stream_summary(spark, sf, last_n: int = 1000):
    """STR-2: the monitoring summary by a stream whose state holds counts and the last 1000 requests of each endpoint."""
    return _summary(*MON.stream_summary(*_stream(spark, sf), last_n))


@_twin("str03_dedupe_and_split")
def str03_stream_split(spark, sf):
    """STR-3: duplicates dropped within the watermark and rejected rows split off by a stream."""
    d = MON.stream_split(*_stream(spark, sf))
    return d.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("request_id").alias("requests"))


@_twin("str04_sliding_load")
def str04_stream_sliding(spark, sf):
    """STR-4: the sliding 7-day load by a stream in update mode."""
    s = MON.stream_sliding(*_stream(spark, sf))
    return s.select(F.date_format("w.start", "yyyy-MM-dd").alias("window_start"),
                    F.date_format("w.end", "yyyy-MM-dd").alias("window_end"), "load")


@query("str04_stream_loads", "SELECT order_id, platform_load_7d FROM f_order_loads")
def str04_stream_loads(spark, sf, files: int = 8):
    """STR-4: orders arrive in order of time, year after year, and every one of the model table leaves with the platform's
    7-day load at its moment; equal to JON-10."""
    from ..functions.columns import micros
    from .core import order_features
    m = market(spark, sf)
    scored = order_features(m, with_loads=False).select("order_id", F.lit(True).alias("_scored"))
    rows = m.orders.join(scored, "order_id", "left").select(
        "order_id", micros("order_purchase_timestamp").alias("t_us"), F.coalesce("_scored", F.lit(False)).alias("scored"),
        F.year("order_purchase_timestamp").alias("_y"))
    rows = stored(rows, "orders")
    base = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    years = sorted(x["_y"] for x in rows.filter(F.col("_y").isNotNull()).select("_y").distinct().collect())   # bounded by the calendar
    for y in years:                                       # each year's files land after those of the year before
        rows.filter(F.col("_y") == y).drop("_y").repartition(files).write.mode("append").parquet(f"{base}/landing")
    stream = (spark.readStream.schema("order_id long, t_us long, scored boolean").option("maxFilesPerTrigger", files)
              .parquet(f"{base}/landing"))
    return MON.stream_loads(stream, f"{base}/out", f"{base}/checkpoint").select("order_id", F.col("load").alias("platform_load_7d"))


@_twin("str05_weekly_promise_alert")
def str05_stream_alert(spark, sf):
    """STR-5: the weekly promise alert by a stream of delivered orders."""
    from ..functions.columns import frac_days
    o = market(spark, sf).orders.filter(F.col("order_status") == "delivered").select(
        F.to_date(F.date_trunc("week", "order_purchase_timestamp")).alias("week"),
        frac_days("order_estimated_delivery_date", "order_purchase_timestamp").alias("promise"))
    landing = stored(o, "landing")
    base = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    stream = (spark.readStream.schema(landing.schema).option("maxFilesPerTrigger", 8)
              .parquet(landing.inputFiles()[0].rsplit("/", 1)[0]))
    a = MON.stream_weekly_alert(stream, f"{base}/out", f"{base}/checkpoint")
    return a.select(F.date_format("week", "yyyy-MM-dd").alias("week"), "orders", r("promise", 6).alias("promise"),
                    r("trailing", 6).alias("trailing"), "alert")
