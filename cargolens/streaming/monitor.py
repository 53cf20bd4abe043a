"""Monitoring of the prediction log, as Structured Streaming jobs with batch twins.

Each ``*_agg`` function is a plain DataFrame transformation used both on a
streaming DataFrame (``readStream``) and on the batch log, so the stream can
be checked against its batch twin on the same input (``availableNow``).

Lateness policy: the log is append-only and nearly ordered; a 1-day
watermark bounds the state, and rows later than that are dropped (counts are
compared on in-order input).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored
from .log import EVENTS_SCHEMA, log_from_events

WATERMARK = "1 day"


def totals_agg(log: DataFrame, window: str = "1 day") -> DataFrame:
    """STR-1: running totals per time window and service kind: rows, requests (first row of a request),
    rejected rows, predictions, with drift, sum of fair freight, unusual charges, sum of risk, on the list."""
    ok = F.col("status") == 200
    return (log.groupBy(F.window("timestamp", window).alias("w"), "kind")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count(F.when(ok & (F.col("row") == 0), F.lit(1))).alias("requests"),
                 F.count(F.when(~ok, F.lit(1))).alias("rejected"),
                 F.count(F.when(ok, F.lit(1))).alias("predictions"),
                 F.count(F.when(F.col("has_drift"), F.lit(1))).alias("with_drift"),
                 F.sum("fair_freight").alias("fair_sum"),
                 F.count(F.when(F.col("verdict") != "normal", F.lit(1))).alias("unusual"),
                 F.sum("risk").alias("risk_sum"),
                 F.count(F.when(F.col("on_review_list"), F.lit(1))).alias("on_list")))


def drift_by_input_agg(log: DataFrame, window: str = "1 day") -> DataFrame:
    """STR-1: drifted predictions per window and input (``explode`` of the drift list)."""
    return (log.select("timestamp", F.explode("drift_inputs").alias("input"))
            .groupBy(F.window("timestamp", window).alias("w"), "input").agg(F.count(F.lit(1)).alias("n")))


def follow_ups_agg(log: DataFrame, window: str = "1 day") -> DataFrame:
    """STR-1: scored orders per window and suggested follow-up."""
    return (log.filter(F.col("suggested_follow_up").isNotNull())
            .groupBy(F.window("timestamp", window).alias("w"), "suggested_follow_up").agg(F.count(F.lit(1)).alias("n")))


def sliding_load_agg(log: DataFrame, length: str = "7 days", slide: str = "1 day") -> DataFrame:
    """STR-4: scored rows per sliding 7-day window, advanced daily (the trailing-load feature kept current)."""
    return (log.filter(F.col("status") == 200)
            .groupBy(F.window("timestamp", length, slide).alias("w")).agg(F.count(F.lit(1)).alias("load")))


def dedupe(log: DataFrame, streaming: bool = False) -> DataFrame:
    """STR-3: one row per (request, row); in a stream within the watermark."""
    if streaming:
        return log.withWatermark("timestamp", WATERMARK).dropDuplicatesWithinWatermark(["request_id", "row"])
    return log.dropDuplicates(["request_id", "row"])


def log_stream(spark: SparkSession, events_path: str, max_files: int = 1, only: str | None = None) -> DataFrame:
    """The log as a stream: Parquet files landing in the folder ``events_path`` (``only``: those names) read with
    ``readStream`` and mapped to log lines."""
    ev = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files)
    if only:
        ev = ev.option("pathGlobFilter", only)
    return log_from_events(ev.parquet(events_path))


def run_updates(df: DataFrame, out: str, checkpoint: str, mode: str = "update", body=None) -> DataFrame:
    """Run a stream on the available input (``availableNow``).  Each micro-batch writes the rows that changed (or what
    ``body`` makes of them) to its own ``epoch=<id>`` folder, so a repeated batch replaces its output; the watermark trims
    the state.  Returns what was written, with its epoch."""
    def write(batch: DataFrame, epoch: int) -> None:
        (body(batch) if body else batch).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    q = (df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.parquet(out)


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The last version of each key among the updates of a stream."""
    values = [c for c in rows.columns if c not in (*keys, "epoch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("epoch").cast("long")).alias("v")).select(*keys, "v.*")


def stream_totals(log: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """STR-1 as a stream: windowed totals in update mode."""
    rows = run_updates(totals_agg(log.withWatermark("timestamp", WATERMARK)), out, checkpoint)
    return latest(rows, ["w", "kind"])


def stream_sliding(log: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """STR-4 as a stream: the sliding load in update mode."""
    return latest(run_updates(sliding_load_agg(log.withWatermark("timestamp", WATERMARK)), out, checkpoint), ["w"])


def stream_split(log: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """STR-3 as a stream: one row per (request, row) within the watermark, with its outcome; append mode."""
    outcome = F.when(F.col("status") == 422, F.lit("rejected")).otherwise(F.lit("scored")).alias("outcome")
    return run_updates(dedupe(log, streaming=True).select("request_id", "row", outcome), out, checkpoint, "append")


BINS_A_DAY = 24                          # of the running counts that say where a week's median is


def weekly_medians(bins: DataFrame, values: DataFrame) -> DataFrame:
    """(week, orders, promise): exact medians of whole weeks.  ``bins``: their counts (week, bin, n), which say in which bins the
    medians are; ``values``: value counts (week, promise, bin, n) of any number of batches, of which only these bins are read."""
    week = Window.partitionBy("week")
    upto = week.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    lo, hi = F.floor((F.col("all") - 1) / 2), F.floor(F.col("all") / 2)
    ranked = bins.filter(F.col("bin").isNotNull()).select("week", "bin", (F.sum("n").over(upto) - F.col("n")).alias("below"), "n",
                                                          F.sum("n").over(week).alias("all"))
    at = ranked.filter((F.col("below") <= hi) & (F.col("below") + F.col("n") > lo))             # one or two bins a week
    at = stored(at.select(F.col("week").alias("_week"), F.col("bin").alias("_bin"), "all",
                          F.min("below").over(week).alias("below")), "median-bins")
    ends = at.agg(F.min("_bin").alias("a"), F.max("_bin").alias("b")).first()
    near = values.filter(F.col("bin").between(ends["a"], ends["b"])).join(                      # bounded by the calendar
        F.broadcast(at), F.col("week").eqNullSafe(F.col("_week")) & (F.col("bin") == F.col("_bin")))
    each = near.groupBy("week", "promise").agg(F.sum("n").alias("n"), F.max("below").alias("below"), F.max("all").alias("all"))
    upto = week.orderBy("promise").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.col("below") + F.sum("n").over(upto))

    def value(rank):
        return F.max(F.when((F.col("end") - F.col("n") <= rank) & (rank < F.col("end")), F.col("promise")))

    found = each.groupBy(F.col("week").alias("_week")).agg(value(lo).alias("lo"), value(hi).alias("hi"))
    orders = bins.groupBy("week").agg(F.sum("n").alias("orders"))
    return orders.join(found, F.col("week").eqNullSafe(F.col("_week")), "left").select(
        "week", "orders", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(
            F.col("lo") + F.lit(0.5) * (F.col("hi") - F.col("lo"))).alias("promise"))


def stream_weekly_alert(promises: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """STR-5 as a stream of (week, promise), incrementally: a micro-batch adds its value counts by week to a store, and only the
    weeks it has rows of get their medians again.  The counts of all batches so far by week and hour of the promise, a small
    table that each batch writes anew, say where the medians are, and only the values of these hours are read from the store:
    no batch moves the counts of those before it again.  The alert is computed on the small weekly table.  A repeated batch
    replaces its own counts and medians."""
    spark = promises.sparkSession
    columns, small = "week date, promise double, n long, bin long", "week date, bin long, n long"

    def update(batch: DataFrame, epoch: int) -> None:
        session, path = batch.sparkSession, f"{out}/counts/epoch={epoch}"
        counts = batch.groupBy("week", "promise").agg(F.count(F.lit(1)).alias("n"))
        hour = F.when(F.isnan("promise"), F.lit((1 << 63) - 1)).otherwise(F.floor(F.col("promise") * BINS_A_DAY))
        counts.withColumn("bin", hour).sortWithinPartitions("bin").write.mode("overwrite").parquet(path)
        own = session.read.schema(columns).parquet(path).select("week", "bin", "n")
        weeks = own.select(F.col("week").alias("_week")).distinct()
        if epoch:
            own = own.unionByName(session.read.schema(small).parquet(f"{out}/bins/epoch={epoch - 1}"))
        own.groupBy("week", "bin").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{out}/bins/epoch={epoch}")
        bins = session.read.schema(small).parquet(f"{out}/bins/epoch={epoch}").join(              # bounded by the calendar
            F.broadcast(weeks), F.col("week").eqNullSafe(F.col("_week")), "left_semi")
        values = session.read.schema(f"{columns}, epoch int").parquet(f"{out}/counts").filter(F.col("epoch") <= epoch)
        weekly_medians(bins, values).write.mode("overwrite").parquet(f"{out}/weekly/epoch={epoch}")

    q = (promises.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return weekly_alert_batch(latest(spark.read.parquet(f"{out}/weekly"), ["week"]))


def counted_flags(log: DataFrame) -> DataFrame:
    """STR-2: every log line as what it adds to each count and sum of the summary (``COUNTS``)."""
    ok, kind, verdict = F.col("status") == 200, F.col("kind"), F.col("verdict")
    flags = {"requests": ok & (F.col("row") == 0), "rejected": ~ok, "n_f": ok & (kind == "freight"), "n_l": ok & (kind == "late"),
             "with_drift": F.col("has_drift"), "with_charge": verdict.isNotNull(),
             "unusual": verdict.isin("unusual_both", "unusual_forest_only"), "both": verdict == "unusual_both",
             "on_list": F.col("on_review_list")}
    return log.select(
        "endpoint", "request_id", "latency_ms", F.unix_micros("timestamp").alias("t_us"),
        *[F.coalesce(v, F.lit(False)).cast("long").alias(k) for k, v in flags.items()],
        *[F.coalesce(v, F.lit(0.0)).alias(k) for k, v in (("fair_sum", F.col("fair_freight")), ("risk_sum", F.col("risk")))])


COUNTS = ["requests", "rejected", "n_f", "n_l", "with_drift", "with_charge", "unusual", "both", "on_list"]
SUMS = ["fair_sum", "risk_sum"]
SHARDS = 32                              # of an endpoint: its state is spread over that many keys


def _summary_state(last_n: int):
    """State of one endpoint and shard: the running counts, and of its last ``last_n`` requests time, id and latency."""
    def update(key, parts, state):
        import numpy as np
        import pandas as pd
        old = state.get if state.exists else (*[0] * len(COUNTS), *[0.0] * len(SUMS), [], [], [])
        total, recent = list(old[:-3]), [np.asarray(x) for x in old[-3:]]
        for rows in parts:
            for i, c in enumerate(COUNTS + SUMS):
                total[i] += rows[c].sum()
            new = rows[rows["requests"] == 1]
            t, q, ms = (np.concatenate([a, new[c].to_numpy()]) for a, c in zip(recent, ("t_us", "request_id", "latency_ms")))
            at = np.lexsort((q, t))[::-1][:last_n]
            recent = [t[at], q[at], ms[at]]
        now = (*[int(x) for x in total[:len(COUNTS)]], *[float(x) for x in total[len(COUNTS):]],
               [int(x) for x in recent[0]], [int(x) for x in recent[1]], [float(x) for x in recent[2]])
        state.update(now)
        yield pd.DataFrame([(*key, *now)], columns=["endpoint", "shard", *COUNTS, *SUMS, "t_us", "request_id", "latency_ms"])
    return update


def stream_summary(log: DataFrame, out: str, checkpoint: str, last_n: int = 1000) -> tuple[DataFrame, DataFrame]:
    """STR-2 as a stream with arbitrary state: (counts, last requests).  Every endpoint's lines are spread over shards by
    request id; the state of a shard is a row of counts and at most ``last_n`` requests, whatever the length of the log, and
    the last ``last_n`` of all are among these."""
    from ..session import ship_package
    ship_package(log.sparkSession)
    held = ", ".join([*[f"{c} long" for c in COUNTS], *[f"{c} double" for c in SUMS],
                      "t_us array<long>", "request_id array<long>", "latency_ms array<double>"])
    sharded = counted_flags(log).withColumn("shard", F.pmod(F.xxhash64("request_id"), F.lit(SHARDS)).cast("int"))
    states = sharded.groupBy("endpoint", "shard").applyInPandasWithState(
        _summary_state(last_n), f"endpoint string, shard int, {held}", held, "update", "NoTimeout")
    now = stored(latest(run_updates(states, out, checkpoint), ["endpoint", "shard"]), "summary")
    counts = now.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS], *[F.sum(c).alias(c) for c in SUMS])
    each = now.select(F.explode(F.arrays_zip("t_us", "request_id", "latency_ms")).alias("e")).select("e.*")
    return counts, each.orderBy(F.desc("t_us"), F.desc("request_id")).limit(last_n)


BLOCK_DAYS = 32                          # of the store of orders: a folder of a batch


def stream_loads(orders: DataFrame, out: str, checkpoint: str, days: int = 7) -> DataFrame:
    """STR-4 as a stream joined to the current load: ``orders`` (order_id, t_us, scored) arrive in order of time, and every
    scored one gets ``load``, the number of orders in [t - days, t).  A micro-batch is added to a store by blocks of days and
    counted against the days it can reach back to, so its work grows with the batch and those days only.  A repeated batch replaces
    its rows.  An order that comes after later ones is counted for the batches from its own on."""
    from ..operators.loads import trailing_counts
    day_us = 86_400_000_000
    spark = orders.sparkSession

    def update(batch: DataFrame, epoch: int) -> None:
        block = F.floor(F.col("t_us") / F.lit(BLOCK_DAYS * day_us)).cast("long")
        batch.withColumn("block", block).write.mode("overwrite").partitionBy("block").parquet(f"{out}/store/epoch={epoch}")
        store = batch.sparkSession.read.schema("order_id long, t_us long, scored boolean, epoch int, block long").parquet(f"{out}/store")
        own = store.filter(F.col("epoch") == epoch)
        first = own.agg(F.min("t_us").alias("t")).first()["t"]
        if first is None:
            return
        since = first - days * day_us
        near = store.filter((F.col("epoch") <= epoch) & (F.col("block") >= since // (BLOCK_DAYS * day_us)) & (F.col("t_us") >= since))
        loads = trailing_counts(near, own.filter("scored"), {"load": (days * day_us, 0)}, probe_id="order_id")
        loads.write.mode("overwrite").parquet(f"{out}/loads/epoch={epoch}")

    q = (orders.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("order_id long, load long, epoch int").parquet(f"{out}/loads").drop("epoch")


def weekly_alert_batch(weekly: DataFrame) -> DataFrame:
    """STR-5 / WIN-9 on the small weekly table: alert when the week's median promise moved more than 20%
    from the median of the previous 4 weeks (at least 2)."""
    frame = Window.orderBy("week").rowsBetween(-4, -1)
    prev = F.sort_array(F.collect_list("promise").over(frame))
    w = weekly.withColumn("_prev", prev)
    n = F.size("_prev")
    mid = (F.when(n < 2, F.lit(None)).when(n % 2 == 1, F.element_at("_prev", ((n + 1) / 2).cast("int")))
           .otherwise((F.element_at("_prev", (n / 2).cast("int")) + F.element_at("_prev", (n / 2 + 1).cast("int"))) / 2))
    return (w.withColumn("trailing", mid).drop("_prev")
            .withColumn("alert", F.coalesce(F.abs(F.col("promise") / F.col("trailing") - 1) > 0.2, F.lit(False))))

