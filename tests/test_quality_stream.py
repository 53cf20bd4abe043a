"""Profiling, gate, and a stream compared with its batch twin."""
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from cargolens.operators import quality as Q
from cargolens.session import checkpoint_dir
from cargolens.streaming import monitor as MON
from cargolens.streaming.log import log_from_events

from conftest import SMOKE


def test_overview_and_missing(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    ov = Q.overview({"t": df}).first()
    assert (ov.rows, ov.cols, ov.total_missing_cells, ov.exact_dup_rows) == (3, 2, 2, 1)
    miss = {r.column: (r.missing_rows, r.missing_pct) for r in Q.missing({"t": df}).collect()}
    assert miss == {"b": (2, 66.67)}


def test_gate_raises_on_drift(spark):
    facts = spark.createDataFrame([(10.0, 5.0)], "a double, b double")
    assert Q.gate(facts, {"a": 10.0, "b": 5.2}, {"b": 0.5}).count() == 2
    with pytest.raises(Exception):
        Q.gate(facts, {"a": 11.0}).collect()


def test_stream_totals_equal_batch_twin(spark):
    src = os.path.join(SMOKE, "events.parquet")
    landing = tempfile.mkdtemp(prefix="cargolens-test-landing-")      # the log lands in a folder
    shutil.copy(src, os.path.join(landing, "part-0.parquet"))
    ck = tempfile.mkdtemp(prefix="cargolens-test-ckpt-")
    streamed = MON.stream_totals(MON.log_stream(spark, landing), f"{ck}/out", f"{ck}/checkpoint")
    batch = MON.totals_agg(log_from_events(spark.read.parquet(src)))
    key = ["w", "kind"]
    s = streamed.orderBy(*key).select(F.col("w.start").alias("ws"), "kind", "rows", "predictions", "with_drift", "on_list")
    b = batch.orderBy(*key).select(F.col("w.start").alias("ws"), "kind", "rows", "predictions", "with_drift", "on_list")
    assert s.collect() == b.collect()
    ck = tempfile.mkdtemp(prefix="cargolens-test-ckpt-")
    twice = MON.stream_split(MON.log_stream(spark, landing), f"{ck}/out", f"{ck}/checkpoint").drop("epoch")
    once = MON.dedupe(log_from_events(spark.read.parquet(src))).select(
        "request_id", "row", F.when(F.col("status") == 422, "rejected").otherwise("scored").alias("outcome"))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_drift_warnings(spark):
    """Both sides of the band, counts, unseen and missing levels; a missing number is neither counted nor flagged."""
    from cargolens.plans.q_drift import drift_profile, drift_warnings
    schema = "id int, a double, b double, n int, s string"
    train = spark.createDataFrame([(i, float(10 + i % 5), float(i % 3), 1 + i % 2, "SP") for i in range(60)] + [(60, None, None, None, "RJ")], schema)
    scales = {"a": "log1p", "b": "raw", "n": "count"}
    p = {x.column: x for x in drift_profile(train, scales).collect()}
    assert (p["a"].n, p["n"].max, p["a"].train_share_outside) == (60, 2.0, 0.0) and 8 < p["a"].low < 10 < p["a"].high < 18
    rows = spark.createDataFrame([(1, 12.0, 1.0, 2, "SP"), (2, 1234.5, -9.0, 3, "XX"), (3, None, None, None, None)], schema)
    got = {x.id: x for x in drift_warnings(rows, train, scales, ["s"]).collect()}
    assert got[1].drift_inputs == [] and got[3].drift_inputs == ["s"]
    assert got[2].drift_inputs == ["a", "b", "n", "s"]
    assert got[2].warnings[0].startswith("a = 1,234.50 is above the training mean + 3 sd on the log scale (")
    assert got[2].warnings[1].startswith("b = -9.00 is below the training mean - 3 sd (")
    assert got[2].warnings[2:] == ["n = 3 is above the largest value seen in training (2)",
                                   "s 'XX' was not seen in training: the model treats it as a rare value"]


def test_stream_summary_over_many_batches(spark, tmp_path):
    """The state keeps the last requests over micro-batches that come in any order, and a second run adds nothing."""
    events = spark.read.parquet(os.path.join(SMOKE, "events.parquet"))
    landing = str(tmp_path / "landing")
    events.repartition(6).write.parquet(landing)
    args = (str(tmp_path / "out"), str(tmp_path / "checkpoint"), 7)
    log = log_from_events(events)
    want = MON.counted_flags(log)
    last = want.filter("requests = 1").orderBy(F.desc("t_us"), F.desc("request_id")).limit(7)
    for _ in range(2):
        counts, recent = MON.stream_summary(MON.log_stream(spark, landing, 2), *args)
        got = counts.first()
        assert [got[c] for c in MON.COUNTS] == list(want.agg(*[F.sum(c) for c in MON.COUNTS]).first())
        assert abs(got.risk_sum - want.agg(F.sum("risk_sum")).first()[0]) < 1e-6
        assert sorted(x.request_id for x in recent.collect()) == sorted(x.request_id for x in last.collect())


def test_stream_loads_and_weekly_alert_by_batch(spark, tmp_path):
    day = 86_400_000_000
    orders = [(i, i * day // 3, i % 4 != 0) for i in range(120)]
    landing = str(tmp_path / "orders")
    for k in range(0, 120, 40):                            # three batches in order of time
        spark.createDataFrame(orders[k:k + 40], "order_id long, t_us long, scored boolean").coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema("order_id long, t_us long, scored boolean").option("maxFilesPerTrigger", 1).parquet(landing)
    loads = MON.stream_loads(stream, str(tmp_path / "loads"), str(tmp_path / "c1"))
    assert {x.order_id: x.load for x in loads.collect()} == {
        i: sum(1 for _, u, _ in orders if t - 7 * day <= u < t) for i, t, s in orders if s}
    import datetime
    weeks = [datetime.date(2024, 1, 1) + datetime.timedelta(days=7 * w) for w in range(8)]
    rows = [(w, float((i * 7 + k * 3) % 11 + (5 if i == 6 else 0))) for i, w in enumerate(weeks) for k in range(9)]
    spark.createDataFrame(rows, "week date, promise double").repartition(4).write.parquet(str(tmp_path / "promises"))
    stream = spark.readStream.schema("week date, promise double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "promises"))
    got = MON.stream_weekly_alert(stream, str(tmp_path / "alerts"), str(tmp_path / "c2"))
    weekly = spark.createDataFrame(rows, "week date, promise double").groupBy("week").agg(
        F.count(F.lit(1)).alias("orders"), F.median("promise").alias("promise"))
    want = MON.weekly_alert_batch(weekly)
    cols = ["week", "orders", "promise", "trailing", "alert"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_weekly_alert_moves_no_earlier_counts(spark, tmp_path):
    """Null weeks, null and repeated promises over many batches equal the batch; the value counts of a batch are written once."""
    import datetime
    import random
    rng = random.Random(7)
    weeks = [None, *[datetime.date(2024, 1, 1) + datetime.timedelta(days=7 * w) for w in range(5)]]
    rows = [(rng.choice(weeks), rng.choice([None, 3.0, -2.5, rng.uniform(-1, 40), rng.uniform(-1, 40)])) for _ in range(2400)]
    rows += [(datetime.date(2024, 3, 4), None)]                                       # a week without any promise
    promises = spark.createDataFrame(rows, "week date, promise double")
    landing, out = str(tmp_path / "promises"), str(tmp_path / "alerts")
    promises.repartition(8).write.parquet(landing)
    stream = spark.readStream.schema(promises.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    shared = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    got = MON.stream_weekly_alert(stream, out, str(tmp_path / "checkpoint"))
    want = MON.weekly_alert_batch(promises.groupBy("week").agg(F.count(F.lit(1)).alias("orders"), F.median("promise").alias("promise")))
    cols = ["week", "orders", "promise", "trailing", "alert"]
    assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, map(tuple, want.select(*cols).collect())))
    others = [f"{shared}/{x}" for x in set(os.listdir(shared)) - before]
    written = [spark.read.parquet(x).count() for x in others if os.path.exists(f"{x}/_SUCCESS")]
    assert spark.read.parquet(f"{out}/counts").count() + sum(written) < 1.5 * len(rows)


def test_permissive_upload(spark, tmp_path):
    from cargolens.sources.files import read_upload
    p = tmp_path / "up.csv"
    p.write_text("price,freight_value,weight_kg,volume_cm3,seller_state,customer_state,seller_zip_code_prefix\n"
                 "10,5,1,100,SP,RJ,01310\nabc,7,1,100,SP,RJ,01310\n12,,1,100,SP,SP,01310\n")
    rows, rejects, msgs = read_upload(spark, str(p))
    got = rows.orderBy("file_row").select("price", "freight_value", "seller_zip").collect()
    assert [(g.price, g.freight_value, g.seller_zip) for g in got] == [(10.0, 5.0, "01310"), (None, 7.0, "01310")]
    assert rejects.count() == 1 and msgs


def test_upload_requires_columns(spark, tmp_path):
    from cargolens.sources.files import read_upload
    p = tmp_path / "bad.csv"
    p.write_text("price\n1\n")
    with pytest.raises(ValueError):
        read_upload(spark, str(p))


def test_streaming_scoring_equals_batch(spark, tmp_path):
    from cargolens.plans.q_scoring import _states, freight_records
    from cargolens.sources.fixtures import market
    from cargolens.streaming.scoring import run_scoring_stream, score_batch
    m = market(spark, SMOKE)
    rec = freight_records(m)
    landing = str(tmp_path / "landing")
    rec.repartition(3).write.parquet(landing)
    out = str(tmp_path / "out")
    from cargolens.operators.models import Bench, Fitted
    from cargolens.plans.q_models import FS_A
    from cargolens.plans.q_eval import item_split
    bench = Bench(item_split(m)[0], FS_A, "reg_target")
    bench.ridge(10.0).save(spark, str(tmp_path / "model"))
    bench.close()
    model = Fitted.load(spark, str(tmp_path / "model"))
    run_scoring_stream(spark, landing, rec.schema, _states(m), out, str(tmp_path / "ckpt"), model)
    s_scored = spark.read.parquet(os.path.join(out, "scored")).drop("epoch")
    s_rej = spark.read.parquet(os.path.join(out, "rejected")).drop("epoch")
    b_scored, b_rej = score_batch(rec, _states(m), model)
    cols = ["id", "estimate"]
    assert sorted(map(tuple, s_scored.select(*cols).collect())) == sorted(map(tuple, b_scored.select(*cols).collect()))
    assert sorted(map(tuple, s_rej.select("id", "errors").collect())) == sorted(map(tuple, b_rej.select("id", "errors").collect()))
    assert s_scored.count() + s_rej.count() == rec.count()
