"""Semantics traps on hand-made rows."""
import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from cargolens.functions.columns import cut, floor_days, haversine_km, late_flag, nan_max, r, ratio
from cargolens.functions.geo import normalise_zip, region_of


def test_floor_days_and_late_flag(spark):
    t0 = dt.datetime(2020, 1, 10, 0, 0)
    rows = [(t0 - dt.timedelta(hours=12), t0),          # half a day early -> -1
            (t0 + dt.timedelta(hours=23), t0),          # later on the promised day -> 0, not late
            (t0 + dt.timedelta(days=1, seconds=1), t0),  # the next day -> 1, late
            (None, t0)]                                 # undelivered -> null days, not late
    df = spark.createDataFrame(rows, "d timestamp, e timestamp")
    out = df.select(floor_days("d", "e").alias("k"), late_flag(floor_days("d", "e")).alias("late")).collect()
    assert [x.k for x in out] == [-1, 0, 1, None]
    assert [x.late for x in out] == [False, False, True, False]


def test_cut_closings_and_outside_edges(spark):
    df = spark.createDataFrame([(0.0,), (30.0,), (30.5,), (500.0,), (-1.0,), (None,)], "x double")
    right = [x.b for x in df.select(cut("x", [0, 30, 500], ["a", "b"], right=True).alias("b")).collect()]
    left = [x.b for x in df.select(cut("x", [0, 30, 500], ["a", "b"], right=False).alias("b")).collect()]
    assert right == [None, "a", "b", "b", None, None]
    assert left == ["a", "b", "b", None, None, None]


def test_ratio_nan_max_and_rounding(spark):
    df = spark.createDataFrame([(5.0, 0.0, None), (5.0, 2.0, 1.0)], "a double, b double, c double")
    out = df.select(ratio("a", "b").alias("q"), nan_max("b", "c").alias("m"), F.greatest("b", "c").alias("g")).collect()
    assert out[0].q is None and out[1].q == 2.5
    assert out[0].m is None and out[0].g == 0.0           # greatest skips nulls, NumPy maximum does not
    vals = [2.5, 0.125, 1.005, 2.675, -0.5, 123.456789, 0.0]
    got = [x.v for x in spark.createDataFrame([(v,) for v in vals], "x double").select(r("x", 2).alias("v")).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]   # NumPy / pandas rounding, half to even


def test_haversine(spark):
    df = spark.createDataFrame([(-23.55, -46.63, -22.91, -43.17)], "a double, b double, c double, d double")
    km = df.select(haversine_km("a", "b", "c", "d").alias("k")).first().k
    assert math.isclose(km, 361.0, rel_tol=0.01)


def test_zip_normalisation(spark):
    cases = ["01310-100", "01310", "1310", "01310100", "1310100", "999", "123456", "", None, "abc"]
    df = spark.createDataFrame([(c,) for c in cases], "z string")
    z, e = normalise_zip("z")
    out = df.select(z.alias("zip"), e.alias("err")).collect()
    assert [o.zip for o in out] == ["01310", "01310", "01310", "01310", "01310", None, None, None, None, None]
    assert out[5].err is not None and out[6].err is not None and out[9].err is not None
    assert out[7].err is None and out[8].err is None


def test_region_map(spark):
    df = spark.createDataFrame([("SP",), ("RJ",), ("XX",)], "s string")
    assert [x.r for x in df.select(region_of("s").alias("r")).collect()] == ["São Paulo", "Rest of Southeast", None]
