"""Model families, fitted on one preprocessing per (rows, inputs) (MDL-1..9).

A :class:`Bench` holds the training rows of one fold and one feature set.  Its
vectors are made once for linear models and once for trees, and every model and
every candidate of a search is fitted on them.  Iterative solvers start a Spark
job a step, so small training sets are coalesced to few partitions
(``ROWS_PER_TASK``); large ones keep theirs.  Ridge regressions of any number of
penalties come from one pass (:meth:`Bench.ridge_path`).  Trees and forests grow
in parallel tasks to any depth (:mod:`.forest`) while the training set, or its
codes, are within ``forest.SIDE_BYTES``; a larger one goes to MLlib's row-parallel forests, with
its node-id cache, where an unlimited depth stands as MLlib's largest, 30.
"""

from __future__ import annotations

import json
import math
import threading
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark import StorageLevel
from pyspark.ml.classification import (DecisionTreeClassificationModel, DecisionTreeClassifier, LogisticRegression,
                                       LogisticRegressionModel, RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressionModel, DecisionTreeRegressor, LinearRegression, LinearRegressionModel,
                                   RandomForestRegressionModel, RandomForestRegressor)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import forest as grown
from .evaluation import hash_fold
from .prep import FeatureSet, Prep, fit_prep

ROWS_PER_TASK = 50_000
SEED = 42
MAX_DEPTH = 30                           # the largest that MLlib has
READERS = {m.__name__: m for m in (LogisticRegressionModel, DecisionTreeClassificationModel, RandomForestClassificationModel,
                                   LinearRegressionModel, DecisionTreeRegressionModel, RandomForestRegressionModel)}


@dataclass
class Fitted:
    """A model with the preprocessing it was fitted on."""
    prep: Prep
    model: object
    classifies: bool
    info: dict

    def score(self, df: DataFrame, name: str) -> DataFrame:
        """Predicted value, or probability of the positive class, as ``name``."""
        out = self.model.transform(self.prep.transform(df))
        if isinstance(self.model, grown.Forest):
            return out.withColumn(name, F.col("prediction")).drop(*[c for c in ("features", "prediction") if c != name])
        value = vector_to_array(F.col("probability")).getItem(1) if self.classifies else F.col("prediction")
        return out.withColumn(name, value).drop("features", "rawPrediction", "probability", "prediction")

    def save(self, spark: SparkSession, path: str) -> None:
        """MDL-9: preprocessing, model and metadata in one folder."""
        self.prep.save(spark, f"{path}/prep")
        meta = {"model": type(self.model).__name__, "classifies": self.classifies, "info": self.info}
        if isinstance(self.model, grown.Forest):
            self.model.save(spark, f"{path}/model")
            meta |= {"categorical": self.model.categorical, "trees": self.model.trees}
        else:
            self.model.write().overwrite().save(f"{path}/model")
        spark.range(1).select(F.lit(json.dumps(meta)).alias("value")).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Fitted:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        model = (grown.Forest(f"{path}/model", meta["categorical"], meta["trees"]) if "categorical" in meta
                 else READERS[meta["model"]].load(f"{path}/model"))
        return cls(Prep.load(spark, f"{path}/prep"), model, meta["classifies"], meta["info"])


@dataclass
class Linear:
    """A linear model as plain numbers (inputs bounded by the levels of the preprocessing)."""
    coefficients: object
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        terms = F.zip_with(vector_to_array(F.col("features")), F.array(*[F.lit(float(c)) for c in self.coefficients.toArray()]), lambda a, b: a * b)
        return df.withColumn("prediction", F.lit(self.intercept) + F.aggregate(terms, F.lit(0.0), lambda a, b: a + b))


class Bench:
    """Training rows, inputs and target of one problem; fits any family on them."""

    def __init__(self, train: DataFrame, fs: FeatureSet, y: str):
        self.train, self.fs, self.y = train, fs, y
        self._made: dict[bool, tuple] = {}
        self._moments: tuple | None = None
        self._side: str | None = None
        self._forests: dict[tuple, grown.Forest] = {}
        self._size: tuple | None = None
        self._writing = threading.Lock()                     # several fits begin at a time
        self._growing = threading.Lock()

    def vectors(self, linear: bool) -> tuple[Prep, DataFrame, int, float]:
        """(preprocessing, vectors with label and balanced weight, rows, standard deviation of the label)."""
        if linear not in self._made:
            prep, x = fit_prep(self.train, self.fs, self.y, linear, like=self._made.get(not linear, (None,))[0])
            label = F.col(self.y).cast("double")
            x = x.select("features", label.alias("label"))
            if self._size is None:
                self._size = self.train.agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate"), F.stddev_pop(label).alias("sd")).first()
            got = self._size
            rate = min(max(float(got["rate"] or 0.0), 1e-9), 1 - 1e-9)
            x = x.withColumn("w", F.when(F.col("label") == 1, F.lit(0.5 / rate)).otherwise(F.lit(0.5 / (1 - rate))))
            parts = max(1, math.ceil(got["n"] / ROWS_PER_TASK))
            x = x.coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK)        # for the fits; see close()
            self._made[linear] = prep, x, got["n"], float(got["sd"] or 0.0)
        return self._made[linear]

    def close(self) -> None:
        for _, x, _, _ in self._made.values():
            x.unpersist()
        self._made.clear()

    def _fit(self, est, linear: bool, classifies: bool, info: dict) -> Fitted:
        prep, x, _, _ = self.vectors(linear)
        return Fitted(prep, est.fit(x), classifies, info)

    # ---- freight (regression)
    def ridge(self, alpha: float) -> Fitted:
        """Squared loss + alpha |w|^2, closed form.  MLlib averages the loss over rows and measures the penalty in
        standard deviations of the label: regParam = alpha sd / n."""
        _, _, n, sd = self.vectors(True)
        est = LinearRegression(regParam=alpha * sd / n, elasticNetParam=0.0, standardization=False, solver="normal")
        return self._fit(est, True, False, {"alpha": alpha})

    def moments(self) -> tuple[np.ndarray, int]:
        """(X, 1, y)' (X, 1, y) and the number of rows: sums over partitions, one pass."""
        if self._moments is None:
            _, x, n, _ = self.vectors(True)

            def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total = None
                for b in batches:
                    v = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                    z = np.column_stack([v, np.ones(len(v)), b.column(1).to_numpy()])
                    total = z.T @ z if total is None else total + z.T @ z
                if total is not None:
                    flat = total.ravel()
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int64()), pa.array(flat)], ["i", "v"])
            parts = x.select(vector_to_array(F.col("features")).alias("f"), "label").mapInArrow(sums, "i long, v double")
            got = parts.groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()      # the inputs' number squared
            flat = np.array([r["v"] for r in got])
            size = math.isqrt(len(flat))
            self._moments = flat.reshape(size, size), n
        return self._moments

    def ridge_path(self, alphas: Sequence[float]) -> list[Fitted]:
        """The closed-form ridge regression of every penalty, from one pass over the rows."""
        prep = self.vectors(True)[0]
        z, n = self.moments()
        d, out = len(z) - 2, []
        mean, my = z[d, :d] / n, z[d, d + 1] / n
        xx, xy = z[:d, :d] - n * np.outer(mean, mean), z[:d, d + 1] - n * mean * my
        for a in alphas:
            w = np.linalg.lstsq(xx + a * np.eye(d), xy, rcond=None)[0]
            out.append(Fitted(prep, Linear(Vectors.dense(w), float(my - mean @ w)), False, {"alpha": a}))
        return out

    def side(self) -> tuple[str | None, dict[int, int]]:
        """Where tasks find the whole training set (None: too large for that), and the levels of categorical slots."""
        prep, x, n, _ = self.vectors(False)
        fs = prep.fs
        numbers = len(fs.num) + len(prep.missing) + len(fs.te)
        levels = {numbers + k: len(prep.levels[c]) + 1 for k, c in enumerate(fs.cat)}
        inputs = numbers + len(levels)
        if (inputs + 4) * 2 * n > grown.SIDE_BYTES:
            return None, levels
        with self._writing:
            if self._side is None:
                self._side = grown.side_table(x, inputs, (inputs + 1) * 8 * n <= grown.SIDE_BYTES)
        return self._side, levels

    def _grown(self, classifies: bool, trees: int, leaf: int, share, depth, class_weight, bootstrap: bool, info: dict) -> Fitted | None:
        side, levels = self.side()
        if side is None:
            return None
        prep, x = self.vectors(False)[:2]
        key = leaf, share, depth, class_weight, bootstrap
        with self._growing:                                  # a tree depends on its number: a smaller forest begins a larger one
            if key not in self._forests or self._forests[key].trees < trees:
                self._forests[key] = grown.grow_forest(x.sparkSession, side, levels, trees, leaf, share, depth, class_weight, bootstrap, SEED)
            return Fitted(prep, self._forests[key].first(trees), classifies, info)

    def tree_regressor(self) -> Fitted:
        est = DecisionTreeRegressor(maxDepth=MAX_DEPTH, minInstancesPerNode=5, maxBins=self._bins(), cacheNodeIds=True, seed=SEED)
        return self._grown(False, 1, 5, 1.0, None, None, False, {}) or self._fit(est, False, False, {})

    def forest_regressor(self, trees: int = 200, leaf: int = 5, share: float | str = 0.5, depth: int | None = None) -> Fitted:
        info = {"trees": trees, "leaf": leaf, "share": share, "depth": depth}
        est = RandomForestRegressor(numTrees=trees, maxDepth=depth or MAX_DEPTH, minInstancesPerNode=leaf, featureSubsetStrategy=str(share),
                                    maxBins=self._bins(), maxMemoryInMB=512, cacheNodeIds=True, checkpointInterval=5, seed=SEED)
        return self._grown(False, trees, leaf, share, depth, None, True, info) or self._fit(est, False, False, info)

    # ---- late delivery (classification)
    def logistic(self, c: float | None, balanced: bool = False) -> Fitted:
        """Plain (``c`` None) or L2 logistic regression (regParam = 1 / (C n))."""
        n = self.vectors(True)[2]
        est = LogisticRegression(regParam=0.0 if c is None else 1.0 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=200)
        if balanced:
            est = est.setWeightCol("w")
        return self._fit(est, True, True, {"C": c, "class_weight": "balanced" if balanced else None})

    def tree_classifier(self) -> Fitted:
        est = DecisionTreeClassifier(maxDepth=MAX_DEPTH, minInstancesPerNode=20, maxBins=self._bins(), cacheNodeIds=True, seed=SEED)
        return self._grown(True, 1, 20, 1.0, None, None, False, {}) or self._fit(est, False, True, {})

    def forest_classifier(self, trees: int = 200, leaf: int = 20, share: float | str = "sqrt", depth: int | None = None,
                          class_weight: str | None = "balanced") -> Fitted:
        """``class_weight``: None, "balanced", or "balanced_subsample" (over the rows that a tree drew; MLlib, which weighs rows
        before it draws, takes the balanced weights for it)."""
        info = {"trees": trees, "leaf": leaf, "share": share, "depth": depth, "class_weight": class_weight}
        est = RandomForestClassifier(numTrees=trees, maxDepth=depth or MAX_DEPTH, minInstancesPerNode=leaf, featureSubsetStrategy=str(share),
                                     maxBins=self._bins(), maxMemoryInMB=512, cacheNodeIds=True, checkpointInterval=5, seed=SEED)
        if class_weight:
            est = est.setWeightCol("w")
        return self._grown(True, trees, leaf, share, depth, class_weight, True, info) or self._fit(est, False, True, info)

    def _bins(self) -> int:
        """Tree bins: at least the levels of any pooled categorical input."""
        return max(32, self.vectors(False)[0].max_levels + 1)


def stacked(train: DataFrame, fs: FeatureSet, frames: list[DataFrame], keys: list[str], alpha: float, forest: dict,
            folds: int = 3, group: str = "order_id", y: str = "reg_target", base: Bench | None = None) -> list[DataFrame]:
    """MDL-6: ridge and forest, out-of-fold over ``folds`` groups of orders, into a final ridge (alpha 1).
    Returns, for each of ``frames``, its keys and ``pred_log``.  ``base``: the bench of ``train``, if there is one."""
    def both(bench: Bench, df: DataFrame) -> DataFrame:
        scored = bench.ridge(alpha).score(df, "p_ridge")
        return bench.forest_regressor(**forest).score(scored, "p_forest")

    rows, oof = train.withColumn("_fold", hash_fold(group, folds)), None
    benches = []
    for f in range(folds):
        bench = Bench(rows.filter(F.col("_fold") != f), fs, y)
        part = both(bench, rows.filter(F.col("_fold") == f)).select("p_ridge", "p_forest", F.col(y).alias("label"))
        oof = part if oof is None else oof.unionByName(part)
        benches.append(bench)
    assemble = VectorAssembler(inputCols=["p_ridge", "p_forest"], outputCol="features")
    inner = assemble.transform(oof).persist(StorageLevel.MEMORY_AND_DISK)
    size = inner.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("sd")).first()
    final = LinearRegression(regParam=float(size["sd"] or 0.0) / max(1, size["n"]), elasticNetParam=0.0, standardization=False, solver="normal").fit(inner)
    inner.unpersist()
    for b in benches:
        b.close()
    bench = base or Bench(train, fs, y)
    fits = bench.ridge(alpha), bench.forest_regressor(**forest)
    out = [final.transform(assemble.transform(fits[1].score(fits[0].score(df, "p_ridge"), "p_forest"))).select(
        *keys, F.col("prediction").alias("pred_log")) for df in frames]
    if base is None:
        bench.close()
    return out
