"""Feature preprocessing fitted on training rows only (PRE-1..6).

* PRE-1 medians (exact, see :func:`ranking.exact_quantiles`) for missing
  numbers, and an indicator for each number that is missing in training.
* PRE-2 for linear models: log1p of the skewed numbers, then numbers (with
  their indicators) centred and divided by the population standard deviation.
* PRE-3 levels with fewer than ``min_frequency`` training rows, and unseen
  ones, share one pooled slot; the others are one-hot slots (linear models) or
  categories of one column (trees).
* PRE-4 target encoding, cross-fitted on the training rows by a hash of the
  order, with the statistics of all training rows elsewhere.

Everything learnt is a plain value (numbers and level lists, bounded by
``MAX_LEVELS``) or, for the encodings, a written table; it can be saved and
loaded (MDL-9), and applying it never looks at training rows again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from .evaluation import hash_fold
from .ranking import attach, exact_quantiles

MAX_LEVELS = 10_000
# The skewed numeric inputs.
SKEWED = ("weight_kg", "volume_cm3", "chargeable_kg", "distance_km", "price", "price_total", "freight_total",
          "seller_load_7d")


@dataclass
class FeatureSet:
    """Numeric, categorical and target-encoded inputs of one model."""
    num: list[str]
    cat: list[str] = field(default_factory=list)
    te: list[str] = field(default_factory=list)

    @property
    def inputs(self) -> list[str]:
        return list(dict.fromkeys(self.num + self.cat + self.te))

    def merge(self, other: FeatureSet) -> FeatureSet:
        return FeatureSet(*[list(dict.fromkeys(a + b)) for a, b in ((self.num, other.num), (self.cat, other.cat), (self.te, other.te))])


def target_encoding(train: DataFrame, col: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """PRE-4: (level, enc), the level mean shrunk toward the overall mean,
    enc = (n mean_c + m mean) / (n + m) with m = var_c / var (``smooth='auto'``).

    With ``keys`` (a fold column of ``train``) the encoding is cross-fitted: the
    rows of a fold get the statistics of the other folds, from one aggregation
    (all folds' sums minus the own fold's)."""
    keys = list(keys)
    level = F.col(col).cast("string").alias("level")
    sums = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"), F.sum(F.col(y) * F.col(y)).alias("q")]
    own = train.groupBy(*keys, level).agg(*sums)
    if not keys:
        stats = attach(own, train.agg(*[a.alias(f"t{k}") for a, k in zip(sums, "nsq")]))
    else:
        every = own.groupBy("level").agg(*[F.sum(k).alias(f"_{k}") for k in "nsq"])
        fold = train.groupBy(*keys).agg(*[a.alias(f"f{k}") for a, k in zip(sums, "nsq")])
        total = train.agg(*[a.alias(f"a{k}") for a, k in zip(sums, "nsq")])
        # a level that only the own fold has gets the mean of the other folds
        stats = attach(own.join(every, "level").join(F.broadcast(fold), keys), total).select(
            *keys, "level", *[(F.col(f"_{k}") - F.col(k)).alias(k) for k in "nsq"],
            *[(F.col(f"a{k}") - F.col(f"f{k}")).alias(f"t{k}") for k in "nsq"])
    mean = F.col("ts") / F.col("tn")
    var = F.greatest(F.col("tq") / F.col("tn") - mean * mean, F.lit(0.0))
    var_c = F.greatest(F.try_divide(F.col("q"), F.col("n")) - F.pow(F.try_divide(F.col("s"), F.col("n")), F.lit(2)), F.lit(0.0))
    m = F.coalesce(F.try_divide(var_c, var), F.lit(0.0))
    enc = F.when(F.col("n") > 0, F.try_divide(F.col("s") + m * mean, F.col("n") + m)).otherwise(mean)
    return stats.select(*keys, "level", enc.alias("enc"))


@dataclass
class Prep:
    """Fitted preprocessing (PRE-6): apply with :meth:`transform`."""
    fs: FeatureSet
    linear: bool
    medians: dict[str, float]
    missing: list[str]
    centre: dict[str, float]
    spread: dict[str, float]
    levels: dict[str, list[str]]
    prior: float
    encodings: dict[str, DataFrame] = field(default_factory=dict)

    def _raw(self, c: str):
        v = F.coalesce(F.col(c).cast("double"), F.lit(self.medians[c]))
        return F.log1p(F.greatest(v, F.lit(0.0))) if self.linear and c in SKEWED else v

    def _scaled(self, name: str, v):
        return (v - F.lit(self.centre[name])) / F.lit(self.spread[name]) if self.linear and name in self.centre else v

    def numbers(self) -> dict:
        """Unscaled numeric columns by slot name."""
        out = {c: self._raw(c) for c in self.fs.num}
        return out | {f"{c}__missing": F.col(c).isNull().cast("double") for c in self.missing}

    def _encoded(self, df: DataFrame, tables: dict[str, DataFrame], keys: Sequence[str] = ()) -> DataFrame:
        for c in self.fs.te:
            t = tables[c].select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("level").alias("_level"), F.col("enc").alias(f"_enc_{c}"))
            on = F.col(c).cast("string") == F.col("_level")
            for k in keys:
                on = on & (F.col(k) == F.col(f"_k_{k}"))
            df = df.join(t, on, "left").drop("_level", *[f"_k_{k}" for k in keys])
            df = df.withColumn(f"_enc_{c}", F.coalesce(f"_enc_{c}", F.lit(self.prior)))
        return df

    @property
    def max_levels(self) -> int:
        return max([len(v) + 1 for v in self.levels.values()], default=0)

    def _assemble(self, df: DataFrame) -> DataFrame:
        """Vectors from a frame that has its encodings; slots keep the names of their inputs."""
        names = {f"n__{k}": self._scaled(k, v) for k, v in self.numbers().items()}
        names |= {f"n__{c}": self._scaled(c, F.col(f"_enc_{c}")) for c in self.fs.te}
        out = df.withColumns(names).drop(*[f"_enc_{c}" for c in self.fs.te])
        slots = list(names)
        if self.fs.cat:
            out = out.withColumns({f"_s_{c}": F.col(c).cast("string") for c in self.fs.cat})
            for c in self.fs.cat:                          # the pooled level is the last index
                out = StringIndexerModel.from_labels(self.levels[c], f"_s_{c}", f"i__{c}", handleInvalid="keep").transform(out)
            drop = [f"_s_{c}" for c in self.fs.cat]
            if self.linear:
                hot = OneHotEncoder(inputCols=[f"i__{c}" for c in self.fs.cat], outputCols=[f"h__{c}" for c in self.fs.cat],
                                    dropLast=False).fit(out)                       # sizes come from the labels, no job
                out = hot.transform(out)
                slots += [f"h__{c}" for c in self.fs.cat]
                drop += [f"i__{c}" for c in self.fs.cat]
            else:
                slots += [f"i__{c}" for c in self.fs.cat]
            out = out.drop(*drop)
        out = VectorAssembler(inputCols=slots, outputCol="features", handleInvalid="error").transform(out)
        return out.drop(*[s for s in slots if s in out.columns])

    def transform(self, df: DataFrame) -> DataFrame:
        return self._assemble(self._encoded(df, self.encodings))

    def save(self, spark: SparkSession, path: str) -> None:
        """Values as one JSON line, encodings as Parquet tables."""
        values = {k: v for k, v in self.__dict__.items() if k not in ("fs", "encodings")} | {"fs": asdict(self.fs)}
        spark.range(1).select(F.lit(json.dumps(values)).alias("value")).write.mode("overwrite").text(f"{path}/values")
        for c, t in self.encodings.items():
            t.write.mode("overwrite").parquet(f"{path}/encoding_{c}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Prep:
        values = json.loads(spark.read.text(f"{path}/values").first()[0])
        fs = FeatureSet(**values.pop("fs"))
        return cls(fs=fs, **values, encodings={c: spark.read.parquet(f"{path}/encoding_{c}") for c in fs.te})


def slot_inputs(df: DataFrame, fs: FeatureSet, vector: str = "features") -> list[str]:
    """The input column behind each vector slot, from the slot names that the
    assembler keeps; a vector without names is an error."""
    attrs = df.schema[vector].metadata.get("ml_attr", {}).get("attrs")
    if not attrs:
        raise ValueError(f"{vector} has no slot names")
    slots = sorted((a for group in attrs.values() for a in group), key=lambda a: a["idx"])
    out = []
    for a in slots:
        name = a["name"].split("__", 1)[1]
        found = [c for c in fs.inputs if name == c or name.startswith((f"{c}__", f"{c}_"))]
        if not found:
            raise ValueError(f"slot {a['name']} belongs to no input")
        out.append(max(found, key=len))
    return out


def fit_prep(train: DataFrame, fs: FeatureSet, y: str, linear: bool, min_frequency: int = 20,
             folds: int = 5, group: str = "order_id", like: Prep | None = None) -> tuple[Prep, DataFrame]:
    """Fit on ``train``; returns the fitted preprocessing and the training rows
    with their vectors (target encodings cross-fitted over ``folds``).  ``like``:
    one fitted on the same rows and inputs, whose medians and levels are taken."""
    prep = (replace(like, linear=linear, centre={}, spread={}) if like is not None and not fs.te else
            _learnt(train, fs, y, linear, min_frequency))
    rows = train
    if fs.te:
        rows = train.withColumn("_fold", hash_fold(group, folds))
        crossed = {c: stored(target_encoding(rows, c, y, ["_fold"]), "encoding") for c in fs.te}
        prep.encodings = {c: stored(target_encoding(train, c, y), "encoding") for c in fs.te}
        rows = prep._encoded(rows, crossed, ["_fold"]).drop("_fold")
    if linear:
        values = prep.numbers() | {c: F.col(f"_enc_{c}") for c in fs.te}
        s = rows.agg(*[f(v).alias(f"{n}__{k}") for k, v in values.items() for n, f in (("avg", F.avg), ("sd", F.stddev_pop))]).first()
        prep.centre = {k: float(s[f"avg__{k}"] or 0.0) for k in values}
        prep.spread = {k: float(s[f"sd__{k}"] or 0.0) or 1.0 for k in values}
    return prep, prep._assemble(rows)


def _learnt(train: DataFrame, fs: FeatureSet, y: str, linear: bool, min_frequency: int) -> Prep:
    """Medians, missing numbers, levels and the mean of ``y``."""
    med = exact_quantiles(train, {c: (c, 0.5) for c in fs.num}).first() if fs.num else None
    lost = train.agg(F.avg(F.col(y).cast("double")).alias("_prior"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in fs.num]).first()
    medians = {c: float(med[c]) if med is not None and med[c] is not None else 0.0 for c in fs.num}
    levels = {c: [] for c in fs.cat}
    if fs.cat:
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("level")) for c in fs.cat]))
        counted = (train.select(each.alias("e")).filter(F.col("e.level").isNotNull()).groupBy("e.c", "e.level")
                   .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_frequency).limit(MAX_LEVELS + 1).collect())
        if len(counted) > MAX_LEVELS:
            raise ValueError(f"more than {MAX_LEVELS} levels: encode them by their target instead")
        for row in sorted(counted, key=lambda x: (x["c"], -x["n"], x["level"])):
            levels[row["c"]].append(row["level"])
    return Prep(fs, linear, medians, [c for c in fs.num if lost[c]], {}, {}, levels, float(lost["_prior"] or 0.0))
