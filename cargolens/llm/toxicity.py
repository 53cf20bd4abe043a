"""Toxicity by a linear classifier on character n-grams (naive Bayes features).

* Features: which character n-grams (3 to 6 characters, lower case, within a
  word and its edges) a text has, hashed to 2**20 places.  Whole texts are read.
* Each feature is scaled by its naive Bayes log-count ratio: how much more
  often labelled toxic texts have it than the others.  Smoothing pulls rare
  features to a ratio of 0; those in fewer than ``MIN_TEXTS`` texts, or with a
  ratio below ``MIN_RATIO`` either way, have 0.
* A logistic regression is fitted on the scaled features, divided by the square
  root of the number of features of the text.

The fit uses a bounded sample of the labelled rows (``max_toxic`` and
``max_clean`` of them, chosen by a hash of the id): Spark counts its features,
and the regression, on those that have a ratio, runs in one task.  Scoring
covers every row and is a single pass without a shuffle.

Defined results: a null or empty text has no features and gets the score of the
intercept; labels that are null, or whose document is missing, are ignored, of
several labels of a document the largest counts; with no toxic or no clean
label at all, every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import prepare, shared_table

BITS = 20
SHORTEST, LONGEST = 3, 6
MAX_TOXIC, MAX_CLEAN = 4000, 6000
MIN_TEXTS, MIN_RATIO, SMOOTHING, ROUNDS, STEP = 5, 0.5, 10.0, 100, 1.0
CUT = 0.7
# Texts are read in stretches of this many characters.
STRETCH = 1 << 18
_BLANKS = (9, 10, 11, 12, 13)


def _stretch_features(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    for b in _BLANKS:
        c[c == b] = 32
    blank = c == 32
    blanks = np.concatenate([[0], np.cumsum(blank)])
    out, h = [], c
    for n in range(2, LONGEST + 1):
        if len(c) < n:
            break
        h = (h[:len(c) - n + 1] * np.uint64(0x100000001B3)) ^ c[n - 1:]
        if n >= SHORTEST:
            inner = blanks[n - 1:len(c)] == blanks[1:len(c) - n + 2]      # a blank only at an end
            k = (h[inner] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            out.append((k >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    if not text:
        return np.zeros(0, np.int32)
    text = f" {text.lower()} "
    if len(text) <= STRETCH:
        return np.unique(_stretch_features(text))
    seen = np.zeros(1 << BITS, bool)
    for lo in range(0, len(text), STRETCH):
        seen[_stretch_features(text[lo:lo + STRETCH + LONGEST - 1])] = True
    return np.flatnonzero(seen).astype(np.int32)


def fit(sets: list[np.ndarray], sizes: np.ndarray, toxic: np.ndarray, ratio: np.ndarray, odds: float) -> tuple[np.ndarray, float]:
    """Weights by feature and the intercept.  ``sets`` hold the features with a ratio, ``sizes`` how many a text has in
    all; ``odds`` are those of a toxic label among all labelled rows (the sample may hold more)."""
    y = toxic.astype(np.float64)
    rows = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    used, cols = np.unique(np.concatenate(sets), return_inverse=True)
    cols = cols.ravel().astype(np.int32)
    x = (ratio[used][cols] / np.sqrt(np.maximum(sizes, 1))[rows]).astype(np.float32)
    prior = np.log(y.sum() / (len(y) - y.sum()))
    w, b = np.zeros(len(used), np.float32), prior
    seen, seen_b = np.full(len(used), 1e-8), 1e-8
    for _ in range(ROUNDS):
        z = np.bincount(rows, x * w[cols], len(y)) + b
        error = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)).astype(np.float32)
        g, gb = np.bincount(cols, x * error[rows], len(used)), float(error.sum())
        seen += g * g
        seen_b += gb * gb
        w -= (STEP * g / np.sqrt(seen)).astype(np.float32)
        b -= STEP * gb / np.sqrt(seen_b)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = w * ratio[used]
    return weights, float(b + np.log(odds) - prior)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> tuple[np.ndarray, float]:
    """Fit on the labelled rows of ``docs``; returns weights and intercept (both bounded)."""
    prepare(docs.sparkSession)
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_y")))
    n = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("_y") == 1).cast("long")), F.lit(0)).alias("toxic")).first()
    none = np.zeros(1 << BITS, np.float32)
    if not 0 < n["toxic"] < n["n"]:
        share = n["toxic"] / n["n"] if n["n"] else 0.0
        return none, float(np.log(max(share, 1e-13) / max(1 - share, 1e-13)))
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = (known.filter(F.col("_y") == 1).orderBy(*order).limit(max_toxic)
              .unionByName(known.filter(F.col("_y") != 1).orderBy(*order).limit(max_clean)))
    # at most max_toxic + max_clean rows: a bounded broadcast, and the texts stay where they are
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).join(
        F.broadcast(picked), F.col("_doc") == F.col("_id")).select("_id", (F.col("_y") == 1).alias("toxic"), "text")
    odds = n["toxic"] / (n["n"] - n["toxic"])

    id_type = rows.schema["_id"].dataType.simpleString()

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([features(t) for t in b.column(2).to_pylist()], pa.list_(pa.int32()))],
                ["_id", "toxic", "features"])

    sets = shared_table(rows.mapInArrow(sets_of, f"_id {id_type}, toxic boolean, features array<int>"), "features")
    had = sets.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0)).alias("p")).first()
    if not 0 < had["p"] < had["n"]:                  # the labelled documents in the table are of one kind, or none
        share = n["toxic"] / n["n"]
        return none, float(np.log(share / (1 - share)))
    prior, n1, n0 = had["p"] / had["n"], had["p"], had["n"] - had["p"]
    p, q = F.col("p"), F.col("n") - F.col("p")
    ratio = (F.log((p + SMOOTHING * prior) / F.lit(n1 + SMOOTHING * prior))
             - F.log((q + SMOOTHING * (1 - prior)) / F.lit(n0 + SMOOTHING * (1 - prior))))
    counted = (sets.select("toxic", F.explode("features").alias("f")).groupBy("f")
               .agg(F.sum(F.col("toxic").cast("long")).alias("p"), F.count(F.lit(1)).alias("n"))
               .filter(F.col("n") >= MIN_TEXTS).select("f", ratio.alias("r")).filter(F.abs("r") >= MIN_RATIO))
    table_ = counted.toPandas()                      # at most one row a feature, 2**BITS
    ratios = np.zeros(1 << BITS, np.float32)
    ratios[table_["f"].to_numpy()] = table_["r"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has = shared.value != 0
        for b in batches:
            each = b.column(2)
            flat, at = each.flatten().to_numpy(), each.offsets.to_numpy()
            at = at - at[0]
            out = [f[has[f]] for f in (flat[lo:hi] for lo, hi in zip(at, at[1:]))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(at), pa.int32()),
                                              pa.array(out, pa.list_(pa.int32()))], ["_id", "toxic", "size", "features"])

    def fit_all(t: pa.Table) -> pa.Table:
        t = t.sort_by("_id")
        each = t.column("features").combine_chunks()
        flat, at = each.flatten().to_numpy(), each.offsets.to_numpy()
        at = at - at[0]
        w, b = fit([flat[lo:hi] for lo, hi in zip(at, at[1:])], t.column("size").to_numpy(), t.column("toxic").to_numpy().astype(bool),
                   shared.value, odds)
        used = np.flatnonzero(w)
        return pa.table({"feature": pa.array(np.append(used, -1), pa.int32()),
                         "weight": pa.array(np.append(w[used].astype(np.float64), b), pa.float64())})

    kept = sets.mapInArrow(keep, f"_id {id_type}, toxic boolean, size int, features array<int>")
    model = kept.groupBy(F.lit(0).alias("_all")).applyInArrow(fit_all, "feature int, weight double").toPandas()
    weights = none.copy()
    at = model["feature"].to_numpy()
    weights[at[at >= 0]] = model["weight"].to_numpy()[at >= 0]
    bias = float(model["weight"].to_numpy()[at < 0][0])
    return weights, bias


def score(df: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", alias: str = "score") -> DataFrame:
    """All columns of ``df`` and the score of each whole text (in place of a column of that name)."""
    spark = df.sparkSession
    prepare(spark)
    weights, bias = model
    shared = spark.sparkContext.broadcast(weights)                  # 4 MB, whatever the corpus
    df = df.drop(alias)
    names = [*df.columns, alias]
    at = df.columns.index(text_col)
    schema = StructType(list(df.schema.fields)).add(alias, "double")

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            out = []
            for t in b.column(at).to_pylist():
                f = features(t)
                z = bias + (float(w[f].sum(dtype=np.float64)) / np.sqrt(len(f)) if len(f) else 0.0)
                out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], names)

    return df.mapInArrow(scores, schema)


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))
