"""Forests grown tree by tree in parallel tasks (MDL-4, MDL-5).

Trees of unlimited depth are out of reach for a trainer that merges statistics
of every bin of every node over all partitions, a level a job.  A training set
whose size is checked (``SIDE_BYTES``) is written once to the shared folder
instead (:func:`side_table`); each executor reads it as a side input, the way a
join reads the side that is broadcast, and its tasks grow trees on bootstrap
samples of their own, to any depth.  Values are written as codes, their places
among the input's distinct values: every split point is kept.  Only in a set
that exceeds the limit as doubles, an input with more than ``MOST_VALUES``
distinct values has up to ``BINS`` bins of about equally many rows.  A training
set whose codes are larger too goes to MLlib's row-parallel forests (see
:meth:`Bench.forest_regressor`).

Trees grow in the JVM (``Grower.java``, see :mod:`.jvm`): its tasks share a
copy of the training set.  :func:`grow_tree` has the same steps in NumPy; the
tests hold it against brute force and the Java trees against it.

A forest of at most ``HEAP_SHARE`` of an executor's heap is applied in the JVM,
one copy for its tasks.  A larger one is applied in Python: tasks gather rows
(``ROWS_AT_ONCE``) and read the trees one file at a time (all trees at once up
to ``FOREST_NODES``).

Splits: a number is compared with a threshold between two neighbouring values;
a categorical input sends one level to the left, like a threshold on its one-hot
slot, and each of its levels counts as a slot when inputs are drawn for a node.
The criterion is the reduction of squared error, which for labels 0 and 1 is
that of the Gini index.  Rows are put in an order of their own values before
they are drawn, and draws are hashes of the seed, the tree and the way to the
node, so a forest depends on its rows and seed alone, not on the layout of the
cluster.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import lru_cache
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_package
from .jvm import heap, map_partitions, with_column

SIDE_BYTES = 256 << 20                   # training sets that an executor may read whole
MOST_VALUES, BINS = 1 << 16, 1 << 12     # of an input in a set of that size as codes only
BLOCKS = 32                              # of a training set; their order is that of its rows
FOREST_NODES, ROWS_AT_ONCE = 4_000_000, 400_000
HEAP_SHARE, NODE_BYTES = 0.15, 16
# a tree a row: inputs (-1: a leaf), left children (the right one is next), and thresholds or values of leaves
TREES = "tree int, nodes int, feature binary, child binary, number binary"
STEP, MORE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def _place(path: str) -> tuple[str, object]:
    """A folder of the shared storage as Arrow sees it inside a task: its path and file system (None: local)."""
    if urlsplit(path).scheme in ("", "file"):
        return urlsplit(path).path, None
    from pyarrow import fs
    where, root = fs.FileSystem.from_uri(path)
    return root, where


def _read(path: str, columns: list[str] | None = None) -> pa.Table:
    """A table of the shared folder, read inside a task."""
    root, where = _place(path)
    return pq.read_table(root, columns=columns, filesystem=where)


def _matrix(column) -> np.ndarray:
    """Arrays of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _training_set(path: str) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], frozenset[int]]:
    """Labels in the order of the training set; each input's distinct values (or upper ends of bins), and the rows' places
    among them; the inputs with bins."""
    values, bins = _code_values(path)
    blocks = sorted(_read(f"{path}/rows").to_pylist(), key=lambda b: b["block"])
    y = np.concatenate([np.frombuffer(b["labels"], "<f8") for b in blocks])
    codes = np.concatenate([np.frombuffer(b["codes"], _code_type(values)).reshape(b["n"], -1) for b in blocks])
    return y, values, list(codes.T), bins


def _first_of(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _best(node: np.ndarray, gain: np.ndarray, n_nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """For each node its largest gain (-inf without any) and the place of it."""
    top, at = np.full(n_nodes, -np.inf), np.full(n_nodes, -1, np.int64)
    if len(node):
        first = _first_of(node)
        most = np.maximum.reduceat(gain, first)
        top[node[first]] = most
        hit = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(first, len(node)))))
        at[node[hit[::-1]]] = hit[::-1]                      # the first of equal ones
    return top, at


def _sorted_places(key: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """``key`` (from 0 to ``most``) in order, and where each came from; equal ones stay in order."""
    bits = len(key).bit_length()
    if most >> (62 - bits):
        order = np.argsort(key, kind="stable")
        return key[order], order
    both = (key.astype(np.int64) << bits) | np.arange(len(key))        # sorting numbers is faster than sorting places
    both.sort()
    return both >> bits, both & ((1 << bits) - 1)


def _items(node: np.ndarray, code: np.ndarray, w: np.ndarray, wy: np.ndarray, n_nodes: int, n_codes: int):
    """The rows of a node that share a value, in order: (node, code, rows, weights, weighted labels), the last three summed up
    to and with each item.  ``node`` is in order."""
    if n_nodes * n_codes <= 2 * len(node):
        key = node * n_codes + code
        n = np.bincount(key, minlength=n_nodes * n_codes)
        cell = np.flatnonzero(n)
        sums = [np.cumsum(v[cell]) for v in (n, np.bincount(key, w, len(n)), np.bincount(key, wy, len(n)))]
    else:
        key, order = _sorted_places(node * n_codes + code, n_nodes * n_codes)
        last = np.append(np.flatnonzero(key[1:] != key[:-1]), len(key) - 1)
        cell = key[last]
        sums = [last + 1, np.cumsum(w[order])[last], np.cumsum(wy[order])[last]]
    at = cell // n_codes
    return at, cell - at * n_codes, *sums


def mix(z: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _step(z: np.ndarray, k) -> np.ndarray:
    return z + np.asarray(k).astype(np.uint64) * np.uint64(STEP)


def tree_id(seed: int, tree: int) -> np.ndarray:
    """What the draws of a tree come from."""
    return mix(np.array([seed], np.uint64) * np.uint64(STEP) + mix(np.array([tree + 1], np.uint64) * np.uint64(STEP)))


def _bounded(dice: np.ndarray, n) -> np.ndarray:
    """Hashes as numbers below ``n``."""
    return ((dice >> np.uint64(32)) * np.asarray(n).astype(np.uint64)) >> np.uint64(32)


def draw_rows(n: int, root: np.ndarray) -> np.ndarray:
    """How often each of ``n`` rows is drawn, in ``n`` draws with replacement."""
    return np.bincount(_bounded(mix(_step(mix(_step(root, 3)), np.arange(1, n + 1))), n).astype(np.int64), minlength=n)


def _slots_of_nodes(ids: np.ndarray, total: int, slots: int) -> np.ndarray:
    """Which slots each node may look at: the first of a shuffle."""
    place, allowed, each = np.tile(np.arange(total), (len(ids), 1)), np.zeros((len(ids), total), bool), np.arange(len(ids))
    for i in range(slots):
        j = i + _bounded(mix(ids ^ (np.array([i + 1], np.uint64) * np.uint64(MORE))), total - i).astype(np.int64)
        drawn = place[each, j]
        place[each, j] = place[:, i]
        allowed[each, drawn] = True
    return allowed


def grow_tree(values: list[np.ndarray], codes: Sequence[np.ndarray], y: np.ndarray, w: np.ndarray, levels: dict[int, int], slots: int | None,
              leaf: int, depth: int | None, rng: np.random.Generator | np.ndarray, bins: frozenset[int] = frozenset()) -> dict[str, np.ndarray]:
    """One tree on the rows of positive weight ``w``, level by level.  ``levels``: categorical inputs and how many levels
    they have; ``slots``: how many slots each node may look at (None: all); ``rng``: a :func:`tree_id`, or what draws one;
    ``bins``: inputs whose ``values`` are the upper ends of bins."""
    ids = tree_id(int(rng.integers(1 << 62)), 0) if isinstance(rng, np.random.Generator) else rng
    d = len(values)
    width = [levels.get(f, 1) for f in range(d)]
    begin = np.concatenate([[0], np.cumsum(width)])
    rows = np.flatnonzero(w > 0).astype(np.int32)            # the rows of a node are neighbours
    node = np.zeros(len(rows), np.int64)                     # of each row, from 0 in each level
    out: list[dict[str, np.ndarray]] = []
    made, level, n_nodes = 1, 0, 1
    while n_nodes:
        wr, yr = w[rows], y[rows]
        wy = wr * yr
        count = np.bincount(node, minlength=n_nodes)
        tw, ty = np.bincount(node, wr, n_nodes), np.bincount(node, wy, n_nodes)
        tq = np.bincount(node, wy * yr, n_nodes)
        base = ty * ty / tw
        gain, feature, threshold = np.full(n_nodes, -np.inf), np.full(n_nodes, -1), np.zeros(n_nodes)
        limit = np.zeros(n_nodes, np.int64)                  # the threshold as a code
        # pure nodes and those that can't be cut into two leaves stay as they are
        open_ = (count >= 2 * leaf) & (tq - base > 1e-12 * np.maximum(tq, 1e-300))
        if depth is not None and level >= depth:
            open_[:] = False
        if open_.any():
            allowed = _slots_of_nodes(ids, begin[-1], slots) if slots is not None and slots < begin[-1] else None
            for f in range(d):
                look = open_ if allowed is None else open_ & allowed[:, begin[f]:begin[f + 1]].any(1)
                seen = np.flatnonzero(look)
                if not len(seen):
                    continue
                if len(seen) == n_nodes:
                    at, code, ln, lw, ly = _items(node, codes[f][rows], wr, wy, n_nodes, len(values[f]))
                else:
                    mine = np.flatnonzero(np.repeat(look, count))
                    at, code, ln, lw, ly = _items(np.repeat(np.arange(len(seen)), count[seen]), codes[f][rows[mine]], wr[mine], wy[mine],
                                                  len(seen), len(values[f]))
                first = _first_of(at)
                if f in levels:                              # one level to the left
                    ln, lw, ly = (np.diff(v, prepend=0) for v in (ln, lw, ly))
                    fine = np.ones(len(at), bool) if allowed is None else allowed[seen[at], begin[f] + values[f][code].astype(np.int64)]
                else:                                        # all items up to this one
                    size = np.diff(np.append(first, len(at)))
                    ln, lw, ly = (v - np.repeat(np.concatenate([[0], v[first[1:] - 1]]), size) for v in (ln, lw, ly))
                    fine = np.append(at[1:] == at[:-1], False)
                n = count[seen][at]
                spots = np.flatnonzero(fine & (ln >= leaf) & (n - ln >= leaf))
                mine = seen[at[spots]]
                lw, ly = lw[spots], ly[spots]
                rw, ry = tw[mine] - lw, ty[mine] - ly
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where((lw > 0) & (rw > 0), ly * ly / lw + ry * ry / rw - base[mine], -np.inf)
                top, best = _best(mine, g, n_nodes)
                better = top > np.maximum(gain, 1e-12 * np.abs(base))
                spot = spots[best[better]]
                low = values[f][code[spot]]
                if f not in levels and f not in bins:
                    high = values[f][code[spot + 1]]
                    middle = (low + high) / 2
                    low = np.where(middle < high, middle, low)
                gain[better], feature[better], threshold[better], limit[better] = top[better], f, low, code[spot]
        split = feature >= 0
        child = np.cumsum(split) - 1                         # of the level below: two for each split
        left = np.where(split, made + 2 * child, -1)
        out.append({"feature": feature, "threshold": threshold, "left": left, "right": np.where(split, left + 1, -1), "value": ty / tw})
        made, level, n_nodes = made + 2 * int(split.sum()), level + 1, 2 * int(split.sum())
        if n_nodes:
            ids = mix(_step(np.repeat(ids[split], 2), np.tile([1, 2], n_nodes // 2)))
            rows, kept = rows[np.repeat(split, count)], count[split]
            node = np.repeat(np.arange(0, n_nodes, 2), kept)
            f, cut = feature[split], limit[split]
            for k in np.unique(f):
                at = np.flatnonzero(np.repeat(f == k, kept))
                code, most = codes[k][rows[at]], np.repeat(cut[f == k], kept[f == k])
                node[at] += code != most if k in levels else code > most
            node, order = _sorted_places(node, n_nodes)
            rows = rows[order]
    return {k: np.concatenate([o[k] for o in out]) for k in out[0]}


def _class_weights(y: np.ndarray, counts: np.ndarray, kind: str | None) -> np.ndarray:
    """Weights that make both classes equally heavy, over all rows or over those drawn."""
    if kind is None:
        return np.ones(len(y))
    of = counts if kind == "balanced_subsample" else np.ones(len(y))
    one, all_ = float(of[y == 1].sum()), float(of.sum())
    return np.where(y == 1, all_ / (2 * max(one, 1e-300)), all_ / (2 * max(all_ - one, 1e-300)))


@dataclass
class Forest:
    """Trees as a table in the shared folder: numbers go left up to the threshold, levels where they equal it."""
    path: str
    categorical: list[int]
    trees: int

    def first(self, trees: int) -> Forest:
        """The forest of its first ``trees`` trees."""
        return replace(self, trees=min(trees, self.trees))

    def predictor(self):
        """An Arrow UDF: the mean of the trees' leaves for an array of inputs."""
        path, categorical, trees = self.path, tuple(self.categorical), self.trees

        @F.pandas_udf("double")
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            waiting, rows = [], 0
            for x in batches:
                waiting.append(np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1)))
                rows += len(x)
                if rows >= _rows_at_once(path):
                    yield from _predicted_all(path, categorical, waiting, trees)
                    waiting, rows = [], 0
            yield from _predicted_all(path, categorical, waiting, trees)
        return predict

    def transform(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        nodes = spark.read.schema(TREES).parquet(self.path).filter(F.col("tree") < self.trees).agg(F.sum("nodes")).first()[0]
        if nodes * NODE_BYTES <= HEAP_SHARE * heap(spark):
            slots = 1 + max(df.schema["features"].metadata.get("ml_attr", {}).get("num_attrs", 1 << 15), *self.categorical, 0)
            return with_column(df, "prediction", "cargolens.ApplyForest", "features", self.path, self.trees, slots,
                               ",".join(map(str, self.categorical)))
        ship_package(spark)
        return df.withColumn("prediction", self.predictor()(vector_to_array(F.col("features"))))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.read.schema(TREES).parquet(self.path).filter(F.col("tree") < self.trees).write.mode("overwrite").parquet(path)


def _cut(table: pa.Table) -> list[dict[str, np.ndarray]]:
    """The trees of a table, in order."""
    return [{"tree": t["tree"], "feature": np.frombuffer(t["feature"], "<i4"), "child": np.frombuffer(t["child"], "<i4"),
             "number": np.frombuffer(t["number"], "<f8")} for t in sorted(table.to_pylist(), key=lambda t: t["tree"])]


@lru_cache(maxsize=4)
def _files(path: str) -> tuple[list, int]:
    """The files of a forest, each with whole trees, and how many nodes they have."""
    root, where = _place(path)
    files = list(ds.dataset(root, format="parquet", filesystem=where).get_fragments())
    return files, sum(sum(f.to_table(columns=["nodes"])["nodes"].to_pylist()) for f in files)


@lru_cache(maxsize=4)
def _small_forest(path: str) -> list[dict[str, np.ndarray]]:
    return _cut(pa.concat_tables([f.to_table() for f in _files(path)[0]]))


def _trees(path: str, first: int | None) -> Iterator[dict[str, np.ndarray]]:
    """The trees of a forest (or the first ones): from memory, or of a large one a file at a time."""
    files, nodes = _files(path)
    if nodes <= FOREST_NODES:
        yield from (t for t in _small_forest(path) if first is None or t["tree"] < first)
    else:
        for f in files:
            yield from _cut(f.to_table(filter=None if first is None else ds.field("tree") < first))


def _rows_at_once(path: str) -> int:
    return 1 if _files(path)[1] <= FOREST_NODES else ROWS_AT_ONCE


def _predicted_all(path: str, categorical: tuple[int, ...], batches: list[np.ndarray], trees: int | None = None) -> Iterator[pd.Series]:
    """The predictions of several batches, from one reading of the trees."""
    full = [b for b in batches if len(b)]
    found = predicted(path, categorical, np.concatenate(full), trees) if full else np.zeros(0)
    at = 0
    for b in batches:
        yield pd.Series(found[at:at + len(b)])
        at += len(b)


def predicted(path: str, categorical: tuple[int, ...], x: np.ndarray, trees: int | None = None) -> np.ndarray:
    """The mean of the trees' leaves for each row (``trees``: of the first ones)."""
    total, n = np.zeros(len(x)), 0
    is_level = np.zeros(x.shape[1] + 1, bool)
    is_level[list(categorical)] = True
    for t in _trees(path, trees):
        at = np.zeros(len(x), np.int64)
        going = np.arange(len(x))
        while len(going):
            node = at[going]
            f = t["feature"][node]
            going, node, f = going[f >= 0], node[f >= 0], f[f >= 0]
            v, cut = x[going, f], t["number"][node]
            at[going] = t["child"][node] + ~np.where(is_level[f], v == cut, v <= cut)
        total += t["number"][at]
        n += 1
    return total / max(1, n)


def _code_values(path: str) -> tuple[list[np.ndarray], frozenset[int]]:
    """For each input of a training set its distinct values or the upper ends of its bins, and which ones have bins."""
    inputs = sorted(_read(f"{path}/values").to_pylist(), key=lambda v: v["f"])
    return [np.frombuffer(v["found"], "<f8") for v in inputs], frozenset(v["f"] for v in inputs if v["binned"])


def _code_type(values: list[np.ndarray]) -> str:
    return "<u2" if max(map(len, values)) <= 1 << 16 else "<u4"


def side_table(x: DataFrame, d: int, exact: bool) -> str:
    """Vectors of ``d`` inputs and labels (``features``, ``label``) written to the shared folder as a side input of the tasks:
    each value as its place among the input's distinct values, or (not ``exact``) bins if these are many."""
    path = f"{checkpoint_dir(x.sparkSession).rstrip('/')}/training-{uuid.uuid4().hex}"
    ship_package(x.sparkSession)
    most, n_bins = MOST_VALUES, BINS
    rows = x.select(vector_to_array(F.col("features")).alias("x"), F.col("label").cast("double").alias("label"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each input's distinct values in a partition and how often they occur."""
        parts = [_matrix(b.column(0)) for b in batches if b.num_rows]
        for f in range(d if parts else 0):
            v, n = np.unique(np.concatenate([p[:, f] for p in parts]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([v.astype("<f8").tobytes()], pa.binary()),
                                              pa.array([n.astype("<i4").tobytes()], pa.binary())], ["f", "v", "n"])

    def merged(t: pa.Table) -> pa.Table:
        v, at = np.unique(np.concatenate([np.frombuffer(b, "<f8") for b in t["v"].to_pylist()]), return_inverse=True)
        binned = not exact and len(v) > most
        if binned:
            upto = np.cumsum(np.bincount(at, np.concatenate([np.frombuffer(b, "<i4") for b in t["n"].to_pylist()])))
            v = v[np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, n_bins + 1) / n_bins))]
        return pa.table({"f": t["f"][:1], "binned": pa.array([binned]), "found": pa.array([v.astype("<f8").tobytes()], pa.binary())})

    rows.select("x").mapInArrow(found, "f int, v binary, n binary").groupBy("f").applyInArrow(
        merged, "f int, binned boolean, found binary").write.parquet(f"{path}/values")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, _ = _code_values(path)
        for b in batches:
            m = _matrix(b.column(0)) if b.num_rows else np.zeros((0, d))
            c = np.empty(m.shape, _code_type(values))
            for f, v in enumerate(values):
                c[:, f] = np.minimum(np.searchsorted(v, m[:, f]), len(v) - 1)
            ends = np.arange(len(m) + 1, dtype=np.int32) * np.int32(d * c.itemsize)
            coded = pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(ends), pa.py_buffer(c)])
            yield pa.RecordBatch.from_arrays([coded, b.column(1)], ["code", "label"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a partition as one."""
        codes, labels = [], []
        for b in batches:
            codes += b.column(0).to_pylist()
            labels.append(b.column(1).to_numpy())
        if codes:
            yield pa.RecordBatch.from_arrays([
                pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([len(codes)], pa.int32()), pa.array([b"".join(codes)], pa.binary()),
                pa.array([np.concatenate(labels).astype("<f8").tobytes()], pa.binary())], ["block", "n", "codes", "labels"])

    key = F.xxhash64("code", "label")
    rows.mapInArrow(code, "code binary, label double").repartition(BLOCKS, key).sortWithinPartitions(key, "label", "code").mapInArrow(
        block, "block int, n int, codes binary, labels binary").write.parquet(f"{path}/rows")
    return path


def grow_forest(spark: SparkSession, side: str, levels: dict[int, int], trees: int, leaf: int, share: float | str, depth: int | None,
                class_weight: str | None = None, bootstrap: bool = True, seed: int = 42) -> Forest:
    """Grow ``trees`` trees on the training set at ``side``, some in each task.  ``share``: of the slots a node looks at, or
    "sqrt"; ``class_weight``: None, "balanced" or "balanced_subsample"."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    tasks = max(1, min(trees, 8 * spark.sparkContext.defaultParallelism))
    map_partitions(spark.range(0, trees, 1, tasks), "cargolens.GrowTrees", TREES, side, ",".join(f"{f}:{n}" for f, n in levels.items()), leaf,
                   str(share), -1 if depth is None else depth, class_weight or "", bootstrap, seed).write.parquet(path)
    return Forest(path, sorted(levels), trees)
