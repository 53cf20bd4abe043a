"""Trailing event counts (JON-10, JON-11, JON-12, STR-4).

``count_before`` answers, for every probe instant ``x``, how many events lie
strictly before ``x`` (optionally within the same key, e.g. seller).  A
trailing count over [x - w, x) is then ``F(x) - F(x - w)``.

Events and probes go through one shuffle, ordered by (key, time) over all
slices, so a hot key spans as many slices as it needs.  A task walks its sorted
slice in Arrow batches with the running count of one key as its only state.  The
slices' counts are written once, and a slice's first key takes over what the
slices before it counted for that key: one row a slice, broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package, stored

PROBE, HEAD, TAIL = 0, 1, 2              # what a written row is: an answer, the first or the last key of its slice


def _changes(columns: Sequence[pa.Array]) -> np.ndarray:
    """For every row but the first: does its key differ from that of the row before (null is a key of its own)?"""
    n = len(columns[0]) - 1
    out = np.zeros(n, dtype=bool)
    for c in columns:
        here, before = c.slice(1), c.slice(0, n)
        unequal = pc.fill_null(pc.not_equal(here, before), False)
        out |= pc.or_(unequal, pc.xor(pc.is_null(here), pc.is_null(before))).to_numpy(zero_copy_only=False)
    return out


def _counter(n_keys: int, names: list[str]):
    """Walks a slice sorted by (keys, time): columns keys..., probe id, weight (1: an event, 0: a probe)."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        last, seen, first = None, 0, True        # the key of the row before, its events so far, is it the slice's first key?

        def rows(keys, ids, counts, firsts, mark):
            n = len(ids)
            return pa.RecordBatch.from_arrays(
                [*keys, ids, pa.array(counts, pa.int64()), pa.array(firsts, pa.bool_()),
                 pa.array(np.full(n, mark), pa.int32()), pa.array(np.full(n, number), pa.int32())], names=names)

        def marker(key, id_type, count, mark):
            return rows(key, pa.nulls(1, id_type), [count], [True], mark)

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            keys, ids = [batch.column(i) for i in range(n_keys)], batch.column(n_keys)
            weight = batch.column(n_keys + 1).to_numpy(zero_copy_only=False).astype(np.int64)
            new = np.zeros(n, dtype=bool)
            if n_keys:
                new[1:] = _changes(keys)
            if last is None:
                yield marker([k.slice(0, 1) for k in keys], ids.type, 0, HEAD)
            elif n_keys:
                new[0] = bool(_changes([pa.concat_arrays([a, k.slice(0, 1)]) for a, k in zip(last, keys)])[0])
            before = np.cumsum(weight) - weight
            begins = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            carried = np.cumsum(new) == 0        # rows of the key that the batch before ended with
            count = before - before[begins] + np.where(carried, seen, 0)
            probes = np.flatnonzero(weight == 0)
            if len(probes):
                at = pa.array(probes)
                yield rows([k.take(at) for k in keys], ids.take(at), count[probes], (carried & first)[probes], PROBE)
            first = first and bool(carried[-1])
            last, seen = [k.slice(n - 1, 1) for k in keys], int(count[-1] + weight[-1])
        if last is not None:
            yield marker(last, ids.type, seen, TAIL)
    return walk


def count_before(events: DataFrame, probes: DataFrame, time_col: str = "t_us",
                 keys: Sequence[str] = (), probe_id: str = "probe_id") -> DataFrame:
    """For each probe row (keys..., probe_id, t_us) the number of events with
    the same keys and ``t_us`` strictly smaller.

    ``events`` holds (keys..., t_us); both times are epoch microseconds; rows
    without a time are no events, and probes without one have no row.
    Returns (keys..., probe_id, n_before).
    """
    keys = list(keys)
    spark = probes.sparkSession
    ship_package(spark)
    id_type = probes.schema[probe_id].dataType
    both = (events.select(*keys, F.lit(None).cast(id_type).alias(probe_id), F.lit(1).alias("_w"), F.col(time_col).alias("_t"))
            .unionByName(probes.select(*keys, F.col(probe_id), F.lit(0).alias("_w"), F.col(time_col).alias("_t")))
            .filter(F.col("_t").isNotNull()))
    # probes before the events of their instant
    order = [*keys, "_t", "_w"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = both.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_t")
    schema = T.StructType([*[T.StructField(k, both.schema[k].dataType) for k in keys], T.StructField(probe_id, id_type),
                           T.StructField("_n", T.LongType()), T.StructField("_first", T.BooleanType()),
                           T.StructField("_mark", T.IntegerType()), T.StructField("_slice", T.IntegerType())])
    counted = stored(lines.mapInArrow(_counter(len(keys), schema.names), schema), "counts")
    ends = counted.filter(F.col("_mark") != PROBE).groupBy(*keys, "_slice").agg(
        F.sum("_n").alias("_n"), F.max((F.col("_mark") == HEAD).cast("int")).alias("_head"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).filter("_head = 1").select("_slice", "_before")
    answers = counted.filter(F.col("_mark") == PROBE).join(F.broadcast(offsets), "_slice")
    return answers.select(*keys, probe_id, (F.col("_n") + F.when(F.col("_first"), F.col("_before")).otherwise(0)).cast("long").alias("n_before"))


def trailing_counts(events: DataFrame, probes: DataFrame, spans_us: dict[str, tuple[int, int]],
                    keys: Sequence[str] = (), probe_id: str = "probe_id", time_col: str = "t_us") -> DataFrame:
    """Counts of events in half-open windows [t - a, t - b) for each probe.

    ``spans_us`` maps an output name to (a, b) in microseconds, e.g.
    ``{"load_7d": (7 * DAY, 0)}``.  Each distinct offset becomes one probe
    instant; all instants are answered by one :func:`count_before` pass.
    """
    keys = list(keys)
    offsets = sorted({o for span in spans_us.values() for o in span})
    shifted = probes.select(*keys, F.col(probe_id).alias("_id"), F.col(time_col).alias("_at"),
                            F.explode(F.array(*[F.lit(o).cast("long") for o in offsets])).alias("_off"))
    shifted = shifted.select(*keys, F.struct(F.col("_id").alias("id"), F.col("_off").alias("off")).alias("_pk"),
                             (F.col("_at") - F.col("_off")).alias("t_us"))
    ev = events.select(*keys, F.col(time_col).alias("t_us"))
    fb = count_before(ev, shifted, "t_us", keys, "_pk")
    wide = fb.groupBy(*keys, F.col("_pk.id").alias(probe_id)).agg(
        *[F.max(F.when(F.col("_pk.off") == o, F.col("n_before"))).alias(f"_f{o}") for o in offsets])
    out = wide.select(*keys, probe_id,
                      *[(F.col(f"_f{b}") - F.col(f"_f{a}")).alias(name) for name, (a, b) in spans_us.items()])
    return out
