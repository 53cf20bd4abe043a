"""Global ranks and running sums without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task,
and ``Window.partitionBy(key)`` moves every row of a hot key into one task.
:func:`global_running` does the same computation in two phases:

1. ``repartitionByRange`` on (keys, ordering), so each partition holds one
   contiguous slice of the order -- a hot key simply spans several slices; the
   slice assignment is written with ``checkpoint()`` (the cluster's shared
   checkpoint folder) so it is fixed even if an executor is lost;
2. running sums and row numbers inside each (slice, key), plus one small table
   of per-(slice, key) totals whose exclusive prefix per key is joined back as
   the offset.

The offsets table has at most (#slices + #keys) rows.  The ordering must be
total (add a unique tie key) for results to be repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

ACCURACY = 10_000                        # of the sketches that bracket quantiles


def _order_exprs(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def global_running(df: DataFrame, order: Sequence[Column | str], sums: dict[str, str | Column] | None = None,
                   index_col: str = "_k", total_prefix: str = "_total_", n_slices: int | None = None,
                   keys: Sequence[str] = ()) -> DataFrame:
    """Add a 1-based row number ``index_col`` (within ``keys``), inclusive
    running sums (output name -> value column) and the per-key totals
    ``_total_<name>`` and ``_total_n``."""
    sums = dict(sums or {})
    keys = list(keys)
    order = _order_exprs(order)
    spark = df.sparkSession
    n = n_slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    vals = {name: (F.col(v) if isinstance(v, str) else v) for name, v in sums.items()}
    base = df.select("*", *[v.cast("double").alias(f"_v_{k}") for k, v in vals.items()])
    checkpoint_dir(spark)
    sliced = (base.repartitionByRange(n, *[F.col(k) for k in keys], *order)
              .withColumn("_slice", F.spark_partition_id()).checkpoint(eager=True))
    part = Window.partitionBy("_slice", *keys).orderBy(*order)
    inner = part.rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.select("*", F.row_number().over(part).alias("_lk"),
                          *[F.sum(f"_v_{k}").over(inner).alias(f"_ls_{k}") for k in vals])
    totals = sliced.groupBy("_slice", *keys).agg(F.count(F.lit(1)).alias("_sn"),
                                                 *[F.sum(f"_v_{k}").alias(f"_ss_{k}") for k in vals])
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = totals.select(
        "_slice", *keys,
        F.coalesce(F.sum("_sn").over(before), F.lit(0)).alias("_on"),
        F.sum("_sn").over(whole).alias(f"{total_prefix}n"),
        *[F.coalesce(F.sum(f"_ss_{k}").over(before), F.lit(0.0)).alias(f"_os_{k}") for k in vals],
        *[F.sum(f"_ss_{k}").over(whole).alias(f"{total_prefix}{k}") for k in vals])
    offsets = offsets.withColumnsRenamed({c: f"_of_{c}" for c in ("_slice", *keys)})
    if not keys:
        offsets = F.broadcast(offsets)          # one row per slice
    on = F.col("_slice") == F.col("_of__slice")
    for k in keys:                              # null is a key of its own
        on = on & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    out = local.join(offsets, on)
    return out.select(
        *[c for c in df.columns],
        (F.col("_lk") + F.col("_on")).alias(index_col),
        *[(F.col(f"_ls_{k}") + F.col(f"_os_{k}")).alias(k) for k in vals],
        F.col(f"{total_prefix}n"),
        *[F.col(f"{total_prefix}{k}") for k in vals])


def _on_keys(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of keys with their copies named ``prefix`` + key."""
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return on


def _beside(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``df`` with the columns of its group's row in ``groups``."""
    if not keys:
        return attach(df, groups)
    renamed = groups.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    return df.join(renamed, _on_keys(keys, "_g_"), how).drop(*[f"_g_{k}" for k in keys])


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str | Column, float]], keys: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles (linear interpolation between order statistics, as pandas
    / ``percentile``) of several columns, one row per ``keys`` (or one row), by
    bracketed selection; the columns are never sorted.

    ``wanted`` maps an output name to (column, quantile).  A mergeable sketch of
    each group and column gives two values around each quantile, with twice the
    sketch's error as margin.  Another pass counts the values below the bracket,
    finds its neighbours and keeps, by distinct value, only what lies inside: at
    most about 4 / ``ACCURACY`` of the rows for each quantile, and equal values
    combine before the shuffle.  The exact rank is picked there.  A rank outside
    its bracket would be an error.  Groups without any value have no row.
    """
    keys = list(keys)
    cols: dict[str, Column] = {}
    asked: dict[str, list[float]] = {}
    for c, q in wanted.values():
        text = c if isinstance(c, str) else str(c)
        cols.setdefault(text, F.col(c) if isinstance(c, str) else c)
        if float(q) not in asked.setdefault(text, []):
            asked[text].append(float(q))
    base = df.select(*keys, *[c.cast("double").alias(f"_c{i}") for i, c in enumerate(cols.values())])
    margin = 2.0 / ACCURACY
    slots = [(i, j, q) for i, text in enumerate(cols) for j, q in enumerate(asked[text])]
    sketch = base.groupBy(*keys).agg(*[F.count(f"_c{i}").alias(f"_n{i}") for i in range(len(cols))], *[F.percentile_approx(
        f"_c{i}", F.array(*[F.lit(x) for q in asked[text] for x in (max(0.0, q - margin), min(1.0, q + margin))]), F.lit(ACCURACY)).alias(f"_b{i}")
        for i, text in enumerate(cols)])
    rows = _beside(base, sketch, keys)
    ends = {(i, j): (F.get(f"_b{i}", F.lit(2 * j)), F.get(f"_b{i}", F.lit(2 * j + 1))) for i, j, _ in slots}
    sums, kept = [], []
    for s, (i, j, q) in enumerate(slots):
        (low, high), v = ends[i, j], F.col(f"_c{i}")
        sums += [F.count(F.when(v < low, F.lit(1))).alias(f"_below{s}"), F.max(F.when(v < low, v)).alias(f"_prev{s}"),
                 F.min(F.when(v > high, v)).alias(f"_next{s}"), F.count(F.when((v >= low) & (v <= high), F.lit(1))).alias(f"_inside{s}")]
        kept.append(F.when((v >= low) & (v <= high), F.struct(F.lit(s).alias("s"), v.alias("v"))))
    groups = _beside(rows.groupBy(*keys).agg(*sums), sketch.drop(*[f"_b{i}" for i in range(len(cols))]), keys)
    inside = rows.select(*keys, F.explode(F.array_compact(F.array(*kept))).alias("_e")).groupBy(
        *keys, F.col("_e.s").alias("_s"), F.col("_e.v").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*keys, "_s").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    counted = _beside(inside.withColumn("_cum", F.sum("_n").over(upto)), groups, keys)
    start = F.col("_cum") - F.col("_n")
    picks, at = [], {}
    for s, (i, j, q) in enumerate(slots):
        h = (F.col(f"_n{i}") - 1) * F.lit(q)
        at[s] = {"lo": F.floor(h), "hi": F.ceil(h)}, h - F.floor(h)
        for end, place in at[s][0].items():
            rel = place - F.col(f"_below{s}")
            picks.append(F.max(F.when((F.col("_s") == s) & (start <= rel) & (rel < F.col("_cum")), F.col("_v"))).alias(f"_{end}{s}"))
    found = _beside(groups, counted.groupBy(*keys).agg(*picks), keys, "left")
    out = []
    for name, (c, q) in wanted.items():
        text = c if isinstance(c, str) else str(c)
        s = next(k for k, (i, j, x) in enumerate(slots) if i == list(cols).index(text) and x == float(q))
        ends_of, part = at[s]
        value = {}
        for end, place in ends_of.items():
            below, after = F.col(f"_below{s}"), F.col(f"_below{s}") + F.col(f"_inside{s}")
            value[end] = (F.when(place == below - 1, F.col(f"_prev{s}")).when(place == after, F.col(f"_next{s}"))
                          .when((place >= below) & (place < after), F.col(f"_{end}{s}"))
                          .when(F.col(f"_n{slots[s][0]}") > 0, F.raise_error(F.lit(f"{name}: rank outside its bracket")).cast("double")))
        out.append((value["lo"] + part * (value["hi"] - value["lo"])).alias(name))
    if keys:
        found = found.filter(sum((F.col(f"_n{i}") for i in range(len(cols))), F.lit(0)) > 0)
    return found.select(*keys, *out)


def agg_with_quantiles(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column],
                       wanted: dict[str, tuple[str | Column, float]]) -> DataFrame:
    """``df.groupBy(keys).agg(aggs)`` with exact quantiles beside the aggregates."""
    keys = list(keys)
    base, q = df.groupBy(*keys).agg(*aggs), exact_quantiles(df, wanted, keys)
    if not keys:
        return attach(base, q.agg(*[F.max(n).alias(n) for n in wanted]))
    q = q.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *wanted)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return base.join(q, cond, "left").drop(*[f"_k_{k}" for k in keys])


def exact_quantile(df: DataFrame, col: str, q: float, alias: str = "q", keys: Sequence[str] = ()) -> DataFrame:
    """One exact quantile of one column: see :func:`exact_quantiles`."""
    return exact_quantiles(df, {alias: (col, q)}, keys)


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row DataFrame (a broadcast equi-join on a constant key)."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one").drop("_one"))
