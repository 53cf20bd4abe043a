"""Statistics operators: correlation matrices, average ranks, Spearman."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import r
from .ranking import global_running


def corr_long(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """STA-2: pairwise-complete Pearson matrix in long form (var, other, corr),
    all k*k cells from k(k+1)/2 ``corr`` expressions in one aggregation pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
                    for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells.append(F.struct(F.lit(a).alias("var"), F.lit(b).alias("other"), r(F.col(f"c{i}"), digits).alias("corr")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("var"), F.lit(a).alias("other"),
                                  r(F.col(f"c{i}"), digits).alias("corr")))
    return wide.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def average_rank(df: DataFrame, col: str, out: str) -> DataFrame:
    """Average rank of ``col`` (ties share the mean of their positions), the
    ``rank(method='average')`` of pandas.

    Ranks come from a table of distinct values and their counts: a running sum
    over that (much smaller) table, done in two phases by
    :func:`global_running`, then an equi-join back on the value.  No window over
    raw rows, so no single task holds the whole column."""
    vc = df.groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    run = global_running(vc, [F.asc("_v")], {"_cum": "_c"})
    ranks = run.select(F.col("_v").alias(col), (F.col("_cum") - F.col("_c") + (F.col("_c") + 1) / 2.0).alias(out))
    return df.join(ranks, col, "left")


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """STA-3: Spearman correlation = Pearson correlation of average ranks (rows with both values)."""
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    d = average_rank(average_rank(d, x, "_rx"), y, "_ry")
    return d.agg(F.corr("_rx", "_ry").alias("spearman"), F.count(F.lit(1)).alias("n"))
