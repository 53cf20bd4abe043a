"""Profiling and data-quality operators (DQ rows).

Every profile is a single aggregation pass per table (one ``agg`` with one
expression per column), turned to long form with ``explode`` of an array of
structs; no per-column jobs, no driver loops over data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import r

# Accented Latin letters and their plain forms (accent folding of
# place names, the NFKD-to-ASCII rule restricted to the Latin-1 letters).
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"


def fold_accents(c) -> F.Column:
    """DQ-6 / UDF-1: accent folding with the built-in ``translate`` (no UDF)."""
    return F.translate(c if not isinstance(c, str) else F.col(c), ACCENTED, PLAIN)


def overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """DQ-1: rows, columns, null cells and exact duplicate rows per table."""
    parts = []
    for name, df in tables.items():
        cols = df.columns
        nulls = sum((F.sum(F.col(c).isNull().cast("long")) for c in cols), F.lit(0))
        parts.append(df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"),
                            F.lit(len(cols)).cast("long").alias("cols"),
                            nulls.cast("long").alias("total_missing_cells"),
                            (F.count(F.lit(1)) - F.count_distinct(F.struct(*cols))).alias("exact_dup_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing(tables: Mapping[str, DataFrame]) -> DataFrame:
    """DQ-2 / SHP-3: nulls per column (count and % to 2 dp), only columns with any."""
    parts = []
    for name, df in tables.items():
        wide = df.agg(F.count(F.lit(1)).alias("_n"),
                      *[F.sum(F.col(c).isNull().cast("long")).alias(f"_m{i}") for i, c in enumerate(df.columns)])
        long = wide.select("_n", F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing_rows"))
            for i, c in enumerate(df.columns)])).alias("x"))
        parts.append(long.select(F.lit(name).alias("table"), "x.column", "x.missing_rows",
                                 r(F.col("x.missing_rows") / F.col("_n") * 100, 2).alias("missing_pct")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("missing_rows") > 0)


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """DQ-4: count, mean, sample sd, min, quartiles (linear interpolation), max per column, long form."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).cast("double").alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__std"), F.min(c).cast("double").alias(f"{c}__min"),
                 F.percentile(c, 0.25).alias(f"{c}__25%"), F.median(c).alias(f"{c}__50%"),
                 F.percentile(c, 0.75).alias(f"{c}__75%"), F.max(c).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stats = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("stat"), *[r(F.col(f"`{c}__{s}`"), 6).alias(c) for c in cols]) for s in stats]))
        .alias("x")).select("x.*")


def gate(facts: DataFrame, expected: Mapping[str, float], tol: Mapping[str, float] | None = None) -> DataFrame:
    """DQ-13: compare a one-row facts table with expected values; the result
    has one row per fact and the job fails (``raise_error``) on any mismatch."""
    tol = dict(tol or {})
    long = facts.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("fact"), F.col(k).cast("double").alias("value"),
                 F.lit(float(v)).alias("expected"), F.lit(float(tol.get(k, 0.0))).alias("tol"))
        for k, v in expected.items()])).alias("x")).select("x.*")
    ok = F.abs(F.col("value") - F.col("expected")) <= F.col("tol")
    return long.select("*", F.when(F.coalesce(ok, F.lit(False)), F.lit(True))
                       .otherwise(F.raise_error(F.concat(F.lit("fact drifted: "), F.col("fact")))).alias("ok"))
