"""Token counts from an exact histogram of encoded lengths.

Documents are encoded once and only their lengths are aggregated: the
histogram has one row per distinct length.  Sums over the lengths above a
limit (suffix sums) then answer, for every context limit, how many documents
are longer, how many tokens remain after truncation and which share of the
documents fits -- without looking at a document again.

Defined results: a null or empty text has length 0; every row counts, also a
repeated one; an empty table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, shared_table
from .tokens import default_tokenizer, encoder

# Lengths are gathered in spans of this many for the two-level suffix sums.
SPAN = 1024


def encoded_lengths(df: DataFrame, text_col: str = "text", keep: Sequence[str] = (),
                    tokenizer: str | None = None) -> DataFrame:
    """The ``keep`` columns and ``length``, the number of ids of each text."""
    prepare(df.sparkSession)
    path = tokenizer or default_tokenizer()
    narrow = df.select(*[F.col(c) for c in keep], F.col(text_col).alias("_text"))
    schema = narrow.drop("_text").schema.add("length", "long")

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n = [len(enc.packed(t)) // 4 for t in b.column(b.num_columns - 1).to_pylist()]
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64())], [*keep, "length"])

    return narrow.mapInArrow(lengths, schema)


def histogram(lengths: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Documents per distinct length (and ``by`` columns)."""
    return lengths.groupBy(*by, "length").agg(F.count(F.lit(1)).alias("n_docs"))


def context_limits(hist: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """For each distinct length, taken as a context limit: documents and tokens
    of that length, documents and tokens above it, all documents and tokens,
    tokens left after truncation to it, and the share of documents that fit.

    Suffix sums have two levels (inside a span of lengths, then over spans), so
    no window holds more than the lengths of one span or the list of spans.
    """
    hist = shared_table(hist, "lengths")             # texts are encoded once
    h = hist.select(*by, "length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"),
                    F.floor(F.col("length") / SPAN).alias("_span"))
    spans = h.groupBy(*by, "_span").agg(F.sum("n_docs").alias("_sd"), F.sum("n_tokens").alias("_st"))
    after = Window.partitionBy(*by, F.lit(0)).orderBy("_span").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy(*by, F.lit(0))
    zero = F.lit(0).cast("long")
    spans = spans.select(
        *[F.col(c).alias(f"_k_{c}") for c in by], F.col("_span").alias("_s"),
        F.coalesce(F.sum("_sd").over(after), zero).alias("_ad"),
        F.coalesce(F.sum("_st").over(after), zero).alias("_at"),
        F.sum("_sd").over(whole).alias("total_docs"), F.sum("_st").over(whole).alias("total_tokens"))
    cond = F.col("_span") == F.col("_s")
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    above = Window.partitionBy(*by, "_span").orderBy("length").rowsBetween(1, Window.unboundedFollowing)
    out = (h.withColumn("_d", F.coalesce(F.sum("n_docs").over(above), zero))
           .withColumn("_t", F.coalesce(F.sum("n_tokens").over(above), zero)).join(spans, cond))
    docs_above = F.col("_d") + F.col("_ad")
    tokens_above = F.col("_t") + F.col("_at")
    return out.select(
        *by, "length", "n_docs", "n_tokens", docs_above.alias("docs_above"), tokens_above.alias("tokens_above"),
        "total_docs", "total_tokens",
        (F.col("total_tokens") - tokens_above + docs_above * F.col("length")).alias("truncated_tokens"),
        ((F.col("total_docs") - docs_above) / F.col("total_docs")).alias("share_fitting"))


def at_limit(limits: DataFrame, limit: int) -> DataFrame:
    """Totals for any context limit, also one that no document has as length:
    one row with the documents above it and the tokens left by truncation."""
    cut = F.least(F.col("length"), F.lit(limit))
    return limits.agg(F.coalesce(F.sum(F.when(F.col("length") > limit, F.col("n_docs"))), F.lit(0)).alias("docs_above"),
                      F.coalesce(F.sum(cut * F.col("n_docs")), F.lit(0)).alias("truncated_tokens"))


def quantile(limits: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least a share ``q`` of the documents doesn't exceed."""
    return limits.filter(F.col("share_fitting") >= q).agg(F.min("length").alias("length"))
