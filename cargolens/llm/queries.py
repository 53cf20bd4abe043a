"""The registered queries of this package: one for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, embeddings, fingerprints, licenses, linededup, mixing, ngramjoin, packing, periodic, secrets,
               tokencounts, toxicity, warc)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the chunks that other documents have first (no SQL: Spark's hash places the chunks)."""
    cleaned = linededup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "text", "removed_chunks", "removed_chars")


@_query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best licence of each document."""
    return licenses.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


ORACLE["op2_license_scan"] = licenses.oracle()


@_query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document, with owner-specific bare tokens."""
    return secrets.report(secrets.secret_scan(table(spark, sf_dir, "documents")))


@_query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens (no SQL: byte-pair ids)."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@_query
def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors (no SQL: quadratic there)."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@_query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document and of its edit (no SQL: Spark's hash makes the lanes)."""
    return fingerprints.edit_report(table(spark, sf_dir, "documents"))


@_query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document in the mix of sources, with its training position."""
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "position", "next_position")


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each document; learns only from rows that aren't held out (no SQL: a fitted model)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


@_query
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of each document among 5-word-shingle sets (no SQL: quadratic there)."""
    joined = ngramjoin.similarity_join(table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "class_id", "n_links")


@_query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length histogram with suffix sums for every context limit (no SQL: byte-pair ids)."""
    lengths = tokencounts.encoded_lengths(table(spark, sf_dir, "documents"))
    return tokencounts.context_limits(tokencounts.histogram(lengths))


@_query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of each document, with a repetition planted in every tenth (no SQL: tested against brute force)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic.report(periodic.periodic_runs(periodic.planted(docs)))


@_query
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, written to archives and read back."""
    read = warc.read_records(warc.write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    return read.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"))


ORACLE["op12_warc"] = warc.oracle()


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers (no SQL: byte-pair ids; tested against brute force)."""
    found = alignment.align_tokenizers(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text")
