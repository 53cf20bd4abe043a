"""The training corpus, from ``documents`` to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm import linededup, mixing, ngramjoin, packing, toxicity
from cargolens.llm.common import as_row, restored, shared_table, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.train(docs, labels)
    scored = toxicity.score(as_row(docs, _text="text"), model, text_col="_text", alias="_score")
    return scored.filter(F.col("_score") < toxicity.CUT).select(*restored(docs, _text="text"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that earlier documents have; a document that
    consists of such passages alone is gone.  ``n_chars`` follows the text."""
    cleaned = linededup.line_dedup(as_row(docs, doc_id="doc_id", text="text"))
    changed = F.col("removed_chars") > 0
    cleaned = cleaned.filter(~changed | F.col("text").rlike(r"\S"))
    kept = cleaned.withColumn("_new_chars", F.when(changed, F.length("text")).otherwise(F.col("_row.n_chars")).cast("long"))
    return kept.select(*[F.col("_new_chars").alias(c) if c == "n_chars" else v
                         for c, v in zip(docs.columns, restored(docs, doc_id="doc_id", text="text"))])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of similar texts;
    of rows that repeat an id and text, one."""
    joined = ngramjoin.similarity_join(docs)
    stays = joined.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.max("n_links").alias("_links"), F.count(F.lit(1)).alias("_rows"))
    stays = shared_table(stays, "stays")
    rows = as_row(docs, _doc="doc_id", _text="text").withColumn("_own", F.md5("_text"))
    kept = rows.hint("merge").join(stays, F.col("_doc").eqNullSafe(F.col("_id")) & F.col("_own").eqNullSafe(F.col("_key")))
    if stays.filter((F.col("_rows") > 1) & (F.col("_links") > 0)).limit(1).count():
        kept = kept.filter(F.col("_links") == 0).unionByName(
            kept.filter(F.col("_links") > 0).dropDuplicates(["_doc", "_own"]))
    return kept.select(*restored(docs, _doc="doc_id", _text="text"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, once for each copy, in training order."""
    return mixing.training_order(docs, mixing.mix_sources(docs, whole_documents=True))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("mix_sources", mix_to_weights),
    ("best_fit_packing", pack_sequences),
]

# A fitted model, Spark's hashes and byte-pair ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
