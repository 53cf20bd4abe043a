"""Mixing sources to target weights along a training curriculum.

1. Sizes are summed by source; the weights' targets are water-filled, so that
   no source is asked for more than ``max_repeat`` times its own size.
2. Inside a source, documents stand in a fixed pseudo-random order.  The mix
   goes through that order once and, where the target asks for it, again; the
   running token count tells which part of each document is taken.
3. Every source has a weight schedule over training time (a curriculum).  Its
   integral is the source's cumulative token demand; inverting it at a
   document's place in the source gives the document's training position.
   Range-sorting by that position is the training order.

A source that holds a third of all rows is no burden: running counts have two
levels (see :func:`common.running`), and everything else is an aggregate.

Defined results: a null text has size 0, a null source is a source of its own
(sorted last); repeated rows are documents of their own; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_running
from .common import as_row, bucket_count, restored, running, shared_table

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MAX_REPEAT = 1.5, 2.0
# Curriculum of each weight class: relative weight at the start, the middle and
# the end of training (linear in between).  Heavy sources lead, light ones end.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, total: float, max_repeat: float) -> DataFrame:
    """Add ``target`` to (source_size, weight, ...): shares of ``total`` by weight,
    stopped at ``max_repeat * source_size``, the excess reshared until none is
    above.  Only sums come to the driver; the rounds end when none is capped."""
    cap = F.col("source_size") * F.lit(float(max_repeat))
    level, stopped, sources = 0.0, -1, shared_table(sources, "sources")
    while True:
        capped = cap <= F.col("weight") * F.lit(level)
        got = sources.agg(F.coalesce(F.sum(capped.cast("long")), F.lit(0)).alias("stopped"),
                          F.coalesce(F.sum(F.when(capped, cap)), F.lit(0.0)).alias("used"),
                          F.sum(F.when(~capped, F.col("weight"))).alias("open")).first()
        if not got["open"]:
            return sources.withColumn("target", cap)
        if got["stopped"] == stopped:
            return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))
        level, stopped = max(0.0, total - got["used"]) / got["open"], got["stopped"]


def position(share: Column, schedule: Sequence[float]) -> Column:
    """Training time in [0, 1] by which ``share`` of a source's tokens has been
    asked for, under a schedule that is linear between evenly spaced knots."""
    step = 1.0 / (len(schedule) - 1)
    area = [step * (a + b) / 2 for a, b in zip(schedule, schedule[1:])]
    want, done, out = share * F.lit(sum(area)), 0.0, None
    for i, (a, b) in enumerate(zip(schedule, schedule[1:])):
        rest, slope = want - F.lit(done), (b - a) / step
        # a x + slope x^2 / 2 = rest, in the form that also holds for slope 0
        root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * slope) * rest, F.lit(0.0)))
        x = F.when(rest <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * rest / (F.lit(a) + root))
        at = F.lit(i * step) + F.least(x, F.lit(step))
        done += area[i]
        out = at if out is None else F.when(want <= F.lit(done - area[i]), out).otherwise(at)
    return F.least(out, F.lit(1.0))


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_repeat: float = MAX_REPEAT,
                schedules: Sequence[Sequence[float]] = SCHEDULES, whole_documents: bool = False) -> DataFrame:
    """(id, text_hash, source, size, source_size, target, taken, copies,
    position, next_position): one row for each document.

    ``taken`` counts words, repeats included; ``copies`` says how often the
    document begins.  With ``whole_documents`` a document is taken whole or not
    at all; otherwise the one at the end of a source's target is cut there.
    ``position`` and ``next_position`` are the training times of the first and
    second copy, null for copies that the mix doesn't take.
    """
    if max_repeat > 2:
        raise ValueError("a document is taken at most twice")
    docs = shared_table(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("src"),
                                  F.xxhash64(text_col).alias("text_hash"), word_count(F.col(text_col)).alias("size")), "sizes")
    total = docs.agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).first()
    sums = docs.groupBy("src").agg(F.sum("size").alias("source_size"))
    ranked = global_running(sums, [F.asc_nulls_last("src")], index_col="_place")
    slot = ((F.col("_place") - 1) % len(weights)).cast("int")
    ranked = ranked.select("src", "source_size", slot.alias("slot"),
                           F.element_at(F.array(*[F.lit(float(w)) for w in weights]), slot + 1).alias("weight"))
    targets = water_fill(ranked, share * (total["s"] or 0), max_repeat)
    targets = shared_table(targets.select(F.col("src").alias("_src"), "source_size", "slot", "target"), "targets")

    placed = running(docs.withColumn("_h", F.xxhash64("id", "text_hash", F.lit(7))), ["src"], "_h",
                     ["_h", "id", "text_hash"], F.col("size"), bucket_count(total["n"]), "_before")
    mixed = placed.join(targets, F.col("src").eqNullSafe(F.col("_src")))
    zero, size, before = F.lit(0).cast("long"), F.col("size"), F.col("_before")
    second = before + F.col("source_size")
    if whole_documents:
        # a document belongs to the mix when its middle does
        def part(at: Column) -> Column:
            return F.when(at + size / 2 < F.col("target"), size).otherwise(zero)
    else:
        def part(at: Column) -> Column:
            return F.least(size, F.greatest(zero, F.floor("target") - at))
    one, two = part(before), part(second)

    def when(at: Column, got: Column) -> Column:
        share_done = (at + got / 2) / F.col("target")
        out = F.lit(None).cast("double")
        for i, s in enumerate(schedules):
            out = F.when(F.col("slot") == i, position(share_done, s)).otherwise(out)
        return F.when(got > 0, out)

    return mixed.select(F.col("id").alias(id_col), "text_hash", F.col("src").alias(source_col), "size", "source_size", "target",
                        (one + two).alias("taken"), ((one > 0).cast("int") + (two > 0).cast("int")).alias("copies"),
                        when(before, one).alias("position"), when(second, two).alias("next_position"))


def training_order(df: DataFrame, mix: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that the mix takes, once for each copy, range-sorted by
    training position: each output partition is one stretch of training."""
    spots = shared_table(mix.select(
        F.col(id_col).alias("_id"), F.col("text_hash").alias("_th"),
        F.explode(F.filter(F.array("position", "next_position"), lambda x: x.isNotNull())).alias("_position")), "positions")
    rows = as_row(df, _own=id_col, _text=text_col).withColumn("_hash", F.xxhash64("_text"))
    if mix.groupBy(id_col, "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
        rows = rows.dropDuplicates(["_own", "_hash"])           # the places of repeated rows are all in ``spots``
    hit = rows.hint("merge").join(spots, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_th")))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return hit.repartitionByRange(n, "_position").sortWithinPartitions("_position").select(*restored(df, _own=id_col, _text=text_col))
