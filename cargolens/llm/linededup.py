"""Line dedup with content-defined chunks (DataFrame functions only).

1. A text is cut into short lines: at its line breaks, and soft-wrapped after
   punctuation and after words that end in certain letters, a digit or any other
   character than ASCII, so that a passage inside a paragraph consists of whole
   lines too.
2. A hash rolls over the line hashes (two lines at a time); a chunk
   begins where it has a local minimum.  The places depend on nearby lines
   only, so equal passages get equal chunks wherever they stand, and every
   chunk has two lines at least.
3. Chunk hashes are counted over the whole table (combined before the shuffle).
   Of a chunk that several documents have, the document with the smallest id
   keeps it.
4. Bytes are compared before anything is removed: all occurrences of a hash
   must be the same text; a hash that stands for several texts removes nothing.
5. Runs of neighbouring repeated chunks of at least ``ANCHOR`` bytes grow word by
   word to both sides, as long as the words equal those around the chunk in the
   document that keeps it; a run goes if it then has ``min_bytes`` bytes (UTF-8).

Chunk rows carry hashes and places.  Only spans and up to ``REACH`` lines beside
a run are compared as texts: but for one line over and over, a matching stretch
of that length has a whole chunk, which is part of the run.  A chunk that a
third of all documents share is a hot key of a join whose other side is a
written table with one row per hash, which adaptive execution splits.

Defined results: null stays null, empty stays empty; rows that repeat an id and
text are one document and get the same result; where ids are null or repeated
with other texts, the order of the files decides which document is first;
repeats inside one document stay; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import attach, global_running
from .common import as_row, restored, shared_table

# A short line ends after a line break, after a blank that follows one of these, and after full-width punctuation.
LAST = r".,;:!?esn0-9\x{80}-\x{10FFFF}"
WIDE = "\u3001\u3002\uff0c\uff0e\uff1a\uff1b\uff01\uff1f"
MIN_BYTES = 72
ANCHOR = 36                                  # bytes of a run before it grows
REACH = 16                                   # lines beside a run that are compared


def short_lines(text: Column) -> Column:
    """The text's lines, ends included: joined they are the text again."""
    return F.split(text, rf"(?<=\n)|(?<=[{LAST}] )|(?<=[{WIDE}])")


def _bare(line: Column) -> Column:
    """A line without the blanks at its end: what is hashed and compared."""
    return F.rtrim(line)


def chunk_rows(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, h, start, lines, bytes) for every chunk of every text."""
    lines = df.select(key, short_lines(F.col(text_col)).alias("l"))
    hashed = lines.select(key, F.transform("l", lambda x: F.xxhash64(_bare(x))).alias("h"),
                          F.transform("l", F.octet_length).alias("c"), F.size("l").alias("n"))
    rolled = hashed.select("*", F.zip_with("h", F.slice("h", F.lit(2), F.col("n")), lambda a, b: F.xxhash64(
        a, F.coalesce(b, F.lit(0).cast("long")))).alias("r"))
    # step[i] says how the hash after i compares with that at i; a local minimum comes after a fall and before a rise.
    # (It is used twice below: an array used once would be evaluated again for every element of the lambda.)
    steps = rolled.select(key, "h", "c", "n", F.zip_with("r", F.slice("r", F.lit(2), F.col("n")), lambda a, b: F.when(
        a < b, F.lit(1)).when(a > b, F.lit(-1)).otherwise(F.lit(0))).alias("step"))
    place = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: (i == 0) | (
        (F.get("step", i) == 1) & (F.get("step", i - 1) == -1) & (i >= 2) & (i <= F.col("n") - 2)))
    starts = steps.select(key, "h", "c", "n", place.alias("s"))
    chunk = F.transform("s", lambda at, k: F.struct(
        at.alias("start"), (F.coalesce(F.get("s", k + 1), F.col("n")) - at).alias("lines")))
    cut = starts.select(key, "h", "c", chunk.alias("k"))
    rows = cut.select(key, F.explode(F.transform("k", lambda x: F.struct(
        F.xxhash64(F.slice("h", x["start"] + 1, x["lines"])).alias("h"), x["start"].alias("start"), x["lines"].alias("lines"),
        F.aggregate(F.slice("c", x["start"] + 1, x["lines"]), F.lit(0), lambda a, b: a + b).alias("bytes")))).alias("e"))
    return rows.filter(F.col("e.lines") > 1).select(key, "e.h", "e.start", "e.lines", "e.bytes")


def repeated_chunks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, text_hash, spans): the chunks of each document that are in a run to grow (``dup``) or that it keeps
    for these, in order.  (No text_hash if ids are unique.)"""
    docs = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    ids = docs.select("id").groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.max("n").alias("n"), F.max(F.col("id").isNull().cast("int")).alias("null")).first()
    unique = (ids["n"] or 0) <= 1 and not ids["null"] and dict(docs.dtypes)["id"] in ("bigint", "int")
    if unique:
        named = docs.select(F.col("id").cast("long").alias("key"), "text")
        names = None
    else:
        # documents by rank of (id, text hash), nulls last: only these are put in order, the texts are joined by them
        order = [F.asc_nulls_last("id"), F.asc_nulls_last("text_hash")]
        ranked = global_running(docs.select("id", "text_hash").distinct(), order, index_col="key")
        names = shared_table(ranked.select("key", "id", "text_hash"), "documents")
        texts = docs.groupBy("id", "text_hash").agg(F.any_value("text").alias("text"))
        ranks = names.select("key", F.col("id").alias("_id"), F.col("text_hash").alias("_hash"))
        named = texts.join(ranks, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))).select("key", "text")
    chunks = shared_table(chunk_rows(named, "key", "text"), "chunks", "snappy")
    shared = (chunks.groupBy("h").agg(F.min("key").alias("first"), F.max("key").alias("last"))
              .filter(F.col("first") != F.col("last")).select(F.col("h").alias("_h"), "first"))
    shared = shared_table(shared, "repeated")
    hits = chunks.join(shared.hint("shuffle_hash"), F.col("h") == F.col("_h")).select(
        "key", "h", "start", "lines", "bytes", (F.col("key") != F.col("first")).alias("dup"))
    hits = shared_table(hits, "hits")
    by_place = Window.partitionBy("key").orderBy("start")
    fresh = F.coalesce(F.lag(F.col("start") + F.col("lines")).over(by_place) != F.col("start"), F.lit(True))
    runs = hits.filter("dup").withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(by_place))
    runs = runs.withColumn("whole", F.sum("bytes").over(Window.partitionBy("key", "run"))).filter(F.col("whole") >= ANCHOR)
    # l, r: the run ends on that side of the chunk, or one does in another document
    end = F.col("start") + F.col("lines")
    runs = runs.withColumns({"l": fresh, "r": F.coalesce(F.lead("start").over(by_place) != end, F.lit(True))})
    runs = shared_table(runs.select(*hits.columns, "l", "r"), "anchors")
    wanted = runs.groupBy(F.col("h").alias("_h")).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    kept = hits.filter(~F.col("dup")).join(wanted.hint("shuffle_hash"), F.col("h") == F.col("_h")).drop("_h")
    spans = runs.unionByName(kept).groupBy("key").agg(F.array_sort(F.collect_list(
        F.struct("start", "lines", "h", "bytes", "dup", "l", "r"))).alias("spans"))
    if names is None:
        return spans.select("key", F.col("key").alias("id"), "spans")
    return spans.join(names, "key").select("key", "id", "text_hash", "spans")


def _words(lines: Column) -> Column:
    """The words of lines, with the blanks after them."""
    return F.filter(F.split(F.array_join(lines, ""), r"(?<=\s)"), lambda w: w != "")


def _alike(a: str, b: str) -> Column:
    """How many words two arrays have in common at their beginnings."""
    same = F.zip_with(a, b, lambda x, y: _bare(x).eqNullSafe(_bare(y)))
    first = F.array_position(same, F.lit(False))
    return F.coalesce(F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int"), F.lit(0))


def grown_runs(spans: DataFrame, min_bytes: int) -> DataFrame:
    """(key, gone): the stretches to be removed from each document: lines from start to end, and up and down, the
    characters before and after them.
    ``spans``: (key, start, lines, h, bytes, dup, t, before, after), the words before in reverse order."""
    # byte comparison: a repeated hash must stand for one text in all documents
    unequal = spans.groupBy("h").agg(F.min("t").alias("a"), F.max("t").alias("b")).filter(F.col("a") != F.col("b"))
    good = attach(spans.drop("t"), unequal.agg(F.collect_set("h").alias("_unequal"))).filter(
        ~F.array_contains("_unequal", F.col("h"))).drop("_unequal")
    by_place = Window.partitionBy("key").orderBy("start")
    end = F.col("start") + F.col("lines")
    dups = good.filter("dup").select("key", "h", "start", "lines", "bytes", "before", "after")
    dups = dups.withColumns({"l": F.coalesce(F.lag(end).over(by_place) != F.col("start"), F.lit(True)),
                             "r": F.coalesce(F.lead("start").over(by_place) != end, F.lit(True))})
    dups = shared_table(dups.withColumn("run", F.sum(F.col("l").cast("int")).over(by_place)).withColumns({
        "before": F.when(F.col("l"), F.col("before")), "after": F.when(F.col("r"), F.col("after"))}), "runs")
    # the first occurrence in the document that keeps a chunk; one row for each hash
    keeps = good.filter(~F.col("dup")).groupBy("h").agg(F.min(F.struct("start", "before", "after")).alias("k"))
    keeps = shared_table(keeps.select(F.col("h").alias("_h"), F.col("k.before").alias("_before"), F.col("k.after").alias("_after")), "keeps")
    edges = dups.filter("l OR r").join(keeps.hint("shuffle_hash"), F.col("h") == F.col("_h"))
    edges = edges.withColumns({"up": F.when(F.col("l"), _alike("before", "_before")).otherwise(0),
                               "down": F.when(F.col("r"), _alike("after", "_after")).otherwise(0)})
    edges = edges.select("key", "run", *[F.coalesce(F.array_join(F.slice(F.col(c), F.lit(1), F.col(n)), ""), F.lit("")).alias(n)
                                         for c, n in (("before", "up"), ("after", "down"))])
    more = edges.groupBy("key", "run").agg(F.sum(F.length("up")).cast("int").alias("up"), F.sum(F.length("down")).cast("int").alias("down"),
                                           F.sum(F.octet_length("up") + F.octet_length("down")).alias("more"))
    runs = dups.groupBy("key", "run").agg(F.min("start").alias("start"), F.max(end).alias("end"),
                                          F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("chunks"))
    whole = runs.join(more, ["key", "run"]).filter(F.col("bytes") + F.col("more") >= min_bytes)
    return whole.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "up", "down", "chunks"))).alias("gone"))


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """All columns of ``df``, the text without its repeated passages, and
    ``removed_chunks`` and ``removed_chars`` (in place of columns of that name)."""
    found = shared_table(repeated_chunks(df, id_col, text_col), "spans")
    rows = as_row(df, _doc=id_col, _text=text_col)

    def of_document(found: DataFrame) -> Column:
        on = F.col("_doc").eqNullSafe(F.col("id"))
        return on & (F.xxhash64("_text") == F.col("text_hash")) if "text_hash" in found.columns else on

    lines = rows.join(found.hint("shuffle_hash"), of_document(found)).select("key", "spans", short_lines(F.col("_text")).alias("l"))
    if "text_hash" in found.columns:
        lines = lines.dropDuplicates(["key"])              # repeated rows are one document

    def beside(s: Column) -> tuple[Column, Column]:
        before = F.slice("l", F.greatest(F.lit(1), s["start"] + 1 - REACH), F.least(s["start"], F.lit(REACH)))
        after = F.slice("l", s["start"] + s["lines"] + 1, F.lit(REACH))
        return F.reverse(_words(before)), _words(after)

    spans = lines.select("key", F.explode(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["lines"].alias("lines"), s["h"].alias("h"), s["bytes"].alias("bytes"), s["dup"].alias("dup"),
        F.array_join(F.transform(F.slice("l", s["start"] + 1, s["lines"]), _bare), "\n").alias("t"),
        F.when(s["l"], beside(s)[0]).alias("before"), F.when(s["r"], beside(s)[1]).alias("after")))).alias("e"))
    spans = shared_table(spans.select("key", "e.*"), "beside")
    gone = grown_runs(spans, min_bytes).join(found.drop("spans"), "key").drop("key")
    gone = shared_table(gone, "gone").withColumnRenamed("gone", "_gone")
    cut = rows.join(gone.hint("shuffle_hash"), of_document(gone), "left").withColumn(
        "_lines", F.when(F.col("_gone").isNotNull(), short_lines(F.col("_text"))))

    # the text that stays: the lines from one removed stretch to the next without the words these grew by (two can overlap)
    stops = cut.withColumns({
        "_from": F.concat(F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("off"))),
                          F.transform("_gone", lambda s: F.struct(s["end"].alias("at"), s["down"].alias("off")))),
        "_to": F.concat(F.transform("_gone", lambda s: F.struct(s["start"].alias("at"), s["up"].alias("off"))),
                        F.array(F.struct(F.size("_lines").alias("at"), F.lit(0).alias("off"))))})
    between = F.zip_with("_from", "_to", lambda a, b: F.struct(
        F.array_join(F.slice("_lines", a["at"] + 1, b["at"] - a["at"]), "").alias("t"), (a["off"] + b["off"]).alias("less"), a["off"].alias("off")))
    kept = F.array_join(F.transform(between, lambda x: F.substring(
        x["t"], x["off"] + 1, F.greatest(F.lit(0), F.length(x["t"]) - x["less"]))), "")
    result = stops.withColumn("_left", F.when(F.col("_gone").isNotNull(), kept).otherwise(F.col("_text")))
    chunks = F.aggregate("_gone", F.lit(0).cast("long"), lambda n, s: n + s["chunks"])
    removed = {"removed_chunks": F.coalesce(chunks, F.lit(0).cast("long")),
               "removed_chars": F.coalesce(F.length("_text") - F.length("_left"), F.lit(0)).cast("long")}
    return result.select(*restored(df, tuple(removed), _doc=id_col, _left=text_col), *[v.alias(c) for c, v in removed.items()])
