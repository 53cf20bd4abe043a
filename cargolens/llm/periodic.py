"""Periodic runs of words: maximal stretches in which words a period apart are equal.

For the words of each text, found in the way of internal pattern matching:

1. Dyadic blocks of words are named by prefix doubling; blocks are equal if and
   only if their names are.  The names refine one order of all places, a suffix
   array in which every name is one interval.  (Names are by document; places
   whose first ``BLOCK`` words occur once in it are left out.)
2. A run of period p has a block, about half as long as p at least, whose copy
   p words on is in the run too.  Each block asks for its occurrences in the
   windows beside it that its level stands for: a range successor search in a
   wavelet tree over its interval.
3. The occurrences of a block in a window as short as the block itself are an
   arithmetic progression, known by its first, second and last member.  Its
   members give candidate periods; those that lie in the same stretch of the
   progression's own difference as the block aren't smallest periods (Fine and
   Wilf) and are left out.
4. A candidate grows to both sides by comparing names, from long blocks to
   short ones.  Stretches of enough words are runs; of equal stretches the one
   with the smallest period stays.

Documents go through these steps together, about ``WORDS`` words at a time; a
longer text goes alone and needs 4 bytes a word for every doubling that it has
repeated blocks of.  Rows don't meet each other, so there is no shuffle.

Defined results: a null or empty text, or one of white space alone, has no runs
(collapsed: null stays null, else empty); repeated rows each get their result;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import as_row, prepare_long, restored

MIN_LENGTH = 12                  # words of a run; runs are twice their period at least
WORDS = 1 << 18                  # words that are searched together
BLOCK, STRIDE, BASE = 4, 3, 2    # the shortest blocks: 4 words (level 2) at every third word
RUNS = ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))


class WaveletTree:
    """Counts and order statistics of value ranges in intervals of an array, for
    many queries at a time."""

    def __init__(self, values: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.zeros = []                           # for each bit from the highest: zeros before each place
        for b in reversed(range(self.bits)):
            one = (values >> b) & 1 == 1
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values in [lo, hi) are smaller than x."""
        lo, hi = lo.copy(), hi.copy()
        found = np.where(x >= 1 << self.bits, hi - lo, 0)
        for b, zeros in zip(reversed(range(self.bits)), self.zeros):
            one = (x >> b) & 1 == 1
            a, z = zeros[lo], zeros[hi]
            found = np.where(one & (x < 1 << self.bits), found + z - a, found)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - z, z)
        return found

    def nth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) in [lo, hi)."""
        lo, hi, k = lo.copy(), hi.copy(), k.copy()
        value = np.zeros(len(lo), np.int64)
        for b, zeros in zip(reversed(range(self.bits)), self.zeros):
            a, z = zeros[lo], zeros[hi]
            one = k >= z - a
            k = np.where(one, k - (z - a), k)
            value += one.astype(np.int64) << b
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - z, z)
        return value


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, first place of each one's group in it, and the groups' sizes (both in that order)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    fresh = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    size = np.diff(np.concatenate([fresh, [len(keys)]]))
    return order, np.repeat(fresh, size), np.repeat(size, size)


class Blocks:
    """Names of all dyadic blocks of a sequence that occur more than once, and
    the places in an order in which every name from ``BLOCK`` words on is an interval."""

    def __init__(self, words: np.ndarray):
        n = self.n = len(words)
        times = np.bincount(words) if n else np.zeros(0, np.int64)
        name = np.full(n + 1, -1, np.int64)
        name[:n] = np.where(times[words] > 1, words, -1) if n else words
        self.names = [name.astype(np.int32)]      # by level, -1 for blocks that occur once
        at = np.flatnonzero(name[:n] >= 0)
        slots = None                              # from level BASE on: the places of ``at`` in the order
        self.order = np.zeros(0, np.int64)
        self.intervals: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        level = 0
        while len(at):
            second = name[np.minimum(at + (1 << level), n)]
            if slots is None:
                at, second = at[second >= 0], second[second >= 0]
            if not len(at):
                break
            order, first, size = _grouped(name[at] * (n + 2) + second + 1)
            at, repeated = at[order], (size > 1) & (second[order] >= 0)
            level += 1
            if level == BASE:
                at, first, size = at[repeated], first[repeated], size[repeated]
                # what is left is numbered from 0, group after group
                fresh = np.concatenate([[True], first[1:] != first[:-1]]) if len(at) else np.zeros(0, bool)
                first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(at) else first
                slots, self.order, repeated = np.arange(len(at)), at.copy(), np.ones(len(at), bool)
                begin = first
            elif level > BASE:
                self.order[slots] = at
                begin = slots[first]
                at, slots, begin, size = at[repeated], slots[repeated], begin[repeated], size[repeated]
            else:
                at, begin, size = at[repeated], first[repeated], size[repeated]
            if not len(at):
                break
            name = np.full(n + 1, -1, np.int64)
            name[at] = begin
            self.names.append(name.astype(np.int32))
            if level >= BASE:
                self.intervals.append((at, begin, begin + size))

    def alike_after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i < j)."""
        got = np.zeros(len(i), np.int64)
        for level in reversed(range(len(self.names))):
            name = self.names[level]
            a = name[i + got]
            got += ((a >= 0) & (a == name[np.minimum(j + got, self.n)])).astype(np.int64) << level
        return got

    def alike_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j (i < j)."""
        got = np.zeros(len(i), np.int64)
        for level in reversed(range(len(self.names))):
            name, a = self.names[level], i - got - (1 << level)
            left = name[np.maximum(a, 0)]
            got += ((a >= 0) & (left >= 0) & (left == name[np.maximum(j - got - (1 << level), 0)])).astype(np.int64) << level
        return got


def candidates(blocks: Blocks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of all stretches that could be runs: the block at the place occurs a period later."""
    if not blocks.intervals:
        return
    tree = WaveletTree(blocks.order, blocks.n)
    for level, (at, lo, hi) in enumerate(blocks.intervals, BASE):
        words = 1 << level
        mine = at % (STRIDE if level == BASE else words) == 0
        at, lo, hi = at[mine], lo[mine], hi[mine]
        nearest, farthest = (1 if level == BASE else 2 * words - 1), 4 * words - 2
        for begin in range(nearest, farthest + 1, words):
            end = min(begin + words, farthest + 1)          # occurrences begin in [at + begin, at + end)
            less = tree.below(lo, hi, at + begin)
            count = tree.below(lo, hi, at + end) - less
            some = count > 0
            b, low, high, less, count = at[some], lo[some], hi[some], less[some], count[some]
            if not len(b):
                continue
            first = tree.nth(low, high, less) - b
            step = np.ones(len(b), np.int64)
            more = count > 1
            step[more] = tree.nth(low[more], high[more], less[more] + 1) - b[more] - first[more]
            skip = np.zeros(len(b), np.int64)               # members in the block's own stretch of period ``step``
            many = np.flatnonzero((count > 2) & (first > step))
            reach = blocks.alike_after(b[many], b[many] + step[many]) + step[many]
            skip[many] = np.maximum(0, (reach - words - first[many]) // step[many] + 1)
            rest = np.maximum(0, count - skip)
            which = np.repeat(np.arange(len(b)), rest)
            member = np.arange(len(which)) - np.repeat(np.cumsum(rest) - rest, rest) + skip[which]
            yield b[which], first[which] + member * step[which]


def runs_of(words: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """(start, length, period) of all runs, by start, then period.  ``words`` are small whole numbers, equal for equal words."""
    if min_length < MIN_LENGTH:
        raise ValueError(f"runs of less than {MIN_LENGTH} words aren't looked for")
    blocks, found = Blocks(np.asarray(words, np.int64)), [np.zeros((0, 3), np.int64)]
    for at, period in candidates(blocks):
        before, after = blocks.alike_before(at, at + period), blocks.alike_after(at, at + period)
        length = before + period + after
        good = length >= np.maximum(min_length, 2 * period)
        found.append(np.unique(np.stack([at[good] - before[good], length[good], period[good]], 1), axis=0))
    runs = np.unique(np.concatenate(found), axis=0)          # by start, length, period
    if len(runs):                                            # of equal stretches the smallest period
        runs = runs[np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(1)])]
    return runs[np.lexsort([runs[:, 2], runs[:, 0]])]


def _collapsed(words: list[bytes], runs: Sequence[tuple[int, int, int]]) -> str:
    """The words without those that a run contains after its first period."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
    return b" ".join(words).decode()


def _results(texts: list[str | None], min_length: int) -> tuple[list, list]:
    """Runs and collapsed texts of some texts; their words are searched together."""
    runs, collapsed, names, offsets = [], [], [], [0]
    split = [(t or "").encode().split() for t in texts]      # at U+0020 and U+0009 to U+000D
    base = 0
    for words in split:
        seen: dict[bytes, int] = {}
        names.extend([seen.setdefault(w, base + len(seen)) for w in words])
        base += len(seen)                                    # a word has another name in another text
        offsets.append(len(names))
    found = runs_of(np.array(names, np.int64), min_length)
    bounds = np.searchsorted(found[:, 0], offsets)
    for i, words in enumerate(split):
        mine = found[bounds[i]:bounds[i + 1]] - [offsets[i], 0, 0]
        mine = list(map(tuple, mine.tolist()))
        runs.append([dict(zip(("start", "length", "period"), r)) for r in mine])
        collapsed.append(None if texts[i] is None else _collapsed(words, mine))
    return runs, collapsed


def periodic_runs(df: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """All columns of ``df``, ``runs`` (array of start, length and period, in words from 0) and ``collapsed``, the words
    that no run repeats, joined by blanks (both in place of columns of that name)."""
    prepare_long(df.sparkSession)
    rows = as_row(df, _text=text_col)
    schema = StructType(list(rows.schema)).add("_runs", RUNS).add("_collapsed", "string")
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end] or "") <= 6 * WORDS):
                    size += len(texts[end] or "")
                    end += 1
                runs, collapsed = _results(texts[begin:end], min_length)
                part = b.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(runs, kind), pa.array(collapsed, pa.string())],
                                                 ["_row", "_text", "_runs", "_collapsed"])
                begin = end

    new = {"runs": "_runs", "collapsed": "_collapsed"}
    return rows.mapInArrow(search, schema).select(*restored(df, tuple(new), _text=text_col),
                                                  *[F.col(v).alias(c) for c, v in new.items()])


def planted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with a repetition in every tenth text, by a hash of the id: with h = crc32 of the decimal id and g =
    floor(h / 10), each word i >= a becomes word a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).
    Texts of null ids, and those of which h isn't divisible by 10, stay as they are."""
    h = F.crc32(F.col("_id").cast("string").cast("binary"))
    chosen = as_row(df, _id=id_col, _text=text_col).withColumn("_h", h).withColumn("_words", F.when(
        F.col("_h") % 10 == 0, F.regexp_extract_all("_text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    g = F.floor(F.col("_h") / 10)
    cut = chosen.withColumn("_n", F.size("_words")).withColumn("_a", F.when(F.col("_n") > 0, (g % F.col("_n")).cast("int")))
    left = F.col("_n") - F.col("_a")
    cut = cut.withColumn("_p", (1 + F.floor(left / (3 + g % 8))).cast("int"))
    copies = F.array_repeat(F.slice("_words", F.col("_a") + 1, F.col("_p")), F.ceil(left / F.col("_p")).cast("int"))
    words = F.concat(F.slice("_words", F.lit(1), F.col("_a")), F.slice(F.flatten(copies), F.lit(1), left))
    text = F.when(F.col("_a").isNotNull(), F.array_join(words, " ")).otherwise(F.col("_text"))
    return cut.withColumn("_new", text).select(*restored(df, _id=id_col, _new=text_col))


def report(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document of :func:`periodic_runs`: its number of runs, the longest one (ties: smallest start, then
    period) and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = df.select(F.col(id_col).alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best.alias("_best"),
                      F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                      F.sha2(F.coalesce("collapsed", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"))
    length, period = F.col("_best.length"), -F.col("_best.period")
    return found.select("doc_id", "n_runs", (-F.col("_best.start")).alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(1000 * length / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
