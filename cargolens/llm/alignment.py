"""Alignment of the tokens of two tokenizers by the bytes they stand for.

1. A text is tokenised whole by both: by A with a blank in front, by B, which
   adds that blank itself.  Only if the bytes of the tokens of each, joined, are
   the text with its blank does the text have tokens.
2. The byte offsets where tokens of both end cut them into groups.  Those before
   two tokens that are both marked with a blank are anchors: they split a
   document into windows, a word each as a rule.  Nothing in a window depends on
   what stands around it, so its groups and links are remembered by its tuples
   of token ids in each Python worker.
3. A document becomes one row with its distinct linked id pairs and how often
   each is linked, and that table is written.  Pairs are counted over it
   (combined before the shuffle), and the highest count of each A id is found.
4. The counts return to the documents.  The most frequent pairs, at most
   ``BROADCAST`` of them by a power of two as least count, are broadcast; only
   rows of the other pairs are shuffled to their counts.

Defined results: texts that are null or empty, or whose tokens don't give their
bytes back, have no tokens: zeros and an empty digest; special tokens' strings
are plain text; repeated rows count as documents of their own; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .common import as_row, prepare_long, restored, shared_table
from .tokens import _ODD_SPACE, _byte_of, default_tokenizer, encoder

SHIFT = 20                       # an id pair is one number: A id << SHIFT | B id
BROADCAST = 1 << 18              # pairs that are broadcast at most
REMEMBERED = 1 << 18             # windows that a worker remembers
# Latin letters, digits and punctuation: no character here joins with a blank before it when a text is normalised.
_LATIN = re.compile(r"[\n -~\u00a1-\u024f\u2010-\u2027\u2030-\u205e\u20ac]*")
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def default_pieces() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class ByteLevel:
    """Ids and token bytes of a byte-level BPE tokenizer; no string is a special token."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte_of = _byte_of()
        spec = json.loads(self.tokenizer.to_str())
        added = {t["id"]: t["content"].encode() for t in spec.get("added_tokens") or []}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes = [added.get(i) or bytes(byte_of.get(c, 0x3F) for c in t) for i, t in enumerate(names)]
        self.ranked = encoder(path).ranked               # the same ids, faster, where that is proven

    def ids(self, text: str) -> np.ndarray:
        if self.ranked is not None:                      # (it has no special tokens)
            return self.ranked.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)


def _steps(ends: np.ndarray) -> np.ndarray:
    """The differences of neighbours, the first from 0."""
    out = ends.copy()
    out[1:] -= ends[:-1]
    return out


class Pieces:
    """Ids and token bytes of a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        self.by_word = not any(b" " in t[1:] and t.strip(b" ") for t in self.bytes)      # no piece reaches across one blank

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), np.int64)


class Aligner:
    """Windows of two tokenizers, remembered by their tuples of ids."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.length_a, self.length_b = (np.array([len(t) for t in k.bytes], np.int64) for k in (a, b))
        self.space_a, self.space_b = (np.array([t[:1] == b" " for t in k.bytes], bool) for k in (a, b))
        self.size = max(len(a.bytes), len(b.bytes))
        self.words = [f"{i}{mark}" for mark in ",|;" for i in range(self.size)]
        self.by_word = getattr(a, "ranked", None) is not None and getattr(b, "by_word", False)
        self.forget()

    def forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.known: dict[str, int] = {}                  # the windows of words
        self.sizes = array("q")                          # of each window: n_a, n_b, n_groups, n_links
        self.text: list[str] = []                        # of each window: its groups as text
        self.first = array("q", [0])                     # and the places of its pairs
        self.pairs, self.times = array("q"), array("q")

    def learn(self, ids_a: np.ndarray, ids_b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray, cut: np.ndarray, new: list[int]) -> None:
        """Groups and links of the windows ``new`` of a document.  Group g has the tokens before ``to_a[g]`` and ``to_b[g]``,
        window w the groups before ``cut[w]``."""
        n_a, n_b = _steps(to_a), _steps(to_b)
        low, high = np.concatenate([[0], cut[:-1]])[new], cut[new]
        size = high - low
        group = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        links, starts = n_a[group] * n_b[group], np.cumsum(size) - size
        if int(links.max()) > 4096:                      # counted, not listed
            found = [self._counted(ids_a, ids_b, to_a - n_a, to_a, to_b - n_b, to_b, range(x, y)) for x, y in zip(low, high)]
            pairs, times = [k for f in found for k in f.keys()], [v for f in found for v in f.values()]
            count = np.array([len(f) for f in found])
        else:
            at = np.repeat(group, links)
            r = np.arange(len(at)) - np.repeat(np.cumsum(links) - links, links)
            pairs = ids_a[(to_a - n_a)[at] + r // n_b[at]] << SHIFT | ids_b[(to_b - n_b)[at] + r % n_b[at]]
            times, count = np.ones(len(at), np.int64), np.add.reduceat(links, starts)
        sizes = [np.add.reduceat(n_a[group], starts), np.add.reduceat(n_b[group], starts), size, np.add.reduceat(n_a[group] * n_b[group], starts)]
        self.sizes.frombytes(np.column_stack(sizes).astype(np.int64).tobytes())
        self.pairs.frombytes(np.asarray(pairs, np.int64).tobytes())
        self.times.frombytes(np.asarray(times, np.int64).tobytes())
        self.first.frombytes((self.first[-1] + np.cumsum(count)).astype(np.int64).tobytes())
        # the windows' texts: a group's A ids, then its B ids, each with the mark that follows it
        la, lb = n_a[group], n_b[group]
        off = np.cumsum(la + lb) - la - lb
        marked = np.zeros(int((la + lb).sum()), np.int64)
        for ids, to, n, at, mark in ((ids_a, to_a, la, off, 1), (ids_b, to_b, lb, off + la, 2)):
            ramp = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            marked[np.repeat(at, n) + ramp] = ids[np.repeat(to[group] - n, n) + ramp]
            marked[at + n - 1] += mark * self.size
        words = list(map(self.words.__getitem__, marked.tolist()))
        ends = [*off[starts].tolist(), len(words)]
        self.text.extend(["".join(words[x:y])[:-1] for x, y in zip(ends, ends[1:])])

    @staticmethod
    def _counted(ids_a, ids_b, from_a, to_a, from_b, to_b, groups) -> Counter[int]:
        """Distinct pairs of some groups and how often each is linked."""
        links: Counter[int] = Counter()
        for g in groups:
            right = Counter(ids_b[from_b[g]:to_b[g]].tolist())
            for p, m in Counter(ids_a[from_a[g]:to_a[g]].tolist()).items():
                for q, n in right.items():
                    links[p << SHIFT | q] += m * n
        return links

    def document(self, text: str | None) -> tuple[int, int, int, int, str, list[int]]:
        """n_a, n_b, n_groups, n_links, digest of the groups, and the windows."""
        windows = self._by_word(text) if text and self.by_word else None
        if windows is None and text:
            windows = self._whole(text)
        if not windows:
            return 0, 0, 0, 0, "", []
        digest = hashlib.sha256(";".join(map(self.text.__getitem__, windows)).encode()).hexdigest()
        sizes = np.frombuffer(self.sizes, np.int64).reshape(-1, 4)[windows].sum(0)
        return *sizes.tolist(), digest, windows

    def _by_word(self, text: str) -> list[int] | None:
        """The windows of a text whose words are apart by one blank: a word each.  Tokens of neither reach across such a
        blank, and both mark the next one with it.  Words not seen before are tokenised together; None: not such a text."""
        if _ODD_SPACE.search(text) or not _LATIN.fullmatch(text):
            return None
        words = text.split(" ")
        windows = list(map(self.known.get, words))
        if None in windows:
            new = list(dict.fromkeys(w for w, number in zip(words, windows) if number is None))
            found = self._whole(" ".join(new))
            if found is None or len(found) != len(new):
                return None
            self.known.update(zip(new, found))
            windows = list(map(self.known.__getitem__, words))
        return windows

    def _whole(self, text: str) -> list[int] | None:
        """The windows of a text that is tokenised whole; None: its bytes don't come back."""
        data = (" " + text).encode()
        ids_a, ids_b = self.a.ids(" " + text), self.b.ids(text)
        if any(b"".join(map(k.bytes.__getitem__, ids.tolist())) != data for k, ids in ((self.a, ids_a), (self.b, ids_b))):
            return None
        end_a, end_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        ends = np.zeros(len(data) + 1, np.int8)
        ends[end_a] = 1
        ends[end_b] += 1                                 # no token is empty, so an end occurs once in each
        to_a, to_b = np.flatnonzero(ends[end_a] == 2) + 1, np.flatnonzero(ends[end_b] == 2) + 1
        anchor = np.ones(len(to_a), bool)
        anchor[:-1] = self.space_a[ids_a[to_a[:-1]]] & self.space_b[ids_b[to_b[:-1]]]
        return self._windows(ids_a, ids_b, to_a, to_b, np.flatnonzero(anchor) + 1)

    def _windows(self, ids_a: np.ndarray, ids_b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray, cut: np.ndarray) -> list[int]:
        """The number of each window."""
        # one array with A's ids, a mark and B's ids of each window, so that a slice of its bytes is a key
        wa, wb = to_a[cut - 1], to_b[cut - 1]
        na, nb, k = _steps(wa), _steps(wb), np.arange(len(cut))
        stream = np.full(len(ids_a) + len(ids_b) + len(cut), 0xFFFFFFFF, "<u4")
        stream[np.arange(len(ids_a)) + np.repeat(wb - nb + k, na)] = ids_a
        stream[np.arange(len(ids_b)) + np.repeat(wa + k + 1, nb)] = ids_b
        data, ends = stream.tobytes(), [0, *(4 * (wa + wb + k + 1)).tolist()]
        keys = [data[x:y] for x, y in zip(ends, ends[1:])]
        windows = list(map(self.memo.get, keys))
        new = []
        for w in [w for w, number in enumerate(windows) if number is None]:
            number = self.memo.get(keys[w])              # it may have been new a few words before
            if number is None:
                number = self.memo[keys[w]] = len(self.text) + len(new)
                new.append(w)
            windows[w] = number
        if new:
            self.learn(ids_a, ids_b, to_a, to_b, cut, new)
        return windows

    def documents(self, texts: list[str | None]) -> tuple[list[tuple], pa.Array, pa.Array]:
        """The numbers of each text, and its distinct pairs and how often each is linked."""
        if len(self.text) > REMEMBERED or len(self.pairs) > 8 * REMEMBERED:
            self.forget()
        rows = [self.document(t) for t in texts]
        count = np.array([len(r[5]) for r in rows], np.int64)
        windows = np.array([w for r in rows for w in r[5]], np.int64)
        first, pairs, times = (np.frombuffer(x, np.int64).copy() if len(x) else np.zeros(0, np.int64)
                               for x in (self.first, self.pairs, self.times))
        size = first[windows + 1] - first[windows]
        place = np.repeat(first[windows] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        key = np.repeat(np.repeat(np.arange(len(rows)), count), size) << 2 * SHIFT | pairs[place]
        time = times[place]
        if len(time) and int(time.max()) > 1:
            order = np.argsort(key)
            key, time = key[order], time[order]
        else:
            key = np.sort(key)
        fresh = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        time = np.add.reduceat(time, fresh) if len(fresh) else time
        doc, key = key[fresh] >> 2 * SHIFT, key[fresh] & ((1 << 2 * SHIFT) - 1)
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(rows)))]), pa.int32())
        return rows, pa.ListArray.from_arrays(offsets, pa.array(key)), pa.ListArray.from_arrays(offsets, pa.array(time))


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner for each pair of tokenizer files and Python worker."""
    return Aligner(ByteLevel(path_a), Pieces(path_b))


def aligned(df: DataFrame, text_col: str = "text", tokenizer_a: str | None = None, tokenizer_b: str | None = None) -> DataFrame:
    """(_row, rid, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of each row of ``df``, whose other columns are
    in ``_row``; pairs holds each id pair that the text links once, times how often."""
    prepare_long(df.sparkSession)
    path_a, path_b = tokenizer_a or default_tokenizer(), tokenizer_b or default_pieces()
    rows = as_row(df, _text=text_col).withColumn("rid", F.monotonically_increasing_id())
    schema = StructType(list(rows.schema))
    for c in COUNTS:
        schema = schema.add(c, "long")
    schema = schema.add("groups_sha256", "string").add("pairs", ArrayType(LongType())).add("times", ArrayType(LongType()))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for b in batches:
            found, pairs, times = both.documents(b.column("_text").to_pylist())
            numbers = [pa.array([r[k] for r in found], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*b.columns, *numbers, pa.array([r[4] for r in found], pa.string()), pairs, times],
                                             schema.names)

    return rows.mapInArrow(align, schema)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, count, best): how many documents hold each id pair linked, and whether no pair of its A id is in more."""
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("count"))
    counts = shared_table(counts, "pair_counts")
    highest = counts.groupBy(F.shiftright("pair", SHIFT).alias("_a")).agg(F.max("count").alias("_highest"))
    joined = counts.join(highest, F.shiftright("pair", SHIFT) == F.col("_a"))
    return joined.select("pair", "count", (F.col("count") == F.col("_highest")).alias("best"))


def least_broadcast(counts: DataFrame, limit: int = BROADCAST) -> int:
    """The smallest power of two such that at most ``limit`` pairs have that count or more (1: all of them)."""
    power = F.floor(F.log2(F.col("count") + F.lit(0.5))).cast("int")      # a row for each bit length: 64 at most
    sizes = {r["p"]: r["n"] for r in counts.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, least = 0, 64
    for p in sorted(sizes, reverse=True):
        total += sizes[p]
        if total > limit:
            break
        least = p
    return 1 if total <= limit else 1 << min(least, 62)


def align_tokenizers(df: DataFrame, text_col: str = "text", tokenizer_a: str | None = None, tokenizer_b: str | None = None,
                     limit: int = BROADCAST) -> DataFrame:
    """All columns of ``df`` and, in place of columns of these names, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256: tokens of both tokenizers, groups, links, links whose id pair is the most frequent of its A id over all
    documents, the sum of the links' counts, and the digest of the groups."""
    new = [*COUNTS, "n_best", "count_sum", "groups_sha256"]
    found = shared_table(aligned(df, text_col, tokenizer_a, tokenizer_b), "aligned")
    counts = shared_table(pair_counts(found), "counted_pairs")
    links = found.select("rid", F.explode(F.arrays_zip("pairs", "times")).alias("e")).select(
        "rid", F.col("e.pairs").alias("_pair"), F.col("e.times").alias("_times"))
    sums = [F.sum(F.when(F.col("best"), F.col("_times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("_times") * F.col("count")).alias("count_sum")]
    least = least_broadcast(counts, limit)
    frequent = F.broadcast(counts.filter(F.col("count") >= least))
    totals = links.join(frequent, F.col("_pair") == F.col("pair")).groupBy("rid").agg(*sums)
    if least > 1:                                        # the other pairs are rare: their rows go to the counts
        others = links.join(frequent.select("pair"), F.col("_pair") == F.col("pair"), "left_anti")
        rare = counts.filter(F.col("count") < least).hint("merge")
        rest = others.join(rare, F.col("_pair") == F.col("pair")).groupBy("rid").agg(*sums)
        totals = totals.unionByName(rest).groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    totals = totals.select(F.col("rid").alias("_rid"), "n_best", "count_sum")
    joined = found.drop("pairs", "times").join(totals, F.col("rid") == F.col("_rid"), "left")
    zero = F.lit(0).cast("long")
    return joined.select(*restored(df, new, _text=text_col), *[
        F.coalesce(c, zero).alias(c) if c in ("n_best", "count_sum") else F.col(c) for c in new])
