"""Best-fit packing of documents into sequences, planned on counts.

1. Each document is encoded, gets the separator id, and is cut into pieces of
   at most ``capacity`` tokens; only longer documents are cut, and the first
   piece takes the remainder.
2. The plan: best-fit decreasing over the histogram of piece lengths.  It works
   on counts -- a group of equal sequences is filled at once -- so its size
   depends on the number of distinct lengths (at most ``capacity``), never on
   the number of documents.
3. Pieces take the planned slots by their rank within their length.

Defined results: a null or empty text is a document of the separator alone;
repeated rows are packed once for each row; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import bucket_count, prepare, running, shared_table
from .tokens import default_tokenizer, encoder

CAPACITY = 2048
SEPARATOR = 0


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) for every piece."""
    prepare(df.sparkSession)
    path = tokenizer or default_tokenizer()
    narrow = df.select(F.col(id_col), F.col(text_col).alias("_text"))
    schema = StructType([narrow.schema[id_col]]).add("piece", "integer").add("start", "long").add("length", "long") \
        .add("ids_crc32", "long")
    names = [id_col, "piece", "start", "length", "ids_crc32"]
    if with_ids:
        from pyspark.sql.types import ArrayType, LongType
        schema = schema.add("ids", ArrayType(LongType()))
        names.append("ids")
    end = int(SEPARATOR).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            row, no, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                packed = enc.packed(text) + end
                n = len(packed) // 4
                lo, hi, k = 0, n % capacity or capacity, 0
                hi = min(hi, n)
                while lo < n:
                    part = packed[4 * lo:4 * hi]
                    row.append(i)
                    no.append(k)
                    start.append(lo)
                    length.append(hi - lo)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int64))
                    lo, hi, k = hi, hi + capacity, k + 1
            cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(no, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(cols, names)

    return narrow.mapInArrow(cut, schema)


def plan_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, ...]], int]:
    """Best-fit decreasing over counts of lengths.

    Returns slot runs ``(length, rank, n, per_sequence, sequence, offset)`` and
    the number of sequences: the pieces of ``length`` with ranks in
    ``[rank, rank + n)`` go, ``per_sequence`` in each, to the sequences from
    ``sequence`` on, beginning at ``offset``.
    """
    open_groups: dict[int, list[tuple[int, int]]] = defaultdict(list)   # room left -> (first sequence, how many)
    rooms: list[int] = []                                               # sorted rooms that may have groups
    runs: list[tuple[int, ...]] = []
    n_seq = 0

    def give_back(room: int, first: int, many: int) -> None:
        if many and room:
            open_groups[room].append((first, many))

    def fill(length: int, rank: int, left: int, room: int, first: int, many: int) -> int:
        """Fill up to ``many`` equal sequences; returns how many pieces went in."""
        per = room // length
        full = min(many, left // per)
        placed = full * per
        if full:
            runs.append((length, rank, placed, per, first, capacity - room))
            give_back(room - per * length, first, full)
        rest = left - placed
        if full < many:
            if rest:                                    # the last pieces don't fill one more sequence
                runs.append((length, rank + placed, rest, rest, first + full, capacity - room))
                give_back(room - rest * length, first + full, 1)
                placed += rest
                full += 1
            give_back(room, first + full, many - full)
        return placed

    for length in sorted((x for x, c in counts.items() if c > 0), reverse=True):
        left, rank = counts[length], 0
        rooms = [r for r in open_groups if open_groups[r] and r >= length]
        heapq.heapify(rooms)
        while left and rooms:
            room = rooms[0]
            if not open_groups[room]:
                heapq.heappop(rooms)
                continue
            first, many = open_groups[room].pop()
            placed = fill(length, rank, left, room, first, many)
            left, rank = left - placed, rank + placed
        if left:
            many = -(-left // (capacity // length))
            first, n_seq = n_seq, n_seq + many
            fill(length, rank, left, capacity, first, many)
    return runs, n_seq


def pack(parts: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the pieces."""
    parts = shared_table(parts, "pieces")
    # one row per distinct length, at most ``capacity`` of them
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = plan_best_fit(counts, capacity)
    by_length: dict[int, np.ndarray] = {}
    for length in counts:
        by_length[length] = np.array(sorted(r[1:] for r in runs if r[0] == length), dtype=np.int64)
    order = [id_col, "piece", "start", "ids_crc32"]
    hashed = parts.withColumn("_h", F.xxhash64(*order))
    ranked = running(hashed, ["length"], "_h", ["_h", *order], F.lit(1).cast("long"),
                     bucket_count(sum(counts.values())), "_rank").drop("_h")
    schema = StructType(list(parts.schema.fields)).add("sequence_id", "long").add("offset", "long")
    names = schema.names

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy()
            rank = b.column(b.num_columns - 1).to_numpy()
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                at = np.flatnonzero(length == one)
                slots = by_length[int(one)]
                run = slots[np.searchsorted(slots[:, 0], rank[at], "right") - 1]
                nth = rank[at] - run[:, 0]
                seq[at] = run[:, 3] + nth // run[:, 2]
                off[at] = run[:, 4] + nth % run[:, 2] * one
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(seq), pa.array(off)], names)

    return ranked.mapInArrow(place, schema)


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places in the packed sequences."""
    return pack(pieces(df, id_col, text_col, capacity, tokenizer, with_ids), id_col, capacity)
