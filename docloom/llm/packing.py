"""Best-fit decreasing packing of token pieces into sequences of bounded length.

Every document is encoded, ended by id 0 and, if longer than a sequence, cut into full pieces and a
rest. Best-fit decreasing takes pieces by falling length and puts each into the open sequence with
the least room that holds it, found in a segment tree over remaining capacities in logarithmic
time. Pieces of equal length are interchangeable, so the tree is driven by the histogram of lengths
(at most ``capacity`` counts, whatever the size of the corpus): a run of equal pieces meets a run of
equally full sequences, and one step fills as many as both allow. The outcome is that of placing
the pieces one by one. Ranks within a length come from counts per task (joined by length and task,
both sides dealt out), so no task ever holds all pieces of a length. The runs are sent to all tasks:
their number is bounded by the capacity alone (``best_fit_runs``), not by the corpus; each piece finds
its own by binary search.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import doc_text, materialize, table
from .tokens import arrow_slices, default_tokenizer, encoder

CAPACITY = 2048


class CapacityTree:
    """Segment tree over remaining capacities 0 to ``capacity``: which have open sequences, and the tightest that fits."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.leaves)

    def set(self, room: int, is_open: bool) -> None:
        i = room + self.leaves
        self.any[i] = is_open
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def tightest(self, need: int) -> int:
        """The least room of at least ``need`` that some open sequence has, or -1."""
        i = need + self.leaves
        if self.any[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def best_fit_runs(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, last rank, first sequence, offset): pieces of a length by rank go to consecutive sequences.

    A step ends a length or uses up an entry of equally full sequences. Each length leaves two entries
    more at most, and an entry that is used up is followed by one with less room; so there are at most
    ``2 * capacity ** 2 / 2`` steps whatever the counts (a few thousand as measured).
    """
    tree = CapacityTree(capacity)
    open_runs: dict[int, deque] = {}
    out, fresh = [], 0

    def put(room: int, first: int, count: int) -> None:
        if room:
            open_runs.setdefault(room, deque()).append((first, count))
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room < 0:
                room, first, count = capacity, fresh, left
            else:
                first, count = open_runs[room].popleft()
            # nothing is tighter than this room, so a sequence takes pieces of this length until it is too full
            each = min(room // length, left)
            take = min(count, left // each)
            if room == capacity and first == fresh:
                fresh += take
            else:
                if take < count:
                    open_runs[room].appendleft((first + take, count - take))
                if not open_runs[room]:
                    tree.set(room, False)
            for k in range(each):
                out.append((length, rank, rank + take - 1, first, capacity - room + k * length))
                rank += take
            put(room - each * length, first, take)
            left -= each * take
    return out


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) with the writing task and the rank among its pieces of that length."""
    tokenizer = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        seen = np.zeros(capacity + 1, np.int64)
        for batch in arrow_slices(batches):
            flat, size = enc.encode_ended(batch.column("text"), end_id)
            ids = flat.astype("<u4")
            first = np.cumsum(size) - size
            parts = -(-size // capacity)
            owner = np.repeat(np.arange(len(size)), parts)
            piece = np.arange(parts.sum()) - (np.cumsum(parts) - parts)[owner]
            start = piece * capacity
            length = np.minimum(size[owner] - start, capacity)
            at = first[owner] + start
            crc = np.fromiter((zlib.crc32(ids[i : i + n]) for i, n in zip(at, length)), np.int64, len(at))
            order = np.argsort(length, kind="stable")
            ranked = length[order]
            head = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, np.int64)
            k = np.empty(len(length), np.int64)
            k[order] = np.arange(len(ranked)) - np.repeat(head, np.diff(np.r_[head, len(ranked)])) + seen[ranked]
            seen += np.bincount(length, minlength=capacity + 1)
            columns = [batch.column("doc_id").take(pa.array(owner)), pa.array(piece, pa.int32()), *map(pa.array, (start, length, crc, np.full(len(k), part), k))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "k"])

    return doc_text(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, part long, k long")


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Sequence and offset of every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is a piece of the end id alone; an empty table gives no rows; repeated rows
    and ids, null ones too, are pieces of their own. Columns other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    cut = materialize(pieces(docs, tokenizer, capacity, end_id), "pieces")
    counts = materialize(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    total = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # one row for each length
    runs = np.array(best_fit_runs({r.length: r.n for r in total}, capacity), np.int64).reshape(-1, 5)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    sent = spark.sparkContext.broadcast(runs)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(base.hint("merge"), ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("k")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = sent.value
        begin = np.searchsorted(runs[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.empty(len(rank), np.int64)
            for x in np.unique(length):
                mine = length == x
                at[mine] = begin[x] + np.searchsorted(runs[begin[x] : begin[x + 1], 1], rank[mine], side="right") - 1
            out = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*out, pa.array(runs[at, 3] + rank - runs[at, 1]), pa.array(runs[at, 4])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op4_best_fit_packing": op4_best_fit_packing}
ORACLE: dict[str, str] = {}
