"""First-fit decreasing packing in randomised groups, with a tournament tree of bin capacities.

Every document is encoded once and ended by ``end_id``. What a document has beyond whole sequences (its rest; most
documents are nothing else) is dealt at random into groups of about ``group_tokens`` tokens, whatever the size of the
corpus, and each group is packed by itself in one task:

1. Rests go by falling length to the first sequence with room. The tournament tree holds the sequences' room in its
   leaves and the larger of two in each node above, so the first fit is a walk from the root: logarithmic time.
2. So far no rest is cut. A group of T tokens needs T // capacity full sequences; the fullest ones are kept, and the
   rests of the others are cut to fill what room those have. About one rest is cut for each sequence with room left.
3. What remains of a group is less than a sequence; it becomes sequences of lengths that are powers of two, which
   nothing pads. So no sequence needs padding at all.

The deal is a hash of the writing task and the place in it, taken when the pieces are written; it does not look at
ids or texts, so copies and hot sources spread, and a lost executor changes nothing: groups are read from the
written pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_text, materialize, table
from .tokens import arrow_slices, default_tokenizer, encoder

CAPACITY = 4096
END_ID = 2
#: Tokens of a group, about: 1024 sequences, some 8 MB of ids.
GROUP_TOKENS = 1 << 22
#: Sequences of whole pieces are numbered from here, those of groups below it.
WHOLE = 1 << 62


class TournamentTree:
    """Room of numbered bins; each node holds the larger room of its two children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first_fit(self, need: int) -> int:
        """The first bin with at least this room; its room falls by as much."""
        room, leaves = self.room, self.leaves
        if room[1] < need:
            raise ValueError("no bin has so much room")
        i = 1
        while i < leaves:
            i *= 2
            if room[i] < need:
                i += 1
        found = i - leaves
        left = room[i] = room[i] - need
        while i > 1:
            other = room[i ^ 1]
            i >>= 1
            left = left if left > other else other
            if room[i] == left:
                break
            room[i] = left
        return found


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each length, taken by falling length (equal ones in the order given)."""
    tokens = int(lengths.sum())
    # any two neighbouring bins hold more than one bin's capacity together
    tree = TournamentTree(min(len(lengths), 2 * (tokens // capacity) + 2), capacity)
    out = np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        out[i] = tree.first_fit(int(lengths[i]))
    return out


def powers(n: int) -> list[int]:
    """The powers of two that make up ``n``, the largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_group(lengths: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(item, start, length, sequence, offset) of all pieces of one group; together they cover every item once."""
    at = first_fit_decreasing(lengths, capacity)
    fill = np.bincount(at, weights=lengths).astype(np.int64)
    full, rest = divmod(int(lengths.sum()), capacity)
    order = np.argsort(-fill, kind="stable")
    number = np.full(len(fill), -1, np.int64)
    number[order[:full]] = np.arange(full)
    used, out = [0] * full, []
    spare = []
    for item in np.argsort(-lengths, kind="stable").tolist():
        k, n = int(number[at[item]]), int(lengths[item])
        if k < 0:
            spare.append((item, n))
        else:
            out.append((item, 0, n, k, used[k]))
            used[k] += n
    goals = [(k, capacity) for k in range(full) if used[k] < capacity] + [(full + i, p) for i, p in enumerate(powers(rest))]
    used += [0] * len(powers(rest))
    places = iter(goals)
    k, goal = next(places, (0, 0))
    for item, n in spare:
        start = 0
        while start < n:
            if used[k] == goal:
                k, goal = next(places)
            some = min(n - start, goal - used[k])
            out.append((item, start, some, k, used[k]))
            used[k] += some
            start += some
    return out


def encoded(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Whole sequences and rests: doc_id, start, doc_tokens, ids (little-endian, of ``width`` bytes each), whole, part, k, deal."""
    tokenizer = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc, k = TaskContext.get().partitionId(), encoder(tokenizer), 0
        for batch in arrow_slices(batches):
            flat, size = enc.encode_ended(batch.column("text"), end_id)
            ids = flat.astype(f"<u{flat.dtype.itemsize}", copy=False)
            parts = -(-size // capacity)
            owner = np.repeat(np.arange(len(size)), parts)
            start = (np.arange(len(owner)) - (np.cumsum(parts) - parts)[owner]) * capacity
            length = np.minimum(size[owner] - start, capacity)
            upto = np.concatenate([[0], np.cumsum(length)])
            raw = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer((upto * ids.itemsize).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(ids))])
            n = len(length)
            columns = [batch.column("doc_id").take(pa.array(owner)), *map(pa.array, (start, length, size[owner])), raw.cast(pa.binary()), pa.array(np.full(n, ids.itemsize, np.int32)), pa.array(length == capacity), pa.array(np.full(n, part, np.int64)), pa.array(np.arange(k, k + n))]
            k += n
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "doc_tokens", "ids", "width", "whole", "part", "k"])

    return doc_text(docs).mapInArrow(cut, "doc_id long, start long, length long, doc_tokens long, ids binary, width int, whole boolean, part long, k long").withColumn("deal", F.xxhash64("part", "k"))


def _widened(ids: bytes, width: int) -> np.ndarray:
    return np.frombuffer(ids, f"<u{width}").astype("<u4")


def pack_in_groups(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Pieces of all documents with their ids and places: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset.

    ``capacity`` must be a power of two. A null or empty text is the end id alone; an empty table gives no rows;
    repeated rows and ids, null ones too, are documents of their own. Of equally long rests the one written first goes
    first. Columns other than doc_id and text are ignored.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    written = materialize(encoded(docs, tokenizer, capacity, end_id), "encoded")
    tokens = written.where("NOT whole").agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    groups = max(1, round(tokens / group_tokens))
    shape = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("part", "ascending"), ("k", "ascending")])
        group, start, doc_tokens, width = (t.column(c).to_numpy() for c in ("group", "start", "doc_tokens", "width"))
        packed = np.array(pack_group(t.column("length").to_numpy(), capacity), np.int64).reshape(-1, 5)
        item, inner, length, sequence, offset = packed.T
        ids, raw = t.column("ids"), []
        for i, a, n in zip(item.tolist(), inner.tolist(), length.tolist()):
            w = int(width[i])
            raw.append(_widened(ids[i].as_buffer().slice(a * w, n * w), w).tobytes())
        number = (int(group[0]) << 24) + sequence if len(group) else sequence
        return pa.table({"doc_id": t.column("doc_id").take(pa.array(item)), "start": start[item] + inner, "length": length, "ids": pa.array(raw, pa.binary()), "doc_tokens": doc_tokens[item], "sequence_id": number, "offset": offset})

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, k = (b.column(c).to_numpy() for c in ("part", "k"))
            raw = [_widened(x, w).tobytes() for x, w in zip(b.column("ids").to_pylist(), b.column("width").to_pylist())]
            columns = [*(b.column(c) for c in ("doc_id", "start", "length")), pa.array(raw, pa.binary()), b.column("doc_tokens"), pa.array(WHOLE + (part << 36) + k), pa.array(np.zeros(len(k), np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    rests = written.where("NOT whole").withColumn("group", F.pmod("deal", F.lit(groups))).drop("whole", "deal")
    return rests.groupBy("group").applyInArrow(pack, shape).unionByName(written.where("whole").mapInArrow(alone, shape))


def op13_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of 4096 tokens."""
    packed = pack_in_groups(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {"op13_first_fit_packing": op13_first_fit_packing}
ORACLE: dict[str, str] = {}
