"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is embedded as 32 counts: the number of ones in each 2-bit segment. A changed
bit moves one count by one, so the Manhattan distance of two embeddings never exceeds the Hamming
distance of the fingerprints. Counts are kept in unary (two bits each), which makes the Manhattan
distance the number of differing bits of two words.

The range join under that distance uses grids: the 32 coordinates are dealt to six groups; within
distance 3 at most three groups change, so two linked fingerprints share the cell of at least one of
the 20 grids that are formed by the coordinates of three groups. Every distinct fingerprint enters 20
cells, whatever the size of its neighbourhood. In a cell, pairs pass the Manhattan bound and then the
exact test; a cell hands on a spanning forest of its links only, never all its pairs. Cells above
``BLOCK`` fingerprints are first split again by 20 finer grids, on raw bits.

Equal fingerprints count once here, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_text, materialize, table
from .components import connected_components

SEED = 42
NEAR = 3
#: Fingerprints of a cell that are compared pair by pair.
BLOCK = 4096
_ODD = np.uint64(0x5555555555555555)
_ONE = np.uint64(1)


def _masks(unit: int) -> np.ndarray:
    """Masks of three out of six groups of ``unit``-bit segments: the grids."""
    n = 64 // unit
    owner = np.arange(n) * 6 // n
    bits = [sum(((1 << unit) - 1) << (unit * i) for i in range(n) if owner[i] in three) for three in combinations(range(6), 3)]
    return np.array(bits, np.uint64)


_GRIDS, _FINE = _masks(2), _masks(1)


def embed(fingerprints: np.ndarray) -> np.ndarray:
    """Segment counts in unary: the low bit of a segment says one or more ones, the high bit two."""
    x = fingerprints.astype(np.uint64)
    y = x >> _ONE
    return ((x | y) & _ODD) | (((x & y) & _ODD) << _ONE)


def _fold(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each index's component under the edges a - b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
    while not np.array_equal(label, label[label]):
        label = label[label]
    return label


def _pairs_within(fp: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked index pairs among the fingerprints of one cell, a slab of rows at a time."""
    u = embed(fp)
    left, right = [], []
    step = max(1, (1 << 22) // max(1, len(fp)))
    for lo in range(0, len(fp), step):
        i, j = np.nonzero(np.bitwise_count(u[lo : lo + step, None] ^ u[None, :]) <= near)
        i += lo
        keep = i < j
        i, j = i[keep], j[keep]
        keep = np.bitwise_count(fp[i] ^ fp[j]) <= near
        left.append(i[keep]), right.append(j[keep])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int), np.zeros(0, int))


def cell_forest(cell: np.ndarray, fp: np.ndarray, near: int = NEAR, fine: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (fingerprint, root) of rows sorted by cell; equal cells are neighbours."""
    n = len(fp)
    if n < 2:
        return fp[:0], fp[:0]
    head = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[head, n])
    small = np.repeat(size <= 64, size)
    u, left, right = embed(fp), [], []
    for d in range(1, int(size[size <= 64].max(initial=1))):
        i = np.flatnonzero(small[: n - d] & (cell[: n - d] == cell[d:]))
        i = i[np.bitwise_count(u[i] ^ u[i + d]) <= near]
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= near]
        left.append(i), right.append(i + d)
    for h, m in zip(head[size > 64], size[size > 64]):
        own = fp[h : h + m]
        if m <= BLOCK or fine:
            i, j = _pairs_within(own, near)
        else:
            order = np.argsort(own)
            i, j = [], []
            for mask in _FINE:
                key = own & mask
                o = np.argsort(key, kind="stable")
                a, b = cell_forest(key[o], own[o], near, True)
                i.append(order[np.searchsorted(own, a, sorter=order)]), j.append(order[np.searchsorted(own, b, sorter=order)])
            i, j = np.concatenate(i), np.concatenate(j)
        left.append(i + h), right.append(j + h)
    a = np.concatenate(left) if left else np.zeros(0, int)
    b = np.concatenate(right) if right else np.zeros(0, int)
    label = _fold(n, a, b)
    moved = np.flatnonzero(label != np.arange(n))
    return fp[moved], fp[label[moved]]


def simhash(text: bytes, width: int = 3) -> int:
    """Fingerprint of a lower-cased text from its word shingles, repeats included; 0 without words."""
    import xxhash

    words = text.split()
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    w = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(start[: len(words) - w + 1].tolist(), end[w - 1 :].tolist())), np.uint64)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[lo : lo + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) of whole texts; fp is the fingerprint as a signed long. ASCII letters are lower-cased."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = [simhash(t.encode("utf-8", "surrogatepass").lower(), width) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": np.array(fp, np.uint64).view(np.int64)})

    return doc_text(docs).mapInPandas(run, "doc_id long, fp long")


def links(distinct: DataFrame, near: int = NEAR) -> DataFrame:
    """Spanning links (u, v) between distinct fingerprints (column fp) at ``near`` or fewer differing bits; near is at most 3."""
    if not 0 <= near <= 3:
        raise ValueError("the grids hold for at most 3 differing bits")

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy()
            u = embed(fp.view(np.uint64))
            cell = (u[:, None] & _GRIDS[None, :]).ravel().view(np.int64)
            yield pd.DataFrame({"grid": np.tile(np.arange(len(_GRIDS), dtype=np.int8), len(fp)), "cell": cell, "fp": np.repeat(fp, len(_GRIDS))})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def done(part: pd.DataFrame) -> pd.DataFrame:
            key = part["grid"].to_numpy(), part["cell"].to_numpy()
            new = np.r_[False, (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])]
            a, b = cell_forest(np.cumsum(new), part["fp"].to_numpy().view(np.uint64), near)
            return pd.DataFrame({"u": a.view(np.int64), "v": b.view(np.int64)})

        for batch in batches:
            if not len(batch):
                continue
            last = batch.iloc[-1]
            open_ = ((batch["grid"] == last["grid"]) & (batch["cell"] == last["cell"])).to_numpy()
            first = int(np.argmax(open_))  # the last cell may go on in the next batch
            if first or (held and (held[-1]["grid"].iloc[-1], held[-1]["cell"].iloc[-1]) != (last["grid"], last["cell"])):
                yield done(pd.concat([*held, batch.iloc[:first]]))
                held = []
            held.append(batch.iloc[first:])
        if held:
            yield done(pd.concat(held))

    cells = distinct.select("fp").mapInPandas(deal, "grid byte, cell long, fp long")
    return cells.repartition("grid", "cell").sortWithinPartitions("grid", "cell").mapInPandas(meet, "u long, v long")


def near_duplicates(docs: DataFrame, near: int = NEAR, width: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of all documents.

    Texts without words (null, empty, blank) have fingerprint 0 and link like any other; equal texts
    share a fingerprint; ``component_id`` is the least doc_id reachable, the document's own included.
    A repeated doc_id keeps its rows. An empty table gives no rows. Other columns are ignored.
    """
    prints = materialize(fingerprints(docs, width), "fingerprints")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    tree = connected_components(links(first, near))
    rooted = first.join(tree, F.col("fp") == F.col("vertex"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    own = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(own, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicate ``documents`` at 3 or fewer differing fingerprint bits."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash_near_dedup": op7_simhash_near_dedup}
ORACLE: dict[str, str] = {}
