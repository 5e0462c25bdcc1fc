"""Near copies by the similarity of word sets: an exact prefix-filtered join at Jaccard 0.8.

A document is the set of its five-word shingles. Sets are put in one order for all, by how often a
hash bucket of the shingle occurs and then by hash; two sets at 0.8 share one of the first fifth of
their shingles. Sets meet in the cells of these. Pairs pass three bounds that lose nothing: the
sizes, the places in the order, and the differing bits of a 256-bit parity of the sets, of which
there are no more than shingles in one set only. What passes is checked on the sets themselves, in
one of the pair's cells, so a set goes to a cell once whatever the number of its pairs; a cell hands
on spanning links. Pairs are not sampled and cells not cut: a group of very many unequal near copies
costs pairs in proportion to its square.

Equal sets count once, known by a 64-bit hash, and are combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, materialize, release, remove
from .components import connected_components

WIDTH = 5
BUCKETS, CHUNK = 1 << 16, 1 << 12
#: Ids and cells (16 MB) up to which a list of documents is sent to all tasks, so that no text is shuffled to meet it.
SENT_IDS = 1_000_000
#: Pairs of a large cell that are tested at a time.
SLAB = 1 << 20
_CELL = "h long, g long, n int, pos int, p0 long, p1 long, p2 long, p3 long"


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of a lower-cased text's word shingles; a shorter text is one shingle."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(words[i : i + w])) for i in range(len(words) - w + 1)), np.uint64))


def _name(s: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(s.tobytes())).view(np.int64))


def _scan(docs: DataFrame, width: int) -> DataFrame:
    """One row (doc_id, g) per document, and per task the counts of buckets in chunks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            sets = [shingles(t, width) for t in batch["text"]]
            if sets:
                counts += np.bincount((np.concatenate(sets) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "g": np.array([_name(s) for s in sets], np.int64), "chunk": -1, "counts": None})
        if counts.any():
            parts = counts.reshape(-1, CHUNK)
            yield pd.DataFrame({"doc_id": 0, "g": 0, "chunk": np.arange(len(parts)), "counts": [p.astype(np.uint32).tobytes() for p in parts]})

    return doc_text(docs).mapInPandas(run, "doc_id long, g long, chunk int, counts binary")


def _weights(scan: DataFrame) -> np.ndarray:
    """Counts of all buckets."""

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.uint32).astype(np.int64) for x in part["counts"])
        return pd.DataFrame({"chunk": [part["chunk"].iloc[0]], "total": [total.tobytes()]})

    out = np.zeros((BUCKETS // CHUNK, CHUNK), np.int64)
    for r in scan.where("chunk >= 0").select("chunk", "counts").groupBy("chunk").applyInPandas(add, "chunk int, total binary").collect():
        out[r.chunk] = np.frombuffer(r.total, np.int64)
    return out.ravel()


def _parity(s: np.ndarray) -> np.ndarray:
    odd = np.bincount(((s >> np.uint64(32)) & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _cells(docs: DataFrame, weights: np.ndarray, width: int) -> DataFrame:
    """The first fifth of every set, a set once in a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            out = []
            for text in batch["text"]:
                s = shingles(text, width)
                g, n = _name(s), len(s)
                if not n or g in seen:
                    continue
                seen.add(g)
                k = n - (4 * n + 4) // 5 + 1
                first = s[np.lexsort((s, weights[(s % np.uint64(BUCKETS)).astype(np.int64)]))[:k]].view(np.int64)
                out.append((first, np.full(k, g), np.full(k, n, np.int32), np.arange(k, dtype=np.int32), *[np.full(k, p) for p in _parity(s)]))
            if out:
                yield pd.DataFrame(dict(zip(("h", "g", "n", "pos", "p0", "p1", "p2", "p3"), map(np.concatenate, zip(*out)))))

    return doc_text(docs).select("text").mapInPandas(run, _CELL)


def candidates(h: np.ndarray, g: np.ndarray, n: np.ndarray, pos: np.ndarray, parity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of pairs in one cell that no bound rules out; rows sorted by cell and set, without repeats."""

    def fine(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        both = n[i] + n[j]
        need = (4 * both + 8) // 9
        keep = (5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j])) & (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need)
        i, j, most = i[keep], j[keep], (both - 2 * need)[keep]
        keep[keep] = np.bitwise_count(parity[i] ^ parity[j]).sum(1, dtype=np.int64) <= most
        return keep

    if len(h) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    size = np.diff(np.r_[head, len(h)])
    small = np.repeat(size <= 64, size)
    left, right = [], []
    for d in range(1, int(size[size <= 64].max(initial=1))):
        i = np.flatnonzero(small[: len(h) - d] & (h[: len(h) - d] == h[d:]))
        i = i[fine(i, i + d)]
        left.append(i), right.append(i + d)
    for a, m in zip(head[size > 64].tolist(), size[size > 64].tolist()):
        step = max(1, SLAB // m)
        for lo in range(0, m, step):
            i = np.repeat(np.arange(lo, min(m, lo + step)), m)
            j = np.tile(np.arange(m), min(m, lo + step) - lo)
            i, j = i[i < j] + a, j[i < j] + a
            keep = fine(i, j)
            left.append(i[keep]), right.append(j[keep])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _pairs(cells: DataFrame) -> DataFrame:
    """Candidate pairs (a, b), each with one cell (h) where they meet."""

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def done(parts: list[pd.DataFrame]) -> pd.DataFrame:
            part = pd.concat(parts)
            h, g = part["h"].to_numpy(), part["g"].to_numpy()
            new = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])]
            h, g, n, pos = h[new], g[new], part["n"].to_numpy(np.int64)[new], part["pos"].to_numpy(np.int64)[new]
            i, j = candidates(h, g, n, pos, part[["p0", "p1", "p2", "p3"]].to_numpy(np.int64).view(np.uint64)[new])
            return pd.DataFrame({"h": h[i], "a": g[i], "b": g[j]})

        for batch in batches:
            if not len(batch):
                continue
            h = batch["h"].to_numpy()
            first = int(np.searchsorted(h, h[-1]))  # the last cell may go on in the next batch
            if first or (held and held[-1]["h"].iloc[-1] != h[-1]):
                yield done([*held, batch.iloc[:first]])
                held = []
            held.append(batch.iloc[first:])
        if held:
            yield done(held)

    met = cells.repartition("h").sortWithinPartitions("h", "g").mapInPandas(meet, "h long, a long, b long")
    return met.groupBy("a", "b").agg(F.min("h").alias("h"))


def _check(pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    """Spanning links of a cell's pairs at Jaccard 0.8 or more."""
    own = {g: frozenset(np.frombuffer(s, np.uint64).tolist()) for g, s in zip(sets["g"], sets["s"])}
    root, out = {g: g for g in own}, []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(pairs["a"].tolist(), pairs["b"].tolist()):
        x, y = top(a), top(b)
        if x != y:
            common = len(own[a] & own[b])
            if 5 * common >= 4 * (len(own[a]) + len(own[b]) - common):
                root[y] = x
                out.append((a, b))
    return pd.DataFrame(out, columns=["u", "v"]).astype("int64")


def sent(ids: DataFrame, cells: str | None = None) -> DataFrame:
    """A written table of ids, broadcast if its rows and the entries of its array ``cells`` are ``SENT_IDS`` at most; else
    both sides of its join are shuffled."""
    each = F.lit(1) + F.size(cells) if cells else F.lit(1)
    return F.broadcast(ids) if (ids.agg(F.sum(each.cast("long"))).first()[0] or 0) <= SENT_IDS else ids


def similar_classes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, class): documents connected by pairs at 0.8 or more have one class.

    ``doc_id`` must be unique and not null. Texts without words (null, empty, blank) are equal. An empty
    table gives no rows. Other columns are ignored.
    """
    scan = materialize(_scan(docs, width), "sets")
    names = scan.where("chunk < 0").select("doc_id", "g")
    pairs = materialize(_pairs(_cells(docs, _weights(scan), width)), "pairs")
    release(docs.sparkSession)
    members = pairs.select("h", F.col("a").alias("g")).unionByName(pairs.select("h", F.col("b").alias("g")))
    members = materialize(members.groupBy("g").agg(F.collect_set("h").alias("cells")), "members")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"g": batch["g"], "cells": batch["cells"], "s": [shingles(t, width).tobytes() for t in batch["text"]]})

    # A set's cells travel with its document's id, so sets are dealt once, by cell; they are no more than the first fifth of it.
    first = names.join(members.select("g"), "g", "left_semi").groupBy("g").agg(F.min("doc_id").alias("doc_id"))
    wanted = materialize(first.join(members, "g"), "wanted")
    met = doc_text(docs).join(sent(wanted, "cells"), "doc_id").select("g", "text", "cells")
    held = met.mapInPandas(sets, "g long, cells array<long>, s binary").select(F.explode("cells").alias("h"), "g", "s")
    links = pairs.groupBy("h").cogroup(held.groupBy("h")).applyInPandas(_check, "u long, v long")
    tree = connected_components(links)
    out = materialize(names.join(tree, F.col("g") == F.col("vertex"), "left").select("doc_id", F.coalesce("root", "g").alias("class")), "classes")
    remove(docs.sparkSession, scan._docloom_path, pairs._docloom_path, members._docloom_path, wanted._docloom_path)
    return out
