"""Exact removal of repeated byte strings by column-wise construction over many documents.

The collection that is sorted is made of short documents: the segments of texts around anchors whose
fingerprint occurs at least twice (see ``windows``; all other windows are unique). Segments of one
anchor are aligned at it, equal ones folded into one with a multiplicity. Then the transform is built
column by column: each round inserts one symbol per document, re-orders the documents stably by it
(the order of their reversed prefixes, whose next symbols are that round's column of the positional
Burrows-Wheeler transform) and updates the common-prefix array: the new neighbour's match begins where
the latest match between the two began. Two windows of 200 bytes that end in a column are equal
exactly if no common-prefix entry between their documents begins later than 200 bytes before it.

Why not rounds over whole texts: their number would be the length of the longest text and each round
would rewrite the whole transform. Aligned segments need 328 rounds, whatever the texts' length, and
only the current column's order and common prefixes are kept.

The columns are streamed: segments come sorted by anchor from the shuffle's sorted files, are taken in
slabs of at most ``SLAB`` segments, and anchors with more different segments than ``HOT`` are opened
into single windows that are counted by content instead, so no anchor gathers in one task. Segments are first told apart by a
64-bit hash within their anchor, so bytes are fetched and moved once per different segment only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_text, materialize, release, remove, table
from .tokens import slices
from .windows import segments, union

WINDOW, GRAM = 200, 72
SLAB, HOT = 8192, 4096


def anchors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(mh, doc_id, start, nw, off): segments of whole texts as UTF-8 bytes; off is the anchor's place in the segment."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, keys = batch["text"].tolist(), batch["doc_id"].to_numpy()
            for a, b in slices(texts, 1_000_000):
                raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts[a:b]]
                sizes = np.fromiter(map(len, raw), np.int64, len(raw))
                data = np.frombuffer(b"".join(raw), np.uint8)
                if len(data) < window:
                    continue
                at = np.arange(len(data))
                s, n, place, mh = segments(data, at, at + 1, np.repeat(np.arange(len(raw), dtype=np.int32), sizes), gram, window)
                doc = np.searchsorted(np.cumsum(sizes), s, side="right")
                first = (np.cumsum(sizes) - sizes)[doc]
                yield pd.DataFrame({"mh": mh.view(np.int64), "doc_id": keys[a:b][doc], "start": (s - first).astype(np.int32), "nw": n.astype(np.int16), "off": (place - s).astype(np.int16)})

    return doc_text(docs).mapInPandas(run, "mh long, doc_id long, start int, nw short, off short")


def repeated_windows(group: np.ndarray, copies: np.ndarray, texts: list[bytes], off: np.ndarray, window: int, gram: int) -> list[np.ndarray]:
    """Per segment, which of its windows occur at least twice in its group.

    Segments of a group are neighbours; ``off`` is the anchor's place. One round per aligned column.
    """
    m, lead = len(texts), window - gram
    size = np.fromiter(map(len, texts), np.int64, m)
    begin = lead - off.astype(np.int64)
    end = begin + size
    width = int(end.max())
    grid = np.full((width, m), 256, np.int32)
    row = np.repeat(np.arange(m), size)
    col = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    grid[col, row] = np.frombuffer(b"".join(texts), np.uint8)
    lane = np.cumsum(np.r_[0, group[1:] != group[:-1]])
    twice = np.zeros((width, m), bool)
    order, since = np.arange(m), np.full(m, 1 << 30)
    for j in range(int(begin.min()), width):
        key = lane[order] * 512 + grid[j, order]  # this round's symbol of every document, within its group
        step = np.argsort(key, kind="stable")
        key, order = key[step], order[step]
        same = np.r_[False, key[1:] == key[:-1]] & ((key & 511) < 256)
        at = np.flatnonzero(same)
        new = np.full(m, j + 1)
        if len(at):
            lo, n = step[at - 1] + 1, step[at] - step[at - 1]
            span = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            latest = np.maximum.reduceat(since[span], np.cumsum(n) - n)
            # a document that starts here has no past: its match begins here
            new[at] = np.where(latest >= 1 << 30, np.maximum(begin[order[at]], begin[order[at - 1]]), np.maximum(latest, np.maximum(begin[order[at]], begin[order[at - 1]])))
        since = new
        if j + 1 >= window:
            near = since <= j + 1 - window
            hit = near | np.r_[near[1:], False] | (copies[order] > 1)
            twice[j, order] = hit
    return [twice[begin[i] + window - 1 : end[i], i] for i in range(m)]


def _prepare(docs: DataFrame, touched: DataFrame, window: int) -> DataFrame:
    """One row per document: its bytes if it has repeated anchors, else its digest; and the anchors' segments with a hash (sd) of their bytes."""
    schema = "doc_id long, id string, n_bytes long, body binary, sha string, segs array<struct<mh:bigint,start:int,nw:smallint,off:smallint,sd:bigint>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in batches:
            out = []
            for doc, own, text, at in zip(batch["doc_id"], batch["id"], batch["text"], batch["at"]):
                raw = (text or "").encode("utf-8", "surrogatepass")
                if at is None or not len(at):
                    out.append((doc, own, len(raw), None, hashlib.sha256(raw).hexdigest(), []))
                    continue
                h = np.fromiter((xxhash.xxh64_intdigest(raw[x["start"] : x["start"] + x["nw"] + window - 1]) for x in at), np.uint64, len(at)).view(np.int64).tolist()
                out.append((doc, own, len(raw), raw, None, [{"mh": x["mh"], "start": x["start"], "nw": x["nw"], "off": x["off"], "sd": d} for x, d in zip(at, h)]))
            yield pd.DataFrame(out, columns=["doc_id", "id", "n_bytes", "body", "sha", "segs"])

    at = touched.groupBy("doc_id").agg(F.collect_list(F.struct("mh", "start", "nw", "off")).alias("at"))
    return doc_text(docs, "id").join(at, "doc_id", "left").select("doc_id", F.col("id").cast("string").alias("id"), "text", "at").mapInPandas(run, schema)


def _contents(prepared: DataFrame, classes: DataFrame, window: int) -> DataFrame:
    """(mh, sd, off, n, content): the bytes of each class, cut from its first document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(x["mh"], x["sd"], x["off"], x["n"], body[x["start"] : x["start"] + x["nw"] + window - 1]) for body, cs in zip(batch["body"], batch["cs"]) for x in cs]
            yield pd.DataFrame(out, columns=["mh", "sd", "off", "n", "content"])

    wanted = classes.select(F.col("f.doc_id").alias("doc_id"), F.struct("mh", "sd", "off", "n", F.col("f.start").alias("start"), F.col("f.nw").alias("nw")).alias("c"))
    wanted = wanted.groupBy("doc_id").agg(F.collect_list("c").alias("cs"))
    bodies = prepared.select("doc_id", "body").where("body IS NOT NULL")
    return bodies.join(wanted, "doc_id").select("body", "cs").mapInPandas(run, "mh long, sd long, off short, n long, content binary")


def _sorted_columns(classes: DataFrame, window: int, gram: int) -> DataFrame:
    """(mh, sd, spans): repeated windows of each distinct segment, from the column-wise construction."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []

        def done(part: pd.DataFrame) -> pd.DataFrame:
            marks = repeated_windows(part["mh"].to_numpy(), part["n"].to_numpy(), part["content"].tolist(), part["off"].to_numpy(), window, gram)
            spans = []
            for x in marks:
                edge = np.flatnonzero(np.diff(np.r_[0, x.astype(np.int8), 0]))
                spans.append([{"a": int(a), "b": int(b)} for a, b in zip(edge[::2], edge[1::2])])
            out = pd.DataFrame({"mh": part["mh"].to_numpy(), "sd": part["sd"].to_numpy(), "spans": spans})
            return out[[bool(s) for s in spans]]

        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) > SLAB:
                rows = pd.concat(held)
                mh = rows["mh"].to_numpy()
                cut = int(np.searchsorted(mh, mh[SLAB - 1], side="left")) or int(np.searchsorted(mh, mh[SLAB - 1], side="right"))
                if cut == len(rows):
                    held = [rows]
                    break
                yield done(rows.iloc[:cut])
                held = [rows.iloc[cut:]]
        if held and sum(map(len, held)):
            yield done(pd.concat(held))

    return classes.repartition("mh").sortWithinPartitions("mh").mapInPandas(run, "mh long, sd long, spans array<struct<a:int,b:int>>")


def covered_spans(prepared: DataFrame, window: int, gram: int, hot: int = HOT) -> DataFrame:
    """(doc_id, a, b): half-open ranges of places where strings of ``window`` bytes start that also start elsewhere."""
    seen = prepared.select("doc_id", F.explode("segs").alias("s")).select("doc_id", "s.*")
    classes = materialize(seen.groupBy("mh", "sd", "off").agg(F.min(F.struct("doc_id", "start", "nw")).alias("f"), F.count("*").alias("n")), "classes")
    release(prepared.sparkSession)
    crowded = materialize(classes.groupBy("mh").agg(F.count("*").alias("m")).where(F.col("m") > hot).select("mh"), "hot")
    some = crowded.limit(1).count() > 0
    usual = classes.join(crowded, "mh", "left_anti") if some else classes
    spans = materialize(_sorted_columns(_contents(prepared, usual, window), window, gram).select("mh", "sd", F.explode("spans").alias("x")).select("mh", "sd", "x.a", "x.b"), "spans")
    release(prepared.sparkSession)
    if some:
        size = F.length("content") - (window - 1)
        one = _contents(prepared, classes.join(crowded, "mh", "left_semi"), window).select("mh", "sd", "off", "n", F.posexplode_outer(F.transform(F.sequence(F.lit(1), size), lambda i: F.sha2(F.substring("content", i, F.lit(window)), 256))).alias("a", "w"))
        one = materialize(one.select("mh", "sd", "n", "a", (F.col("off") - F.col("a")).alias("place"), "w"), "single")
        twice = one.groupBy("mh", "place", "w").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
        spans = spans.unionByName(one.drop("n").join(twice, ["mh", "place", "w"]).select("mh", "sd", "a", (F.col("a") + 1).alias("b")))
    return seen.select("doc_id", "start", "mh", "sd").join(spans, ["mh", "sd"]).select("doc_id", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (remaining bytes, null where nothing goes), kept_sha256.

    Every byte covered by a ``window``-byte string that also starts anywhere else goes, judged on the
    input. Null and empty texts have no bytes; texts shorter than a window keep all; equal rows are
    copies of each other and go whole if long enough. Rows are told apart by a number of their own, so
    null and repeated ids are rows like any other. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    # written once, so that a row keeps its number
    docs = materialize(doc_text(docs).select(F.monotonically_increasing_id().alias("doc_id"), F.col("doc_id").alias("id"), "text"), "rows")
    entries = materialize(anchors(docs, window, gram), "anchors")
    twice = entries.groupBy("mh").agg(F.count("*").alias("n")).where("n > 1").select("mh")
    touched = materialize(entries.join(twice, "mh", "left_semi"), "touched")
    remove(spark, entries._docloom_path)
    release(spark)
    prepared = materialize(_prepare(docs, touched, window), "prepared")
    remove(spark, docs._docloom_path, touched._docloom_path)
    release(spark)
    spans = covered_spans(prepared, window, gram, hot).groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, n, body, sha, spans in zip(batch["id"], batch["n_bytes"], batch["body"], batch["sha"], batch["spans"]):
                if body is None or spans is None or not len(spans):
                    out.append((doc, n, 0, 0, None, sha or hashlib.sha256(body).hexdigest()))
                    continue
                runs = union([(s["a"], s["b"] + window - 1) for s in spans])
                kept = b"".join(body[a:b] for a, b in zip([0, *(b for _, b in runs)], [*(a for a, _ in runs), n]))
                out.append((doc, n, n - len(kept), len(runs), kept, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    out = prepared.drop("segs").join(spans, "doc_id", "left").select("id", "n_bytes", "body", "sha", "spans").mapInPandas(cut, "doc_id string, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 200-byte strings of all ``documents`` removed."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
ORACLE: dict[str, str] = {}
