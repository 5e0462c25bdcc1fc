"""Incremental substring deduplication with a log-structured fingerprint index.

The index is a list of immutable runs below one folder. A run is a table bucketed by anchor and sorted
by (anchor, key), with one row for each key; there are two families of them:

* ``segments``: a segment is a row of consecutive windows with one anchor (see ``windows``); its key
  is a hash of its words, its doc a document that holds it. There is one for about seven windows.
* ``windows``: the single windows of all segments whose anchor has been met with different words, by a
  hash of each window's words.

A window of 20 words can only repeat if its anchor does, so none is lost. A new batch is written as a run
of its own and merge-joined with every run before it. All are bucketed and sorted alike, so neither history
nor the batch is moved or sorted for that join. What it tells is verified on the words' hashes, which
do not depend on the anchor's: a segment with an equal earlier one is covered whole; where an anchor
has different segments, those not opened yet are opened into windows, found by their documents' texts,
and the windows are merge-joined likewise. A segment is opened once in the life of an index. When
``FAN`` runs of a level have gathered they are compacted into one of the next.

Rows are counted and reduced to one for each key and task before they move; copies of a passage in a
third of all documents stay with their documents, and the joins that find them can be split by key.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, release, remove, scratch, table
from .tokens import arrow_slices
from .windows import gather, segments, union

WINDOW, GRAM, FAN, BATCHES = 20, 8, 4, 5
_NULL_ID = -(1 << 63)
_RUN = "mh BIGINT, key BIGINT, doc BIGINT, n BIGINT, lead BOOLEAN"
_SLICE = 2_000_000


def _joined(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


def _bounds(line: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a line with single spaces."""
    if not line:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    return np.r_[0, gaps + 1], np.r_[gaps, len(line)]


def keyed(docs: DataFrame) -> DataFrame:
    """d (doc_id, least for null), th (hash of the text) and text; rows are told apart by d and th."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("d"), F.xxhash64(text).alias("th"), text.alias("text"))


class _Cut:
    """Segments of a list of texts: document, first word, windows, anchor and hash of the words of each, by document and place."""

    def __init__(self, texts: list, window: int, gram: int):
        import xxhash

        lines = [_joined(t) for t in texts]
        self.line, self.window = b" ".join(x for x in lines if x), window
        counts = np.array([x.count(b" ") + 1 if x else 0 for x in lines], np.int64)
        owner = np.repeat(np.arange(len(lines)), counts)
        self.begin, self.end = _bounds(self.line)
        s, self.nw, _, mh = segments(np.frombuffer(self.line, np.uint8), self.begin, self.end, owner, gram, window)
        self.doc, self.word, self.mh = owner[s], s, mh.view(np.int64)
        self.start = s - (np.cumsum(counts) - counts)[self.doc]
        digest, line = xxhash.xxh3_64_intdigest, self.line
        places = zip(self.begin[s].tolist(), self.end[s + self.nw + window - 2].tolist())
        self.key = np.fromiter((digest(line[a:b]) for a, b in places), np.uint64, len(s)).view(np.int64)
        self.again = repeated(self.doc, self.key)

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the chosen segments, the segment, the first word and the hash of every window."""
        import xxhash

        digest, line, n = xxhash.xxh3_64_intdigest, self.line, self.nw[chosen]
        at = gather(self.word[chosen], n)
        places = zip(self.begin[at].tolist(), self.end[at + self.window - 1].tolist())
        key = np.fromiter((digest(line[a:b]) for a, b in places), np.uint64, len(at)).view(np.int64)
        seg = np.repeat(chosen, n)
        return seg, self.start[seg] + at - self.word[seg], key


def repeated(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether an equal pair stands before, for rows in the order of their places."""
    order = np.lexsort((np.arange(len(key)), key, doc))
    out = np.zeros(len(key), bool)
    if len(key):
        out[order[1:]] = (doc[order][1:] == doc[order][:-1]) & (key[order][1:] == key[order][:-1])
    return out


def _segments(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """(mh, key, d, th, start, nw, again): all segments; again is true where the same document has an equal one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_slices(batches, size=_SLICE):
            cut = _Cut(b.column("text").to_pylist(), window, gram)
            owner = pa.array(cut.doc)
            yield pa.RecordBatch.from_arrays([pa.array(cut.mh), pa.array(cut.key), b.column("d").take(owner), b.column("th").take(owner), pa.array(cut.start, pa.int32()), pa.array(cut.nw, pa.int16()), pa.array(cut.again)], names=["mh", "key", "d", "th", "start", "nw", "again"])

    return texts.mapInArrow(run, "mh long, key long, d long, th long, start int, nw short, again boolean")


def _open(texts: DataFrame, wanted: DataFrame, window: int, gram: int, history: bool) -> DataFrame:
    """(mh, key, d, th, start, again, history): every window of the wanted (doc, key) segments, from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_slices(batches, size=_SLICE):
            cut, keys = _Cut(b.column("text").to_pylist(), window, gram), b.column("keys")
            ends = np.searchsorted(cut.doc, np.arange(len(b) + 1))
            chosen = [lo + np.flatnonzero(np.isin(cut.key[lo:hi], k.values.to_numpy()) & ~cut.again[lo:hi]) for lo, hi, k in zip(ends, ends[1:], keys)]
            seg, start, key = cut.windows(np.concatenate(chosen))
            owner = pa.array(cut.doc[seg])
            again = repeated(cut.doc[seg], key)
            yield pa.RecordBatch.from_arrays([pa.array(cut.mh[seg]), pa.array(key), b.column("d").take(owner), b.column("th").take(owner), pa.array(start, pa.int32()), pa.array(again), pa.array(np.full(len(seg), history))], names=["mh", "key", "d", "th", "start", "again", "history"])

    keys = wanted.groupBy("doc").agg(F.collect_set("key").alias("keys"))
    return texts.join(keys, F.col("d") == F.col("doc")).select("d", "th", "text", "keys").mapInArrow(run, "mh long, key long, d long, th long, start int, again boolean, history boolean")


#: A bucket with one file is sorted, and rows dealt by anchor are dealt by (anchor, key) as well.
_PLANS = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextmanager
def bucketed_plans(spark: SparkSession):
    """Plans made inside take buckets and their order as they are."""
    before = {k: spark.conf.get(k) for k in _PLANS}
    for k, v in _PLANS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class FingerprintIndex:
    """The runs below one folder, and the texts of the documents they are of."""

    def __init__(self, spark: SparkSession, folder: str, fan: int = FAN, window: int = WINDOW, gram: int = GRAM, buckets: int | None = None):
        self.spark, self.folder, self.fan, self.window, self.gram = spark, folder.rstrip("/"), fan, window, gram
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: dict[str, list[tuple[int, str, str]]] = {"segments": [], "windows": []}
        self.texts: list[DataFrame] = []
        self._n = 0

    @classmethod
    def open(cls, spark: SparkSession, folder: str, history: DataFrame, **rest) -> FingerprintIndex:
        """An index written before; ``history`` has the documents (doc_id, text) that it is of."""
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        names = sorted(f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path))
        out = cls(spark, folder, buckets=int(names[0].split("-b")[1]) if names else None, **rest)
        for name in names:
            kind, number, level = name.split("-")[:3]
            tab = f"run_{uuid.uuid4().hex}"
            spark.sql(f"CREATE TABLE {tab} ({_RUN}) USING PARQUET CLUSTERED BY (mh) SORTED BY (mh, key) INTO {out.buckets} BUCKETS LOCATION '{out.folder}/{name}'")
            out.runs[kind].append((int(level[5:]), f"{out.folder}/{name}", tab))
            out._n = max(out._n, int(number) + 1)
        out.texts.append(keyed(history))
        return out

    def _deal(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, "mh")

    def _store(self, kind: str, dealt: DataFrame, level: int) -> tuple[int, str, str]:
        """Write dealt rows (mh, key, doc, n) with unique keys as a run; ``lead`` marks the first row of each anchor."""
        path, tab = f"{self.folder}/{kind}-{self._n:05d}-level{level}-b{self.buckets}", f"run_{uuid.uuid4().hex}"
        self._n += 1
        lead = F.row_number().over(Window.partitionBy("mh").orderBy("key")) == 1
        dealt.select("mh", "key", "doc", "n", lead.alias("lead")).write.bucketBy(self.buckets, "mh").sortBy("mh", "key").option("path", path).format("parquet").saveAsTable(tab)
        return level, path, tab

    def _read(self, run: tuple[int, str, str]) -> DataFrame:
        return self.spark.table(run[2])

    def probe(self, kind: str, new: tuple[int, str, str], anchors: bool) -> DataFrame:
        """The new run's rows with ``old``: whether a run before it has the key; with ``anchors`` also ``mixed``: whether
        their anchor has different keys, one of them new. A merge join of buckets: nothing is moved."""
        own = self._read(new).select("mh", "key", "doc", "n")
        runs = [r for r in self.runs[kind] if r[2] != new[2]]
        for i, r in enumerate(runs):
            own = own.join(self._read(r).select("mh", "key", F.lit(True).alias(f"o{i}")).hint("merge"), ["mh", "key"], "left")
        for i, r in enumerate(runs if anchors else []):
            own = own.join(self._read(r).where("lead").select("mh", F.lit(True).alias(f"m{i}")).hint("merge"), "mh", "left")
        some = lambda c: reduce(lambda a, b: a | b, [F.coalesce(F.col(f"{c}{i}"), F.lit(False)) for i in range(len(runs))], F.lit(False))
        if not anchors:
            return own.select("mh", "key", "doc", "n", some("o").alias("old"))
        own = own.select("mh", "key", "doc", "n", some("o").alias("old"), some("m").alias("met"))
        each = Window.partitionBy("mh")
        mixed = F.max(~F.col("old")).over(each) & ((F.count("*").over(each) > 1) | F.col("met"))
        return own.select("mh", "key", "doc", "n", "old", mixed.alias("mixed"))

    def append(self, batch: DataFrame) -> DataFrame:
        """Add documents; returns their covered windows (d, th, start, nw): those whose words also start earlier.

        Everything in the index is earlier than the batch; within it the order is that of doc_id and place.
        """
        spark, texts = self.spark, keyed(batch)
        segs = materialize(_segments(texts, self.window, self.gram), "segments")
        new = self._store("segments", self._deal(segs.groupBy("mh", "key").agg(F.min("d").alias("doc"), F.count("*").alias("n"))), 0)
        release(spark)
        with bucketed_plans(spark):
            state = materialize(self.probe("segments", new, True).where("old OR mixed OR n > 1"), "state")
        whole = segs.where("NOT again").join(state.where("old OR n > 1").select("mh", "key", "doc", "old"), ["mh", "key"]).where("old OR d > doc")
        columns = ["d", "th", "start", "nw"]
        spans = segs.where("again").select(*columns).unionByName(whole.select(*columns))
        opened = self._opened(texts, state)
        if opened is not None:
            first = F.when(F.max("history"), 0).otherwise(F.count("*"))
            run = self._store("windows", self._deal(opened.groupBy("mh", "key").agg(F.min("d").alias("doc"), first.alias("n"))), 0)
            with bucketed_plans(spark):
                seen = materialize(self.probe("windows", run, False).where("old OR n <> 1"), "seen")
            one = opened.where("NOT history").join(seen, ["mh", "key"]).where("again OR old OR n = 0 OR d > doc")
            spans = spans.unionByName(one.select("d", "th", "start", F.lit(1).cast("short").alias("nw")))
            self.runs["windows"].append(run)
        spans = materialize(spans, "spans")
        remove(spark, segs._docloom_path, state._docloom_path, *([opened._docloom_path, seen._docloom_path] if opened is not None else []))
        self.runs["segments"].append(new)
        self.texts.append(texts)
        for kind in self.runs:
            self._compact(kind)
        release(spark)
        return spans

    def _opened(self, texts: DataFrame, state: DataFrame) -> DataFrame | None:
        """Windows of the batch's new segments on mixed anchors, and of earlier segments on anchors mixed for the first time."""
        mixed = state.where("mixed").select("mh").distinct()
        for r in self.runs["windows"]:
            mixed = mixed.join(self._read(r).where("lead").select("mh"), "mh", "left_anti")
        mixed = materialize(mixed, "mixed")
        if not state.where("mixed").limit(1).count():
            return None
        out = _open(texts, state.where("mixed AND NOT old").select("doc", "key"), self.window, self.gram, False)
        if self.runs["segments"]:
            before = reduce(DataFrame.unionByName, [self._read(r).join(mixed, "mh", "left_semi").select("doc", "key") for r in self.runs["segments"]])
            out = out.unionByName(_open(reduce(DataFrame.unionByName, self.texts), before, self.window, self.gram, True))
        out = materialize(out, "opened")
        remove(self.spark, mixed._docloom_path)
        return out

    def _drop(self, runs: list[tuple[int, str, str]]) -> None:
        for _, path, tab in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {tab}")
            remove(self.spark, path)

    def _compact(self, kind: str) -> None:
        """Merge the runs of a level while it has ``fan`` of them."""
        while True:
            levels = [r[0] for r in self.runs[kind]]
            full = next((x for x in sorted(set(levels)) if levels.count(x) >= self.fan), None)
            if full is None:
                return
            old = [r for r in self.runs[kind] if r[0] == full]
            rows = reduce(DataFrame.unionByName, [self._read(r) for r in old])
            merged = self._store(kind, self._deal(rows.select("mh", "key", "doc")).groupBy("mh", "key").agg(F.min("doc").alias("doc"), F.lit(0).cast("long").alias("n")), full + 1)
            self.runs[kind] = [r for r in self.runs[kind] if r[0] != full] + [merged]
            self._drop(old)

    def drop(self) -> None:
        """Delete all runs."""
        for kind in self.runs:
            self._drop(self.runs[kind])
            self.runs[kind] = []


def _batches(docs: DataFrame, batches: int) -> list[DataFrame]:
    """Documents by ranges of doc_id, about as many in each; those without an id first."""
    cuts = docs.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("c")).first().c if batches > 1 else []
    cuts, key, out = sorted(set(cuts or [])), F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)), []
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = docs if lo is None else docs.where(key > lo)
        out.append(part if hi is None else part.where(key <= hi))
    return out


def remove_repeats(docs: DataFrame, batches: int = BATCHES, index: FingerprintIndex | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept (binary: kept words joined by one space, null where nothing goes), kept_sha256.

    Words covered by a window that also starts earlier go: in a document of the index, in one with a
    smaller doc_id, or before in the same text. Given an index, the documents are added to it. Null and
    empty texts have no words; texts shorter than a window keep all. Documents without a doc_id come
    first. Rows that share a doc_id (or have none) stand at one place: none is earlier than another.
    Other columns are ignored; an empty table gives no rows.
    """
    spark, own = docs.sparkSession, index is None
    index = index or FingerprintIndex(spark, scratch(spark, "index"))
    window = index.window
    spans = reduce(DataFrame.unionByName, [index.append(part) for part in _batches(docs, batches)])
    if own:
        index.drop()
    spans = spans.groupBy("d", "th").agg(F.collect_list(F.shiftleft(F.col("start").cast("long"), 16) + F.col("nw")).alias("spans"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, spans in zip(batch["text"], batch["spans"]):
                line = _joined(text)
                if spans is None or not len(spans):
                    out.append((line.count(b" ") + 1 if line else 0, 0, None, hashlib.sha256(line).hexdigest()))
                    continue
                words = line.split()
                keep = np.ones(len(words), bool)
                for a, b in union([(x >> 16, (x >> 16) + (x & 0xFFFF) + window - 1) for x in spans.tolist()]):
                    keep[a:b] = False
                kept = b" ".join(w for w, k in zip(words, keep.tolist()) if k)
                out.append((len(words), int((~keep).sum()), kept, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept", "kept_sha256"]).assign(doc_id=batch["doc_id"].array)

    rows = keyed(docs).join(spans, ["d", "th"], "left").select(F.when(F.col("d") != _NULL_ID, F.col("d")).alias("doc_id"), "text", "spans")
    return rows.mapInPandas(cut, "doc_id long, n_words long, n_removed long, kept binary, kept_sha256 string")


def op6_fingerprint_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 20-word windows of all ``documents`` removed, first occurrences kept."""
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES = {"op6_fingerprint_index": op6_fingerprint_index}
ORACLE: dict[str, str] = {}
