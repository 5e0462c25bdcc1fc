"""Token-ID output: concatenated id arrays with Elias-Fano document boundaries.

Documents are range-partitioned by ``doc_id``; every task streams its sorted share into shard files
of bounded size. A shard file holds, after a fixed header, the Elias-Fano coded document ids (as
distances from the shard's first; documents without an id come first and are only counted), the
Elias-Fano coded boundaries, and the ids as little-endian unsigned integers of two or four bytes,
whichever the vocabulary needs. Offsets come from ``select``
on the boundaries, so no table of 64-bit offsets is stored. Only one line per shard (its number of
documents and ids) reaches the driver, which turns them into the shards' places in the whole.

A file is written under a temporary name and renamed, so a repeated or speculative task leaves one
whole file with the same bytes.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import doc_text, scratch, table
from .elias_fano import EliasFano
from .tokens import SLICE_BYTES, arrow_slices, default_tokenizer, encoder

MAGIC = b"EFTOK02\0"
_HEAD = struct.Struct("<8sqQQQQQB7x")
#: Ids after which a task begins a new shard file.
SHARD_IDS = 8_000_000


def pack_shard(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, width: int, nameless: int = 0) -> bytes:
    """The bytes of a shard: header, document ids, boundaries, token ids; the first ``nameless`` documents have no id."""
    first = int(doc_ids[0]) if len(doc_ids) else 0
    docs = EliasFano.encode(np.asarray(doc_ids, np.int64) - first).to_bytes()
    bounds = EliasFano.encode(np.concatenate([[0], np.cumsum(sizes)])).to_bytes()
    return _HEAD.pack(MAGIC, first, len(sizes), nameless, len(ids), len(docs), len(bounds), width) + docs + bounds + ids.astype(f"<u{width}", copy=False).tobytes()


class Shard:
    """Random access to a shard's documents."""

    def __init__(self, data: bytes):
        magic, self.first, self.n_docs, self.nameless, self.n_ids, a, b, width = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = _HEAD.size
        self.docs = EliasFano.from_bytes(data[at : at + a])
        self.bounds = EliasFano.from_bytes(data[at + a : at + a + b])
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, at + a + b)

    def document(self, i: int) -> tuple[int | None, np.ndarray]:
        """Document id and token ids of the shard's ``i``-th document."""
        doc = self.first + self.docs.select(i - self.nameless) if i >= self.nameless else None
        return doc, self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]

    def doc_ids(self) -> pa.Array:
        return pa.concat_arrays([pa.nulls(self.nameless, pa.int64()), pa.array(self.first + self.docs.select_range(0, self.n_docs - self.nameless), pa.int64())])

    def boundaries(self) -> np.ndarray:
        return self.bounds.select_range(0, self.n_docs + 1)


def _put(folder: str, name: str, data: bytes) -> None:
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder)
    store.create_dir(base, recursive=True)
    temporary = f"{base}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as out:
        out.write(data)
    store.move(temporary, f"{base}/{name}")


def write_token_shards(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2, shard_ids: int = SHARD_IDS) -> list[tuple[str, int, int, int]]:
    """Encode every text, append ``end_id``, write shards to ``folder``; returns (file, first place, documents, ids) per shard.

    Null and empty texts give the end id alone. Documents without a doc_id come first; equal ids stay
    neighbours in some order. An empty table gives no shards. Other columns are ignored.
    """
    tokenizer = tokenizer or default_tokenizer()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        keys, sizes, ids, rows = [], [], [], []

        def flush() -> None:
            key, flat = pa.concat_arrays(keys), np.concatenate(ids)
            name = f"part-{part:06d}-{len(rows):05d}.eft"
            width = 2 if flat.dtype.itemsize <= 2 else 4
            _put(folder, name, pack_shard(key.drop_null().to_numpy(), np.concatenate(sizes), flat, width, key.null_count))
            rows.append({"file": name, "part": part, "k": len(rows), "n_docs": len(key), "n_ids": len(flat)})
            keys.clear(), ids.clear(), sizes.clear()

        for batch in arrow_slices(batches, size=min(SLICE_BYTES, 4 * shard_ids)):
            flat, size = enc.encode_ended(batch.column("text"), end_id)
            keys.append(batch.column("doc_id")), ids.append(flat), sizes.append(size)
            if sum(map(len, ids)) >= shard_ids:
                flush()
        if keys:
            flush()
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("file", pa.string()), *[(c, pa.int64()) for c in ("part", "k", "n_docs", "n_ids")]]))

    ordered = doc_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    rows = ordered.mapInArrow(write, "file string, part long, k long, n_docs long, n_ids long").collect()
    out, at = [], 0
    for r in sorted(rows, key=lambda r: (r.part, r.k)):
        out.append((r.file, at, r.n_docs, r.n_ids))
        at += r.n_ids
    return out


def read_token_shards(spark: SparkSession, folder: str, shards: list[tuple[str, int, int, int]]) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the shard files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not shards:
        return spark.createDataFrame([], schema)
    place = {s[0]: s[1] for s in shards}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                shard = Shard(content)
                bounds = shard.boundaries()
                ids = shard.ids.astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pd.DataFrame({"doc_id": shard.doc_ids().to_pandas(integer_object_nulls=True), "start": place[path.rsplit("/", 1)[1]] + bounds[:-1], "n_tokens": np.diff(bounds), "ids_crc32": np.array(crc, np.int64)})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.eft").load(folder).select("path", "content")
    return files.mapInPandas(read, schema)


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-ID output of all ``documents``, digested from the files it wrote."""
    folder = scratch(spark, "tokens")
    shards = write_token_shards(table(spark, sf_dir, "documents"), folder)
    return read_token_shards(spark, folder, shards)


QUERIES = {"op8_token_output": op8_token_output}
ORACLE: dict[str, str] = {}
