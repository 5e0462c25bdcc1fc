"""Plain PDF files from tables of page content."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The code map that gives every code its own character.
_MAP = b"/CIDInit /ProcSet findresource begin begincmap 1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfrange <0000> <FFFF> <0000> endbfrange endcmap end"


def text_op(x: Column, y: Column, text: Column, size: float = 10.0) -> Column:
    """The operators that show a text in the file's font, every character 0.6 of the size wide; characters beyond 16 bits as ``?``."""
    plain = F.regexp_replace(text, "[\\x{10000}-\\x{10FFFF}]", "?")
    return F.concat(F.lit(f"BT /F1 {size} Tf 1 0 0 1 "), number(x), F.lit(" "), number(y), F.lit(" Tm <"), F.hex(F.encode(plain, "UTF-16BE")), F.lit("> Tj ET"))


def number(x: Column) -> Column:
    return x.cast("decimal(18,3)").cast("string")


def assemble(contents: list[bytes], width: float, height: float, packed: bool) -> bytes:
    """A file of pages with these contents. ``packed``: objects in a stream of objects and references in a stream, as later versions have them."""
    stream = lambda head, body: b"<<%s /Filter /FlateDecode /Length %d>>\nstream\n%s\nendstream" % (head, len(z := zlib.compress(body)), z)
    kids = b" ".join(b"%d 0 R" % (6 + 2 * i) for i in range(len(contents)))
    plain = {1: b"<</Type /Catalog /Pages 2 0 R>>", 2: b"<</Type /Pages /Count %d /Kids [%s] /MediaBox [0 0 %g %g] /Resources <</Font <</F1 3 0 R>>>>>>" % (len(contents), kids, width, height), 3: b"<</Type /Font /Subtype /Type0 /BaseFont /Plain /Encoding /Identity-H /DescendantFonts [4 0 R] /ToUnicode 5 0 R>>", 4: b"<</Type /Font /Subtype /CIDFontType2 /BaseFont /Plain /DW 600>>"}
    streams = {5: stream(b"", _MAP)}
    for i, content in enumerate(contents):
        plain[6 + 2 * i] = b"<</Type /Page /Parent 2 0 R /Contents %d 0 R>>" % (7 + 2 * i)
        streams[7 + 2 * i] = stream(b"", content)
    size = 6 + 2 * len(contents)
    rows: dict[int, tuple[int, int, int]] = {0: (0, 0, 65535)}
    if packed:
        heads, body = [], b""
        for k, (n, value) in enumerate(plain.items()):
            heads.append(b"%d %d" % (n, len(body)))
            body += value + b"\n"
            rows[n] = (2, size, k)
        head = b" ".join(heads) + b"\n"
        streams[size] = stream(b"/Type /ObjStm /N %d /First %d" % (len(plain), len(head)), head + body)
    direct = streams if packed else plain | streams
    out = bytearray(b"%PDF-1.5\n")
    for n, value in direct.items():
        rows[n] = (1, len(out), 0)
        out += b"%d 0 obj\n%s\nendobj\n" % (n, value)
    at = len(out)
    if packed:
        rows[size + 1] = (1, at, 0)
        table = b"".join(bytes([kind]) + a.to_bytes(4, "big") + b.to_bytes(2, "big") for _, (kind, a, b) in sorted(rows.items()))
        out += b"%d 0 obj\n%s\nendobj\n" % (size + 1, stream(b"/Type /XRef /Size %d /W [1 4 2] /Root 1 0 R" % (size + 2), table))
    else:
        out += b"xref\n0 %d\n" % size + b"".join(b"%010d %05d %c \n" % (a, b, b"fn"[kind]) for _, (kind, a, b) in sorted(rows.items())) + b"trailer <</Size %d /Root 1 0 R>>\n" % size
    return bytes(out + b"startxref\n%d\n%%%%EOF\n" % at)


def pdf_files(ops: DataFrame, width: float = 600.0, height: float = 842.0) -> DataFrame:
    """Files (doc_id, content) from operators (doc_id, page_id, seq, op); pages of a file are numbered anew in the order of page_id."""
    pages = ops.groupBy("doc_id", "page_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "op"))), lambda x: x["op"]), "\n").alias("ops"))
    files = pages.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("page_id", "ops"))), lambda x: F.encode(x["ops"], "UTF-8")).alias("contents"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, contents in zip(b.column("doc_id").to_pylist(), b.column("contents")):
                made = assemble([bytes(x) for x in contents.as_py()], width, height, zlib.crc32(doc.encode()) % 2 == 1)
                yield pa.RecordBatch.from_arrays([pa.array([doc]), pa.array([made], pa.binary())], names=["doc_id", "content"])

    return files.select(F.col("doc_id").cast("string"), "contents").mapInArrow(run, "doc_id string, content binary")
