"""The PDF reader on made files: fonts, states, pictures, curves, updates and broken files."""

import zlib

import pytest

from docloom.plans.pdf_queries import pdf_strings
from docloom.sources import pdf
from docloom.sources.pdf_writer import assemble

CONTENT = rb"""q 1 0 0 1 0 0 cm BT /F1 10 Tf 50 700 Td (Caf\351 \(a\)) Tj 0 -20 Td [(H) -40 (2) 20 (O) -400 (x)] TJ
/F1 6 Tf 5 Ts (2) Tj 0 Ts /F2 10 Tf 1 0 0 1 50 600 Tm <0102> Tj T* ET Q % a comment
10 20 m 30 40 l 50 60 70 80 90 20 c h S 5 5 10 10 re f 1 1 m 2 2 l n
q 0.5 0.5 -0.5 0.5 0 0 cm 0 0 10 10 re s Q
q 100 0 0 50 200 300 cm /Im1 Do Q
BT /F1 10 Tf 0 1 -1 0 500 100 Tm (up) Tj ET"""


def made(extra: bytes = b"", content: bytes = CONTENT, tail: bool = True) -> bytes:
    z = zlib.compress(content)
    objects = [
        b"<</Type /Catalog /Pages 2 0 R>>",
        b"<</Type /Pages /Kids [3 0 R] /Count 1 /MediaBox 9 0 R>>",
        b"<</Type /Page /Parent 2 0 R /Contents [4 0 R] /Resources 5 0 R /Rotate 90>>",
        b"<</Length 10 0 R /Filter [/FlateDecode]>>\nstream\n%s\nendstream" % z,
        b"<</Font <</F1 6 0 R /F2 <</Type /Font /Subtype /Type1 /BaseFont /Odd /FirstChar 1 /Widths [500 700] /Encoding <</Differences [1 /alpha /eacute]>>>>>> /XObject <</Im1 8 0 R>>>>",
        b"<</Type /Font /Subtype /Type1 /BaseFont /Courier#2DBold /Encoding /WinAnsiEncoding>>",
        b"null",
        b"<</Type /XObject /Subtype /Image /Width 1 /Height 1 /Length 3>>\nstream\nabc\nendstream",
        b"[0 0 600 842]",
        b"%d" % len(z),
    ]
    out, at = bytearray(b"%PDF-1.4\n"), []
    for n, body in enumerate(objects, 1):
        at.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    begin = len(out)
    out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(at) + 1) + b"".join(b"%010d 00000 n \n" % a for a in at)
    out += b"trailer <</Size %d /Root 1 0 R %s>>\n" % (len(at) + 1, extra) + (b"startxref\n%d\n%%%%EOF" % begin if tail else b"")
    return bytes(out)


def updated() -> bytes:
    """A later version of the content in an update at the end."""
    old = made()
    body = b"4 0 obj\n<</Length 40>>\nstream\n" + b"BT /F1 10 Tf 50 700 Td (new words) Tj ET".ljust(40) + b"\nendstream\nendobj\n"
    first = old.rfind(b"xref\n0 ")
    return old + b"\n" + body + b"xref\n4 1\n%010d 00000 n \n" % (len(old) + 1) + b"trailer <</Size 11 /Root 1 0 R /Prev %d>>\nstartxref\n%d\n%%%%EOF" % (first, len(old) + 1 + len(body))


@pytest.fixture(scope="module")
def read(spark):
    files = {"plain": made(), "no table": made(tail=False), "updated": updated(), "secret": made(b"/Encrypt 7 0 R"), "junk": b"no file", "empty": b"", "bad page": made(content=b"BT /F1 10 Tf (ok) Tj 1 Td ET"), "packed": assemble([b"BT /F1 10 Tf 1 0 0 1 50 700 Tm <00410042> Tj ET"], 600, 842, True)}
    files["cut stream"] = made().replace(zlib.compress(CONTENT)[:20], b"\0" * 20)
    tables = pdf.pdf_tables(spark.createDataFrame([(k, bytearray(v)) for k, v in files.items()] + [("null", None)], "doc_id string, content binary"))
    return tables, spark.createDataFrame([(k, bytearray(v)) for k, v in files.items()], "doc_id string, content binary")


def test_words(read):
    got = {}
    for r in read[0]["words"].collect():
        got.setdefault(r.doc_id, []).append((r.content, round(r.x1, 2), round(r.y1, 2), round(r.x2, 2), round(r.y2, 2), r.font, round(r.size, 2)))
    bold = "Courier-Bold"
    want = [("Café", 50, 134, 74, 144, bold, 10), ("(a)", 80, 134, 98, 144, bold, 10), ("H2O", 50, 154, 68.2, 164, bold, 10), ("x", 72.2, 154, 78.2, 164, bold, 10), ("2", 78.2, 152.2, 81.8, 158.2, bold, 6), ("αé", 50, 234, 62, 244, "Odd", 10), ("up", 492, 730, 502, 742, bold, 10)]
    assert sorted(got["plain"]) == sorted(want) and sorted(got["no table"]) == sorted(want)
    assert [x[0] for x in sorted(got["updated"])] == ["new", "words"] and [x[0] for x in got["packed"]] == ["AB"] and [x[0] for x in got["bad page"]] == ["ok"]


def test_folded(read):
    got = {(r.doc_id, r.content) for r in pdf_strings(read[1]).collect()}
    assert ("plain", "x^{2}") in got and ("plain", "Café") in got


def test_pages_pictures_and_drawings(read):
    tables = read[0]
    pages = {r.doc_id: (r.page_id, r.xml_width, r.xml_height, r.rotate) for r in tables["pages"].collect()}
    assert pages["plain"] == (0, 600, 842, 90) and pages["packed"] == (0, 600, 842, 0) and not {"junk", "secret", "empty", "null"} & set(pages)
    assert {(r.xref, r.x1, r.y1, r.x2, r.y2) for r in tables["images"].collect() if r.doc_id == "plain"} == {(8, 200, 492, 300, 542)}
    items = sorted((r.stroke_id, r.seq, r.kind, [(round(p.x, 2), round(p.y, 2)) for p in r.points]) for r in tables["items"].collect() if r.doc_id == "plain")
    assert items[:4] == [(0, 0, "l", [(10, 822), (30, 802)]), (0, 1, "c", [(30, 802), (50, 782), (70, 762), (90, 822)]), (0, 2, "l", [(90, 822), (10, 822)]), (1, 0, "re", [(5, 827), (15, 837)])]
    assert [x[2] for x in items[4:]] == ["l"] * 4 and {x[0] for x in items[4:]} == {2}


def test_errors_are_rows(read):
    errors = {r.doc_id: r.error for r in read[0]["errors"].collect()}
    assert set(errors) == {"secret", "junk", "empty", "null", "bad page", "cut stream"} and "encrypted" in errors["secret"]


def test_files_by_path(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(made())
    (tmp_path / "b.pdf").write_bytes(b"broken")
    tables = pdf.read_pdf(spark, str(tmp_path))
    assert tables["pages"].count() == 1 and tables["errors"].count() == 1
    tables = pdf.pdf_tables(spark.createDataFrame([], "doc_id string, content binary"))
    assert all(t.count() == 0 for t in tables.values())
