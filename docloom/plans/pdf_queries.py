"""Queries that write the supplied tables as PDF files and read those back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.pdf import pdf_tables
from ..sources.pdf_writer import number, pdf_files, text_op
from ..sources.spans import drawn_items, fold_spans
from .fixtures import BOXES_SQL, boxes, table
from .registry import query

#: Lines on a page.
_LINES = 50
_TEXT = f"""WITH l AS (SELECT item_id, i - 1 AS n, replace(ls[i], chr(13), ' ') AS line FROM (SELECT item_id, string_split(text, chr(10)) AS ls, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL)),
w AS (SELECT item_id, n, string_split(line, ' ') AS ws, unnest(range(1, len(string_split(line, ' ')) + 1)) AS i FROM l),
x AS (SELECT CAST(item_id AS VARCHAR) AS doc_id, CAST(n // {_LINES} AS BIGINT) AS page_id, ws[i] AS content, n % {_LINES} AS y, coalesce(list_sum(list_transform(ws[1 : i - 1], lambda x: length(x) + 1)), 0) AS before FROM w WHERE ws[i] <> '')
"""


def _item_files(spark, d: str) -> DataFrame:
    rows = table(spark, d, "benchmark").where("text IS NOT NULL AND item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("doc_id"), F.posexplode(F.split(F.replace("text", F.lit("\r"), F.lit(" ")), "\n", -1)).alias("n", "line"))
    y = F.lit(800) - 14 * (F.col("n") % _LINES)
    return pdf_files(rows.select("doc_id", F.floor(F.col("n") / _LINES).alias("page_id"), F.col("n").alias("seq"), text_op(F.lit(50), y, F.col("line")).alias("op")))


@query("pdf_words", _TEXT + "SELECT doc_id, page_id, content, CAST(50 + 6 * before AS BIGINT) AS x1, CAST(50 + 6 * (before + length(content)) AS BIGINT) AS x2, CAST(42 + 14 * y AS BIGINT) AS base FROM x")
def pdf_words(spark, d):
    """Words of all benchmark items, each item a file of its own."""
    found = pdf_tables(_item_files(spark, d))["words"]
    return found.select("doc_id", "page_id", "content", F.round("x1").cast("long").alias("x1"), F.round("x2").cast("long").alias("x2"), F.round(F.col("y2") - 2).cast("long").alias("base"))


@query("pdf_pages", f"SELECT CAST(item_id AS VARCHAR) AS doc_id, CAST(unnest(range(0, (len(string_split(text, chr(10))) - 1) // {_LINES} + 1)) AS BIGINT) AS page_id, 600.0::DOUBLE AS xml_width, 842.0::DOUBLE AS xml_height, 0 AS rotate FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL")
def pdf_pages(spark, d):
    return pdf_tables(_item_files(spark, d))["pages"]


_DRAWN = f"""WITH b AS ({BOXES_SQL}), p AS (SELECT *, dense_rank() OVER (PARTITION BY page_id // 8 ORDER BY page_id) - 1 AS k FROM b),
o AS (SELECT CAST(page_id // 8 AS VARCHAR) AS doc_id, CAST(k AS BIGINT) AS page_id, CASE WHEN category = 'DrawnLine' THEN 'line' ELSE 'rect' END AS shape, x1, y1, x2, y2 FROM p)
"""


@query("pdf_drawings", _DRAWN + "SELECT doc_id, page_id, shape, CAST(x1 AS BIGINT) AS x1, CAST(y1 AS BIGINT) AS y1, CAST(x2 AS BIGINT) AS x2, CAST(y2 AS BIGINT) AS y2, count(*) AS n FROM o GROUP BY ALL")
def pdf_drawings(spark, d):
    """All boxes drawn on the pages of files of eight pages; drawn lines as diagonals."""
    n, s = number, F.lit(" ")
    low, high = F.lit(842) - F.col("y2"), F.lit(842) - F.col("y1")
    line = F.concat(n(F.col("x1")), s, n(high), F.lit(" m "), n(F.col("x2")), s, n(low), F.lit(" l S"))
    rect = F.concat(n(F.col("x1")), s, n(low), s, n(F.col("x2") - F.col("x1")), s, n(high - low), F.lit(" re f"))
    ops = boxes(spark, d).select(F.floor(F.col("page_id") / 8).cast("string").alias("doc_id"), "page_id", F.col("area_id").alias("seq"), F.when(F.col("category") == "DrawnLine", line).otherwise(rect).alias("op"))
    items = pdf_tables(pdf_files(ops))["items"].withColumn("page_id", F.struct("doc_id", "page_id"))
    shapes = drawn_items(items).select("page_id.doc_id", "page_id.page_id", "shape", *(F.round(c).cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")))
    return shapes.groupBy("doc_id", "page_id", "shape", "x1", "y1", "x2", "y2").agg(F.count("*").alias("n"))


def pdf_strings(files: DataFrame) -> DataFrame:
    """Words of files with raised, lowered and split parts folded, as areas."""
    words = pdf_tables(files)["words"].withColumn("page_id", F.struct("doc_id", "page_id"))
    return fold_spans(words).select("page_id.doc_id", "page_id.page_id", F.lit("String").alias("category"), "line_id", "content", "size", "x1", "y1", "x2", "y2")
