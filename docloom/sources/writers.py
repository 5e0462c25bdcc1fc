"""Exports as DataFrames of text lines, and their writers. All rendering is Column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Box
from ..operators.tables import dense

DELIMITER = {"csv": ",", "tsv": "\t", "txt": " "}


def _rows(cells: DataFrame, cell) -> DataFrame:
    full = dense(cells).select("table_id", "r", "c", cell.alias("t"))
    return full.groupBy("table_id", "r").agg(F.transform(F.sort_array(F.collect_list(F.struct("c", "t"))), lambda x: x["t"]).alias("ts"))


def table_lines(cells: DataFrame, delimiter: str = ",", marks: bool = True) -> DataFrame:
    """One line per table row; column labels begin with a tilde, row labels with a caret."""
    text = F.coalesce("content", F.lit(""))
    if marks:
        text = F.when(F.col("content").isNull(), "").when(F.col("r") == 0, F.concat(F.lit("~"), text)).when(F.col("c") == 0, F.concat(F.lit("^"), text)).otherwise(text)
    return _rows(cells, text).select("table_id", "r", F.array_join("ts", delimiter).alias("line"))


def markdown_lines(cells: DataFrame) -> DataFrame:
    return _rows(cells, F.coalesce("content", F.lit(""))).select("table_id", "r", F.concat(F.lit("| "), F.array_join("ts", " | "), F.lit(" |")).alias("line"))


def html_tables(cells: DataFrame) -> DataFrame:
    """One HTML table per table."""
    escaped = F.replace(F.replace(F.replace(F.coalesce("content", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    tag = F.when((F.col("r") == 0) | (F.col("c") == 0), F.concat(F.lit("<th>"), escaped, F.lit("</th>"))).otherwise(F.concat(F.lit("<td>"), escaped, F.lit("</td>")))
    rows = _rows(cells, tag).select("table_id", F.struct("r", F.concat(F.lit("<tr>"), F.array_join("ts", ""), F.lit("</tr>")).alias("h")).alias("x"))
    return rows.groupBy("table_id").agg(F.concat(F.lit("<table>"), F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["h"]), ""), F.lit("</table>")).alias("html"))


def coco_annotations(areas: DataFrame) -> DataFrame:
    """Annotation rows: whole-number box, area and score."""
    b = Box.of()
    return areas.select(F.col("page_id").alias("image_id"), F.col("area_id").alias("id"), "category", *[v.cast("long").alias(n) for v, n in zip((b.x1, b.y1, b.width, b.height), "xywh")], b.area.alias("area"), F.coalesce("confidence", F.lit(0.0)).alias("score"))


def coco_categories(areas: DataFrame, super_category: str = "Table") -> DataFrame:
    return areas.select(F.col("category").alias("name")).distinct().withColumn("supercategory", F.lit(super_category))


def svg_pages(areas: DataFrame, color: str = "red", thickness: int = 2) -> DataFrame:
    """One SVG overlay per page."""
    b = Box.of()
    rect = F.format_string(f'<rect x="%.1f" y="%.1f" width="%.1f" height="%.1f" fill="none" stroke="{color}" stroke-width="{thickness}"/>', b.x1, b.y1, b.width, b.height)
    page = areas.groupBy("page_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("area_id", rect.alias("s")))), lambda x: x["s"]), "").alias("body"))
    return page.select("page_id", F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg">'), "body", F.lit("</svg>")).alias("svg"))


def page_lines(words: DataFrame, pad: float = 0.0) -> DataFrame:
    """Text lines of a page (page_id, line_id, area_id, x1..y2, content): joined words, padded polygon, baseline."""
    line = words.groupBy("page_id", "line_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("x1", "area_id", "content"))), lambda x: x["content"]), " ").alias("content"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    p = lambda x, y: F.concat(F.round(x).cast("long").cast("string"), F.lit(","), F.round(y).cast("long").cast("string"))
    x1, y1, x2, y2 = F.col("x1") - pad, F.col("y1") - pad, F.col("x2") + pad, F.col("y2") + pad
    return line.select("page_id", "line_id", "content", F.concat_ws(" ", p(x1, y1), p(x2, y1), p(x2, y2), p(x1, y2)).alias("points"), F.concat_ws(" ", p(x1, y2), p(x2, y2)).alias("baseline"))


def write_page_xml(lines: DataFrame, path: str) -> None:
    """PAGE-like XML through Spark's XML writer, a folder per page."""
    rows = lines.select("page_id", F.col("line_id").alias("_id"), F.struct(F.col("points").alias("_points")).alias("Coords"), F.struct(F.col("baseline").alias("_points")).alias("Baseline"), F.struct(F.col("content").alias("Unicode")).alias("TextEquiv"))
    rows.write.partitionBy("page_id").format("xml").option("rootTag", "Page").option("rowTag", "TextLine").save(path)


def write_lines(lines: DataFrame, path: str, by: str = "table_id") -> None:
    """Text files with one folder per table, rows in order."""
    lines.repartition(by).sortWithinPartitions(by, "r").select(by, F.col("line").alias("value")).write.partitionBy(by).text(path)


def document_json(documents: DataFrame, pictures: bool = False) -> DataFrame:
    """One JSON text per document, page images left out unless asked for."""
    cols = [c for c in documents.columns if pictures or c not in ("img", "raw_pdf")]
    binary = {f.name for f in documents.schema.fields if f.dataType.typeName() == "binary"}
    return documents.select("doc_id", F.to_json(F.struct(*[F.base64(c).alias(c) if c in binary else F.col(c) for c in cols])).alias("json"))


def drawn_line_rows(areas: DataFrame, category: str = "DrawnLine") -> DataFrame:
    """Drawn lines of pages for XML export: page_id, area_id, points and baseline along the longer side."""
    b = Box.of()
    p = lambda x, y: F.concat(F.round(x).cast("long").cast("string"), F.lit(","), F.round(y).cast("long").cast("string"))
    corners = F.concat_ws(" ", p(b.x1, b.y1), p(b.x2, b.y1), p(b.x2, b.y2), p(b.x1, b.y2))
    along = F.when(b.is_vertical, F.concat_ws(" ", p(b.middle[0], b.y1), p(b.middle[0], b.y2))).otherwise(F.concat_ws(" ", p(b.x1, b.middle[1]), p(b.x2, b.middle[1])))
    return areas.where(F.col("category") == category).select("page_id", F.col("area_id").alias("line_id"), F.lit("").alias("content"), corners.alias("points"), along.alias("baseline"))


def word_lines(words: DataFrame, box: bool = False, factor_width=1.0, factor_height=1.0) -> DataFrame:
    """One line of text for each word: page, text and, if asked for, its box, times the page's factors."""
    b = Box.of().scaled(F.lit(factor_width), F.lit(factor_height))
    parts = [F.col("page_id").cast("string"), F.col("content")]
    if box:
        parts += [F.format_string("%.1f", c) for c in (b.x1, b.y1, b.x2, b.y2)]
    return words.select("page_id", F.col("area_id").alias("r"), F.concat_ws("\t", *parts).alias("line"))


def page_texts(lines: DataFrame) -> DataFrame:
    """Text of each page: its lines in reading order (rows from the top, then from the left)."""
    from ..operators.cluster import reading_order

    placed = reading_order(lines).join(lines.select("page_id", "area_id", "content"), ["page_id", "area_id"])
    return placed.groupBy("page_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "content"))), lambda x: x["content"]), "\n").alias("text"))


def table_structure(cells: DataFrame) -> DataFrame:
    """Structure of labelled cells (table_id, r, c, content, column_label, row_label): one JSON text per table.

    Cells with their extent, relations between neighbours, and for every data cell its column and row labels, outermost first.
    """
    from ..operators import layout, tables

    own = cells.repartition("table_id")
    listed = lambda df, *cols: df.groupBy("table_id").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("l"))
    extent = listed(tables.spans(own.where("content IS NOT NULL")), "r1", "c1", "r2", "c2", "content").withColumnRenamed("l", "cells")
    related = listed(layout.cell_graph(own), "r", "c", "r2", "c2", "direction").withColumnRenamed("l", "relations")
    paths = tables.header_paths(own).join(own.select("table_id", "r", "c", "content"), ["table_id", "r", "c"]).where("content IS NOT NULL")
    triples = listed(paths, "r", "c", "content", "column_path", "row_path").withColumnRenamed("l", "triples")
    out = extent.join(related, "table_id", "left").join(triples, "table_id", "left")
    return out.select("table_id", F.to_json(F.struct("cells", "relations", "triples")).alias("json"))


def svg_shapes(shapes: DataFrame, color: str = "red", thickness: int = 2, confidence: bool = False) -> DataFrame:
    """One SVG overlay per page of shapes (shape, area_id, box): lines, rectangles and curves, with their scores if asked for."""
    b = Box.of()
    style = f'fill="none" stroke="{color}" stroke-width="{thickness}"'
    line = F.format_string(f'<line x1="%.1f" y1="%.1f" x2="%.1f" y2="%.1f" {style}/>', b.x1, b.y1, b.x2, b.y2)
    rect = F.format_string(f'<rect x="%.1f" y="%.1f" width="%.1f" height="%.1f" {style}/>', b.x1, b.y1, b.width, b.height)
    curve = F.format_string(f'<path d="M %.1f %.1f C %.1f %.1f %.1f %.1f %.1f %.1f" {style}/>', b.x1, b.y1, b.x2, b.y1, b.x1, b.y2, b.x2, b.y2)
    text = F.when(F.col("shape") == "line", line).when(F.col("shape") == "bezier", curve).otherwise(rect)
    if confidence:
        text = F.concat(text, F.format_string('<text x="%.1f" y="%.1f">%.2f</text>', b.x1, b.y1, F.coalesce("confidence", F.lit(0.0))))
    page = shapes.groupBy("page_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("area_id", text.alias("s")))), lambda x: x["s"]), "").alias("body"))
    return page.select("page_id", F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg">'), "body", F.lit("</svg>")).alias("svg"))


def figure_records(figures: DataFrame, strings: DataFrame, captions: DataFrame, least_area: float = 150.0) -> DataFrame:
    """Figures of at least the area with their strokes, the texts that overlap them, and the caption nearest by its diagonal."""
    a, b = Box.of("a"), Box.of("b")
    large = figures.where(Box.of().area >= least_area)
    text = large.alias("a").join(strings.alias("b"), (F.col("a.page_id") == F.col("b.page_id")) & a.overlaps(b)).groupBy(F.col("a.page_id").alias("page_id"), F.col("a.figure_id").alias("figure_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("b.y1", "b.x1", "b.content"))), lambda x: x["content"]).alias("texts"))
    near = large.alias("a").join(captions.alias("b"), F.col("a.page_id") == F.col("b.page_id")).groupBy(F.col("a.page_id").alias("page_id"), F.col("a.figure_id").alias("figure_id")).agg(F.min(F.struct(a.diagonal_distance(b).alias("d"), F.col("b.area_id").alias("id"), F.col("b.content").alias("content")))["content"].alias("caption"))
    out = large.join(text, ["page_id", "figure_id"], "left").join(near, ["page_id", "figure_id"], "left")
    return out.select("page_id", "figure_id", "x1", "y1", "x2", "y2", "members", F.coalesce("texts", F.array().cast("array<string>")).alias("texts"), "caption")


def flat_csv(cells: DataFrame) -> DataFrame:
    """CSV lines of grid cells (page_id, rs, cs, header, content): the header rows of a column become one, parted by bars.

    A text that spans several places stands in each; equal texts under each other count once in a header.
    """
    places = cells.select("page_id", "header", "content", "cs", F.explode("rs").alias("r")).select("page_id", "header", "content", "r", F.explode("cs").alias("c"))
    head = places.where("header").groupBy("page_id", "c").agg(F.array_join(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("r", F.coalesce("content", F.lit("")).alias("t")))), lambda x: x["t"])), " | ").alias("t")).select("page_id", F.lit(-1).alias("r"), "c", "t")
    body = places.where("NOT header").select("page_id", F.col("r").cast("int").alias("r"), "c", F.coalesce("content", F.lit("")).alias("t"))
    quoted = F.concat(F.lit('"'), F.replace("t", F.lit('"'), F.lit('""')), F.lit('"'))
    rows = head.unionByName(body).groupBy("page_id", "r").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c", quoted.alias("q")))), lambda x: x["q"]), ",").alias("line"))
    return rows


def span_html(cells: DataFrame) -> DataFrame:
    """HTML tables of grid cells with row and column spans, header cells as such."""
    escaped = F.replace(F.replace(F.replace(F.coalesce("content", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    span = lambda name, c: F.when(F.size(c) > 1, F.concat(F.lit(f' {name}="'), F.size(c).cast("string"), F.lit('"'))).otherwise("")
    tag = F.when(F.col("header"), "th").otherwise("td")
    one = F.concat(F.lit("<"), tag, span("rowspan", "rs"), span("colspan", "cs"), F.lit(">"), escaped, F.lit("</"), tag, F.lit(">"))
    rows = cells.groupBy("page_id", F.array_min("rs").alias("r")).agg(F.sort_array(F.collect_list(F.struct(F.array_min("cs").alias("c"), one.alias("h")))).alias("l"))
    text = F.concat(F.lit("<tr>"), F.array_join(F.transform("l", lambda x: x["h"]), ""), F.lit("</tr>"))
    return rows.groupBy("page_id").agg(F.concat(F.lit("<table>"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", text.alias("h")))), lambda x: x["h"]), ""), F.lit("</table>")).alias("html"))


def download(wide: DataFrame, path: str, first: str = "glass_id") -> None:
    """The wide table as quoted CSV with a header; rows whose first cell is blank are left out."""
    wide.where(F.trim(F.col(first)) != "").write.option("header", True).option("quoteAll", True).csv(path)


def marked_grid(cells: DataFrame) -> DataFrame:
    """Lines of labelled tables for reading: row labels marked RL<, column labels CL<."""
    text = F.coalesce("content", F.lit(""))
    mark = F.when(F.col("column_label"), F.concat(F.lit("CL<"), text)).when(F.col("row_label"), F.concat(F.lit("RL<"), text)).otherwise(text)
    return _rows(cells.withColumn("content", mark), F.coalesce("content", F.lit(""))).select("table_id", "r", F.array_join("ts", " | ").alias("line"))


def json_records(rows: DataFrame) -> DataFrame:
    """One JSON text per row, stamped with the time of the query."""
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXX").alias("created")
    return rows.select(F.to_json(F.struct(stamp, *rows.columns)).alias("json"))
