"""Readers: native document JSON, table-annotation JSON, detection datasets, word lists, images and uploads.

All give normalised tables: documents, pages, areas, refs. Coordinates are pixels; points are converted
with the page's factors at ingest. Positioned text comes in as JSON or Parquet; a PDF extractor is a
plug-in (``pdf_areas``), as no PDF library is required here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geometry import Box, polyline_box
from ..functions.text import file_parts

_BOX = "STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE, img_sp: BOOLEAN>"
_PAGE = "STRUCT<oid: STRING, number: INT, img: STRING, xml_width: DOUBLE, xml_height: DOUBLE, img_width: DOUBLE, img_height: DOUBLE, factor_width: DOUBLE, factor_height: DOUBLE, layout: STRUCT<rotation: DOUBLE, typographic_columns: STRING, division: DOUBLE>>"
_AREA = f"STRUCT<oid: STRING, category: STRING, boundingBox: {_BOX}, data: MAP<STRING, STRING>, confidence: DOUBLE>"
NATIVE = f"oid STRING, pages STRUCT<byId: MAP<STRING, {_PAGE}>, allIds: ARRAY<STRING>>, areas STRUCT<byId: MAP<STRING, {_AREA}>, allIds: ARRAY<STRING>>, references STRUCT<byId: MAP<STRING, ARRAY<STRING>>, allIds: ARRAY<STRING>>, revisions ARRAY<STRUCT<timestamp: STRING, objects: ARRAY<STRING>, comment: STRING, del_objs: ARRAY<STRING>, reference_revoked: BOOLEAN>>, fonts ARRAY<STRUCT<oid: STRING, color: STRING, size: DOUBLE, style: ARRAY<STRING>>>, metadata MAP<STRING, STRING>, raw_pdf STRING"
TABLE_JSON = "MAP<STRING, STRUCT<oid: STRING, category: STRING, boundingBox: STRING, data: MAP<STRING, STRING>, confidence: DOUBLE>>"


def uploads(spark: SparkSession, path: str) -> DataFrame:
    """Files with id, suffix and format: native, table, xml, image, pdf or unknown."""
    files = spark.read.format("binaryFile").load(path)
    doc, suffix = file_parts(F.col("path"))
    files = files.select("path", "content", doc.alias("doc_id"), suffix.alias("suffix"))
    text = F.decode("content", "UTF-8")
    kind = F.when(F.col("suffix") == "json", F.when(F.get_json_object(text, "$.references").isNotNull(), "native").otherwise("table")).when(F.col("suffix") == "xml", "xml").when(F.col("suffix").isin("png", "jpg", "jpeg"), "image").when(F.col("suffix") == "pdf", "pdf").otherwise("unknown")
    return files.withColumn("format", kind)


def native_documents(texts: DataFrame, column: str = "value") -> DataFrame:
    """Parsed native documents; those without id, pages or areas are left out."""
    doc = texts.select(F.from_json(column, NATIVE).alias("d")).select("d.*")
    return doc.where("oid IS NOT NULL AND size(pages.byId) > 0 AND size(areas.byId) > 0")


def read_native(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """documents, pages, areas (pixels), refs, revisions and fonts of native JSON files."""
    docs = native_documents(spark.read.text(path, wholetext=True))
    d = docs.withColumnRenamed("oid", "doc_id")
    pages = d.select("doc_id", F.explode("pages.byId").alias("page_id", "p")).select("doc_id", "page_id", "p.*").drop("oid")
    refs = d.select("doc_id", F.explode("references.byId").alias("parent_id", "ids")).select("doc_id", "parent_id", F.posexplode("ids").alias("pos", "child_id"))
    raw = d.select("doc_id", F.col("areas.allIds").alias("ids"), F.explode("areas.byId").alias("area_id", "a"))
    raw = raw.select("doc_id", "area_id", "a.category", "a.data", "a.confidence", F.col("a.boundingBox").alias("box"), F.array_position("ids", F.col("area_id")).alias("ord"))
    place = refs.join(pages.select("doc_id", F.col("page_id").alias("parent_id"), "factor_width", "factor_height"), ["doc_id", "parent_id"]).select("doc_id", F.col("child_id").alias("area_id"), F.col("parent_id").alias("page_id"), "factor_width", "factor_height")
    met = raw.join(place, ["doc_id", "area_id"], "left")
    b = Box(*[F.col(f"box.{c}") for c in ("x1", "y1", "x2", "y2")]).normalized()
    scale = [F.when(F.col("box.img_sp"), F.lit(1.0)).otherwise(F.coalesce(c, F.lit(1.0))) for c in ("factor_width", "factor_height")]
    areas = met.select("doc_id", "page_id", "area_id", "category", *b.scaled(*scale).columns(), F.when(F.col("box.img_sp"), "img").otherwise("xml").alias("space"), F.col("data")["content"].alias("content"), "data", "confidence", "ord")
    return {"documents": d.select("doc_id", "metadata", F.unbase64("raw_pdf").alias("raw_pdf")), "pages": pages, "areas": areas, "refs": refs, "revisions": d.select("doc_id", F.posexplode("revisions").alias("rev", "r")).select("doc_id", "rev", "r.*", F.try_to_timestamp("r.timestamp").alias("at")), "fonts": d.select("doc_id", F.explode("fonts").alias("f")).select("doc_id", "f.*")}


def read_table_json(spark: SparkSession, path: str) -> DataFrame:
    """Areas of table-annotation files; boxes are structs for tables and polylines for the rest."""
    files = spark.read.format("binaryFile").load(path)
    doc, _ = file_parts(F.col("path"))
    one = files.select(doc.alias("doc_id"), F.explode(F.from_json(F.decode("content", "UTF-8"), TABLE_JSON)).alias("key", "a")).select("doc_id", "key", "a.*").where("category IS NOT NULL")
    line = polyline_box(F.from_json("boundingBox", "ARRAY<ARRAY<DOUBLE>>"))
    own = F.from_json("boundingBox", _BOX)
    is_table = F.col("category") == "Table"
    pick = [F.when(is_table, own[c]).otherwise(getattr(line, c)).alias(c) for c in ("x1", "y1", "x2", "y2")]
    return one.select("doc_id", F.coalesce("oid", "key").alias("area_id"), "category", *pick, F.col("data")["content"].alias("content"), "confidence")


def synthetic_page(areas: DataFrame) -> dict[str, DataFrame]:
    """One page for each document of table annotations, and its table's references to all other areas."""
    first = areas.where("category = 'Table'").groupBy("doc_id").agg(F.min("area_id").alias("parent_id"))
    size = areas.groupBy("doc_id").agg(F.max("x2").alias("img_width"), F.max("y2").alias("img_height"))
    refs = areas.where("category <> 'Table'").join(first, "doc_id").select("doc_id", "parent_id", F.col("area_id").alias("child_id"), (F.row_number().over(Window.partitionBy("doc_id").orderBy("area_id")) - 1).alias("pos"))
    return {"pages": size.select("doc_id", F.lit(0).alias("number"), "img_width", "img_height"), "refs": refs}


def read_coco(spark: SparkSession, path: str) -> DataFrame:
    """Annotations with image and category names; crowds and degenerate boxes are left out."""
    schema = "images ARRAY<STRUCT<id: LONG, file_name: STRING, width: DOUBLE, height: DOUBLE>>, annotations ARRAY<STRUCT<id: LONG, image_id: LONG, category_id: LONG, bbox: ARRAY<DOUBLE>, iscrowd: INT>>, categories ARRAY<STRUCT<id: LONG, name: STRING>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    ann = raw.select(F.explode("annotations").alias("a")).select("a.*").where("coalesce(iscrowd, 0) = 0")
    img = raw.select(F.explode("images").alias("i")).select(F.col("i.id").alias("image_id"), "i.file_name", "i.width", "i.height")
    cat = raw.select(F.explode("categories").alias("c")).select(F.col("c.id").alias("category_id"), F.col("c.name").alias("category"))
    b = [F.greatest(F.lit(0.0), c) for c in (F.get("bbox", F.lit(0)), F.get("bbox", F.lit(1)), F.get("bbox", F.lit(0)) + F.get("bbox", F.lit(2)), F.get("bbox", F.lit(1)) + F.get("bbox", F.lit(3)))]
    out = ann.join(img, "image_id").join(cat, "category_id")
    return out.select("image_id", "id", "file_name", "category", b[0].alias("x1"), b[1].alias("y1"), F.least(b[2], F.col("width")).alias("x2"), F.least(b[3], F.col("height")).alias("y2")).where("x2 > x1 AND y2 > y1")


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """A word list with counts."""
    return spark.read.text(path).where("trim(value) <> ''").groupBy(F.trim("value").alias("word")).agg(F.count("*").alias("n"))


def read_page_xml(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of PAGE-like XML."""
    return spark.read.format("xml").option("rowTag", "TextLine").load(path)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """One single-page document per image."""
    img = spark.read.format("image").load(path)
    doc, _ = file_parts(F.col("image.origin"))
    return img.select(doc.alias("doc_id"), F.lit(0).alias("number"), F.col("image.width").cast("double").alias("img_width"), F.col("image.height").cast("double").alias("img_height"))


def html_rows(pages: DataFrame, key: str, tags: tuple[str, ...] = ("tr",), cells: tuple[str, ...] = ("td", "th")) -> DataFrame:
    """Rows of the tables of HTML pages: (key, n, content without tags, cells as an array of texts)."""
    any_of = "|".join(tags)
    found = F.regexp_extract_all("html", F.lit(rf"(?s)<(?:{any_of})[^>]*>(.*?)</(?:{any_of})>"), F.lit(1))
    plain = lambda c: F.trim(F.regexp_replace(c, "<[^>]*>", ""))
    cell = F.regexp_extract_all("h", F.lit(rf"(?s)<(?:{'|'.join(cells)})[^>]*>(.*?)</(?:{'|'.join(cells)})>"), F.lit(1))
    return pages.select(key, F.posexplode(found).alias("n", "h")).select(key, "n", plain(F.col("h")).alias("content"), F.transform(cell, plain).alias("cells"))


def native_json(pages: DataFrame, areas: DataFrame, refs: DataFrame) -> DataFrame:
    """Native documents (doc_id, json) from their tables, as ``read_native`` takes them: boxes in pixels, empty data and confidence left out."""
    box = F.struct("x1", "y1", "x2", "y2", F.lit(True).alias("img_sp"))
    data = F.when(F.col("content").isNotNull(), F.create_map(F.lit("content"), F.col("content")))
    by_id = lambda ids, rows: F.map_from_entries(F.collect_list(F.struct(ids, rows)))
    table = lambda df, key, row, name: df.groupBy("doc_id").agg(F.struct(by_id(F.col(key), row).alias("byId"), F.sort_array(F.collect_list(key)).alias("allIds")).alias(name))
    text = lambda c: F.col(c).cast("string")
    p = table(pages.withColumn("page_id", text("page_id")), "page_id", F.struct(F.col("page_id").alias("oid"), "number", "factor_width", "factor_height"), "pages")
    a = table(areas.withColumn("area_id", text("area_id")), "area_id", F.struct(F.col("area_id").alias("oid"), "category", box.alias("boundingBox"), data.alias("data"), F.nullif("confidence", F.lit(0.0)).alias("confidence")), "areas")
    children = refs.groupBy("doc_id", text("parent_id").alias("parent_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", text("child_id").alias("c")))), lambda x: x["c"]).alias("cs"))
    r = children.groupBy("doc_id").agg(F.struct(F.map_from_entries(F.collect_list(F.struct("parent_id", "cs"))).alias("byId"), F.sort_array(F.collect_list("parent_id")).alias("allIds")).alias("references"))
    out = p.join(a, "doc_id").join(r, "doc_id", "left")
    return out.select("doc_id", F.to_json(F.struct(F.col("doc_id").cast("string").alias("oid"), "pages", "areas", "references")).alias("json"))


def biblio_fields(rows: DataFrame) -> DataFrame:
    """Bibliographic rows (patent_no, inid, content) as one record per patent."""
    pick = lambda code, name: F.max(F.when(F.contains("inid", F.lit(code)), F.col("content"))).alias(name)
    return rows.groupBy("patent_no").agg(pick("54", "title"), pick("72", "inventor"), pick("71", "applicant"), pick("73", "assignee"), F.coalesce(F.max(F.when(F.contains("inid", F.lit("45")), F.col("content"))), F.max(F.when(F.contains("inid", F.lit("43")), F.col("content")))).alias("published"), pick("51", "ipc"), pick("57", "abstract"))


def pdf_areas(files: DataFrame, extract: Callable[[str, bytes], list[tuple]]) -> DataFrame:
    """Areas from PDFs with a supplied extractor: (page, category, x1, y1, x2, y2, content) per area, in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(doc, *a) for doc, content in zip(batch["doc_id"], batch["content"]) for a in extract(doc, content)]
            yield pd.DataFrame(rows, columns=["doc_id", "page_id", "category", "x1", "y1", "x2", "y2", "content"])

    return files.select("doc_id", "content").mapInPandas(run, "doc_id string, page_id long, category string, x1 double, y1 double, x2 double, y2 double, content string")
