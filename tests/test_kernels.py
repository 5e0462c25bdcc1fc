"""Order-dependent kernels, sources, sinks, pipelines and streams against plain Python or round trips."""

import json

import pytest
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.geometry import Box
from docloom.operators import cluster, tables
from docloom.plans import pipeline
from docloom.plans.fixtures import boxes, grid
from docloom.sources import readers, writers


def areas(spark, rows):
    return spark.createDataFrame([(0, i, *map(float, b), 0.5) for i, b in enumerate(rows)], "page_id long, area_id long, x1 double, y1 double, x2 double, y2 double, confidence double")


def test_first_fit_cells_merge_and_line_blocks(spark):
    strings = areas(spark, [(0, 0, 10, 10), (20, 0, 30, 10), (100, 0, 110, 10)])
    none = areas(spark, [(500, 500, 501, 501)])
    got = {tuple(sorted(r.members)) for r in cluster.first_fit_cells(strings, none).collect()}
    assert got == {(0, 1), (2,)}
    line = areas(spark, [(15, 0, 16, 20)])
    assert len(cluster.first_fit_cells(strings, line).collect()) == 3


def test_nms_modes(spark):
    b = areas(spark, [(0, 0, 10, 10), (1, 1, 11, 11), (50, 50, 60, 60)])
    merged = {tuple(r.members): (r.x1, r.x2) for r in cluster.nms(b, 0.1).collect()}
    assert merged == {(0, 1): (0.0, 11.0), (2,): (50.0, 60.0)}
    assert cluster.nms(b, 0.1, "delete").count() == 2
    assert cluster.nms(b, 0.99, "score", "iou").count() == 3


def test_reading_order_anchor(spark):
    got = {r.area_id: r.place for r in cluster.reading_order(areas(spark, [(50, 0, 60, 10), (0, 5, 10, 15), (0, 14, 10, 24)])).collect()}
    assert got == {1: 1, 0: 2, 2: 3}


def test_merge_boxes_fixpoint(spark):
    got = [sorted(r.members) for r in cluster.merge_boxes(areas(spark, [(0, 0, 10, 10), (15, 0, 25, 10), (30, 0, 40, 10), (200, 0, 210, 10)]), 6, 0).collect()]
    assert sorted(got) == [[0, 1, 2], [3]]


def test_row_islands_match_components(spark, sf):
    got = cluster.row_islands(boxes(spark, sf).where("page_id < 3"), 3.0).toPandas()
    for _, page in got.groupby("page_id"):
        p = page.sort_values(["y1", "area_id"])
        label, reach, n = [], None, 0
        for y1, y2 in zip(p.y1, p.y2):
            if reach is None or y1 > reach - 3:
                n += 1
            reach = y2 if reach is None else max(reach, y2)
            label.append(n)
        assert label == p.row_no.tolist()


@pytest.mark.parametrize("raw,fixed", [("SiO2 [mol%|", "SiO2 [mol%]"), ("B2O3 /wt%]", "B2O3 [wt%]"), ("x [y]", "x [y]"), ("plain", "plain")])
def test_brackets(spark, raw, fixed):
    assert spark.createDataFrame([(raw,)], "s string").select(T.fix_brackets(F.col("s"))).first()[0] == fixed


def test_text_rules(spark):
    row = spark.createDataFrame([("Date: March 5, 2013 x", "XIV", "1. .5 %", "Ex. 12")], "d string, r string, v string, e string")
    assert tuple(row.select(T.month_date(F.col("d")), T.roman(F.col("r")), T.clean_value(F.col("v")), T.example_id(F.col("e"))).first()) == ("2013-03-05", 14, "1.5", "Ex-12")


def test_intersection_null_and_gap(spark):
    two = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0, 3.0, 3.0, 4.0, 4.0)], "a double, b double, c double, d double, e double, f double, g double, h double")
    x, y = Box(*map(F.col, "abcd")), Box(*map(F.col, "efgh"))
    assert two.select(x.intersection(y).x1).first()[0] is None
    assert two.select(x.intersection(y, gap=True).x1).first()[0] == 1.0


def test_native_json_round_trip(spark, tmp_path):
    box = {"x1": 1, "y1": 2, "x2": 3, "y2": 4, "img_sp": False}
    doc = {"oid": "d", "pages": {"byId": {"p": {"oid": "p", "number": 0, "factor_width": 2.0, "factor_height": 2.0}}, "allIds": ["p"]}, "areas": {"byId": {"a": {"oid": "a", "category": "String", "boundingBox": box, "data": {"content": "x"}}}, "allIds": ["a"]}, "references": {"byId": {"p": ["a"]}, "allIds": ["p"]}}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    (tmp_path / "bad.json").write_text(json.dumps({"oid": "e"}))
    got = readers.read_native(spark, str(tmp_path))
    assert [tuple(r) for r in got["areas"].select("area_id", "x1", "y2", "content").collect()] == [("a", 2.0, 8.0, "x")]
    assert got["documents"].count() == 1


def test_table_json_and_uploads(spark, tmp_path):
    (tmp_path / "t.1.json").write_text(json.dumps({"T": {"oid": "T", "category": "Table", "boundingBox": {"x1": 0, "y1": 0, "x2": 9, "y2": 9}}, "c": {"oid": "c", "category": "TableCell", "boundingBox": [[1, 2], [5, 3]], "data": {"content": "z"}}}))
    got = {r.area_id: (r.x1, r.y1, r.x2, r.y2) for r in readers.read_table_json(spark, str(tmp_path)).collect()}
    assert got == {"T": (0, 0, 9, 9), "c": (1, 2, 5, 3)}
    up = readers.uploads(spark, str(tmp_path)).first()
    assert (up.doc_id, up.suffix, up.format) == ("t1", "json", "table")


def test_coco_reader(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"images": [{"id": 1, "file_name": "a", "width": 10, "height": 10}], "categories": [{"id": 7, "name": "t"}], "annotations": [{"id": 1, "image_id": 1, "category_id": 7, "bbox": [1, 1, 20, 3], "iscrowd": 0}, {"id": 2, "image_id": 1, "category_id": 7, "bbox": [1, 1, 0, 3], "iscrowd": 0}]}))
    assert [(r.x1, r.x2) for r in readers.read_coco(spark, str(tmp_path)).collect()] == [(1.0, 10.0)]


def test_exports(spark, sf, tmp_path):
    cells = tables.upright(grid(spark, sf).where("table_id < 30"))
    writers.write_lines(writers.table_lines(cells), str(tmp_path / "csv"))
    assert spark.read.text(str(tmp_path / "csv")).count() == writers.table_lines(cells).count()
    assert writers.svg_pages(boxes(spark, sf).where("page_id = 0")).first().svg.startswith("<svg")
    assert "<th>" in writers.html_tables(cells).first().html


def test_pipeline_config(spark, sf, tmp_path):
    config = [{"name": "p", "modules": [{"name": "FunctionalRecognizer", "parameter": {"no_predefined_row_labels": 1}}, {"name": "GlassExtractorISC"}]}]
    (tmp_path / "p.json").write_text(json.dumps(config))
    p = pipeline.load(spark, str(tmp_path / "p.json"))["p"]
    out = p.run({"table_cells": grid(spark, sf).where("table_id < 200")})
    assert len(p) == 2 and out["setpoints"].count() > 0 and out["labels"].count() > 0
    with pytest.raises(ValueError):
        pipeline.Pipeline("x").add("Nothing")
    with pytest.raises(ValueError):
        pipeline.Pipeline("x").add("CellDetector", odd=1)


def test_stream_of_files(spark, tmp_path):
    from docloom.streaming.ingest import ingest_files

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("{}")
    ingest_files(spark, str(tmp_path / "in"), lambda f: f.select("path"), str(tmp_path / "r"), str(tmp_path / "j"), str(tmp_path / "k"))
    assert [r.state for r in spark.read.parquet(str(tmp_path / "j")).collect()] == ["done"]


def test_pdf_plugin(spark):
    files = spark.createDataFrame([("d", bytearray(b"x"))], "doc_id string, content binary")
    assert readers.pdf_areas(files, lambda doc, content: [(0, "String", 0.0, 0.0, 1.0, 1.0, content.decode())]).first().content == "x"


def test_fuzzy_and_units(spark):
    from docloom.functions import knowledge
    from docloom.operators import dictionary

    tok = spark.createDataFrame([("glas",), ("zzz",)], "token string")
    words = spark.createDataFrame([("glass",), ("glaze",)], "word string")
    assert [tuple(r) for r in dictionary.close_words(tok, words).collect()] == [("glas", "glass", 1)]
    lines = spark.createDataFrame([("in mol% of",), ("nothing",)], "content string")
    assert dictionary.line_units(lines, knowledge.units(spark)).first().unit == "mol%"
