"""Queries over detections, spans, maps and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import structure
from .box_queries import _B
from .fixtures import boxes, table
from .registry import query

_ROWS = ", rw AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY y1, area_id) - 1 AS INTEGER) AS r, y1, y2 FROM b WHERE category = 'Line') "


def _rows(b):
    from pyspark.sql import Window

    return b.where("category = 'Line'").select("page_id", (F.row_number().over(Window.partitionBy("page_id").orderBy("y1", "area_id")) - 1).alias("r"), "y1", "y2")


@query("header_rows_prefix", _B + _ROWS + ", m AS (SELECT * FROM rw WHERE EXISTS (SELECT 1 FROM b h WHERE h.category = 'TableCell' AND h.page_id = rw.page_id AND greatest(least(rw.y2, h.y2) - greatest(rw.y1, h.y1), 0) >= 0.5 * (rw.y2 - rw.y1))) SELECT page_id, r, y1, y2 FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY r) - 1 AS k FROM m) WHERE k = r")
def header_rows_prefix(spark, d):
    b = boxes(spark, d)
    return structure.header_rows(_rows(b), b.where("category = 'TableCell'"))


@query("supercell_align", _B + _ROWS + "SELECT a.page_id, a.area_id, min(r) AS first, max(r) AS last, count(*) AS n FROM b a JOIN rw ON rw.page_id = a.page_id AND greatest(least(a.y2, rw.y2) - greatest(a.y1, rw.y1), 0) >= 0.5 * (rw.y2 - rw.y1) WHERE a.category = 'TableCell' GROUP BY 1, 2")
def supercell_align(spark, d):
    b = boxes(spark, d)
    return structure.span_lines(b.where("category = 'TableCell'"), _rows(b))


@query("area_merge_maps", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus || o_orderpriority ELSE o_orderstatus END AS content, o_orderpriority AS font FROM orders")
def area_merge_maps(spark, d):
    o = table(spark, d, "orders")
    a = F.create_map(F.lit("content"), F.col("o_orderstatus"))
    b = F.when(F.col("o_orderkey") % 2 == 0, F.create_map(F.lit("content"), F.col("o_orderpriority"), F.lit("font"), F.col("o_orderpriority"))).otherwise(F.create_map(F.lit("font"), F.col("o_orderpriority")))
    m = structure.merge_data(a, b)
    return o.select("o_orderkey", m["content"].alias("content"), m["font"].alias("font"))


@query("ocr_word_split", "WITH l AS (SELECT p_partkey AS id, p_name AS s, string_split(p_name, ' ') AS ws, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS i FROM part) SELECT id, CAST(i - 1 AS INTEGER) AS word_no, ws[i] AS word, round(600.0 / length(s) * coalesce(list_sum(list_transform(ws[1 : i - 1], lambda x: length(x) + 1)), 0), 6) AS x1, round(600.0 / length(s) * (coalesce(list_sum(list_transform(ws[1 : i - 1], lambda x: length(x) + 1)), 0) + length(ws[i])), 6) AS x2 FROM l WHERE ws[i] <> ''")
def ocr_word_split(spark, d):
    lines = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("content"), F.lit(0.0).alias("x1"), F.lit(600.0).alias("x2"))
    return structure.split_words(lines).select("id", "word_no", "word", F.round("x1", 6).alias("x1"), F.round("x2", 6).alias("x2"))


@query("set_operations", "WITH s AS (SELECT l_orderkey, list_sort(list(DISTINCT l_suppkey)) AS a, list_sort(list(DISTINCT l_partkey % 100)) AS b FROM lineitem GROUP BY 1) SELECT l_orderkey, len(list_filter(a, lambda x: NOT list_contains(b, x))) + len(list_filter(b, lambda x: NOT list_contains(a, x))) AS n_changed, len(list_intersect(a, b)) AS n_common, len(list_filter(a, lambda x: NOT list_contains(b, x))) = 0 AS within FROM s")
def set_operations(spark, d):
    s = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("a"), F.collect_set(F.col("l_partkey") % 100).alias("b"))
    changed = F.array_union(F.array_except("a", "b"), F.array_except("b", "a"))
    return s.select("l_orderkey", F.size(changed).cast("long").alias("n_changed"), F.size(F.array_intersect("a", "b")).cast("long").alias("n_common"), (F.size(F.array_except("a", "b")) == 0).alias("within"))


@query("slot_confidence", _B + ", s AS (SELECT a.area_id, greatest(least(a.x2, o.x2) - greatest(a.x1, o.x1), 0) * greatest(least(a.y2, o.y2) - greatest(a.y1, o.y1), 0) / ((a.x2 - a.x1) * (a.y2 - a.y1)) AS share FROM b a JOIN b o ON a.page_id = o.page_id AND a.area_id <> o.area_id AND a.x1 < o.x2 AND o.x1 < a.x2 AND a.y1 < o.y2 AND o.y1 < a.y2 WHERE a.category = 'String' AND o.category = 'TableCell') SELECT area_id, round((avg(share) + min(share)) / 2, 9) AS confidence FROM s GROUP BY 1")
def slot_confidence(spark, d):
    from ..operators import spatial

    b = boxes(spark, d)
    met = spatial.slots(b.where("category = 'String'"), b.where("category = 'TableCell'"), 0.0, unique=False)
    return structure.confidence(met, "area_id").withColumn("confidence", F.round("confidence", 9))


@query("detection_precision")
def detection_precision(spark, d):
    from ..operators import evaluation

    b = boxes(spark, d).withColumnsRenamed({"category": "label", "confidence": "score"})
    found, truth = b.where("area_id % 3 > 0"), b.where("area_id % 2 = 0")
    out = evaluation.precision_curves(evaluation.greedy_matches(found, truth), truth)
    return out.select("label", *[F.round(c, 9).alias(c) for c in ("ap", "recall", "precision")], F.round(structure.f1(F.col("precision"), F.col("recall")), 9).alias("f1"))
