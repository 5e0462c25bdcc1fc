"""Evaluation of moved copies of all boxes, some left out, against the boxes themselves, some of them crowds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluation
from .fixtures import BOXES_SQL, boxes
from .registry import query

_SIZES = ", ".join(f"('{k}', {lo}, {hi})" for k, (lo, hi) in evaluation.SIZES.items())
_OVER = ", ".join(f"({o}::DOUBLE)" for o in evaluation.OVERLAPS)
_JUDGED = f"""WITH RECURSIVE b AS ({BOXES_SQL}),
t AS (SELECT page_id, category AS label, area_id, x1, y1, x2, y2, area_id % 13 = 0 AS crowd, (x2 - x1) * (y2 - y1) AS size FROM b),
d AS (SELECT *, (x2 - x1) * (y2 - y1) AS size, row_number() OVER (PARTITION BY page_id, label ORDER BY score DESC, area_id) AS place FROM (SELECT page_id, category AS label, area_id, (area_id * 7919 % 1000) / 1000 AS score, x1 + area_id % 7 - 3 AS x1, y1 + area_id % 5 - 2 AS y1, x2 + area_id % 7 - 3 + area_id % 3 AS x2, y2 + area_id % 5 - 2 AS y2 FROM b WHERE area_id % 11 <> 0)),
p AS (SELECT d.page_id, d.label, d.place, t.area_id, t.crowd, t.size, CASE WHEN t.crowd THEN w * h / d.size ELSE w * h / (d.size + t.size - w * h) END AS iou FROM (SELECT d.*, t, least(d.x2, t.x2) - greatest(d.x1, t.x1) AS w, least(d.y2, t.y2) - greatest(d.y1, t.y1) AS h FROM d JOIN t ON d.page_id = t.page_id AND d.label = t.label AND d.x1 < t.x2 AND t.x1 < d.x2 AND d.y1 < t.y2 AND t.y1 < d.y2) d),
s(boxes, lo, hi) AS (VALUES {_SIZES}),
n AS (SELECT page_id, label, place, boxes, list_sort(list({{'other': crowd OR size < lo OR size > hi, 'i': -iou, 'g': -area_id, 'crowd': crowd}})) AS near FROM p, s WHERE iou >= 0.5 GROUP BY ALL),
e AS (SELECT d.page_id, d.label, d.area_id, d.score, d.place, s.boxes, coalesce(near, []) AS near, d.size < lo OR d.size > hi AS odd FROM d CROSS JOIN s LEFT JOIN n ON n.page_id = d.page_id AND n.label = d.label AND n.place = d.place AND n.boxes = s.boxes WHERE d.place <= 100),
o(overlap) AS (VALUES {_OVER}),
r AS (
  SELECT page_id, label, boxes, overlap, 0::BIGINT AS place, []::BIGINT[] AS taken, NULL::BIGINT AS area_id, 0::DOUBLE AS score, false AS hit, false AS ignored FROM (SELECT DISTINCT page_id, label, boxes FROM e), o
  UNION ALL
  SELECT page_id, label, boxes, overlap, place, CASE WHEN f IS NOT NULL AND NOT f.crowd THEN list_append(taken, f.g) ELSE taken END, area_id, score, f IS NOT NULL, CASE WHEN f IS NULL THEN odd ELSE f.other END
  FROM (SELECT r.page_id, r.label, r.boxes, r.overlap, e.place, r.taken, e.area_id, e.score, e.odd, list_filter(e.near, lambda x: -x.i >= r.overlap AND NOT list_contains(r.taken, x.g))[1] AS f FROM r JOIN e ON e.page_id = r.page_id AND e.label = r.label AND e.boxes = r.boxes AND e.place = r.place + 1)
),
j AS (SELECT * FROM r WHERE place > 0)
"""
_CURVES = f""", m(most) AS (VALUES (1), (10), (100)),
k AS (SELECT label, boxes, count(*) AS n FROM t, s WHERE NOT crowd AND size BETWEEN lo AND hi GROUP BY ALL),
c AS (SELECT j.label, j.boxes, overlap, most, n, sum(CAST(hit AS BIGINT)) OVER w AS tp, row_number() OVER w AS seen FROM j JOIN m ON place <= most JOIN k ON k.label = j.label AND k.boxes = j.boxes WHERE NOT ignored WINDOW w AS (PARTITION BY j.label, j.boxes, overlap, most ORDER BY score DESC, page_id, area_id ROWS UNBOUNDED PRECEDING)),
g AS (SELECT label, boxes, overlap, most, max(tp) AS tp, list({{'k': (tp * 100) // n, 'p': tp / seen}}) AS ps FROM c GROUP BY ALL),
a AS (SELECT label, boxes, overlap, most, tp, list_sum(list_transform(range(0, 101), lambda i: coalesce(list_max(list_transform(list_filter(ps, lambda x: x.k >= i), lambda x: x.p)), 0))) / 101 AS ap FROM g),
v AS (SELECT k.label, k.boxes, overlap, most, coalesce(ap, 0) AS ap, coalesce(tp, 0) / n AS recall FROM k CROSS JOIN o CROSS JOIN m LEFT JOIN a USING (label, boxes, overlap, most))
"""


def _moved(spark, d: str) -> tuple[DataFrame, DataFrame]:
    b = boxes(spark, d).withColumnRenamed("category", "label")
    i = F.col("area_id")
    moved = b.where(i % 11 != 0).select("page_id", "label", "area_id", (i * 7919 % 1000 / 1000).alias("score"), *[(F.col(c) + i % 7 - 3 + (i % 3 if c == "x2" else 0)).alias(c) for c in ("x1", "x2")], *[(F.col(c) + i % 5 - 2).alias(c) for c in ("y1", "y2")])
    return moved, b.select("page_id", "label", "area_id", "x1", "y1", "x2", "y2", (i % 13 == 0).alias("crowd"))


@query("judged_boxes", _JUDGED + "SELECT page_id, label, area_id, boxes, overlap, hit, ignored FROM j")
def judged_boxes(spark, d):
    """Every detection at ten overlaps and four ranges of sizes."""
    return evaluation.judged_boxes(*_moved(spark, d)).select("page_id", "label", "area_id", "boxes", "overlap", "hit", "ignored")


@query("recall_precision", _JUDGED + _CURVES + "SELECT label, boxes, overlap, most, round(ap, 9) AS ap, round(recall, 9) AS recall FROM v")
def recall_precision(spark, d):
    moved, truth = _moved(spark, d)
    return evaluation.recall_precision(evaluation.judged_detections(moved, truth), truth).select("label", "boxes", "overlap", "most", F.round("ap", 9).alias("ap"), F.round("recall", 9).alias("recall"))


@query("box_evaluation", _JUDGED + _CURVES + "SELECT boxes, most, round(avg(ap), 9) AS ap, round(avg(ap) FILTER (overlap = 0.5), 9) AS ap50, round(avg(ap) FILTER (overlap = 0.75), 9) AS ap75, round(avg(recall), 9) AS ar FROM v GROUP BY ALL")
def box_evaluation(spark, d):
    found = evaluation.box_evaluation(*_moved(spark, d))
    return found.select("boxes", "most", *[F.round(c, 9).alias(c) for c in ("ap", "ap50", "ap75", "ar")])
