"""Queries over boxes: geometry, spatial joins, grouping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geometry import Box, hull
from ..operators import cluster, references, spatial
from .fixtures import BOXES_SQL, boxes, table
from .registry import query

_B = f"WITH b AS ({BOXES_SQL}) "
_PAIR = _B + ", p AS (SELECT a.area_id AS a_id, c.area_id AS b_id, a.x1, a.y1, a.x2, a.y2, c.x1 AS ox1, c.y1 AS oy1, c.x2 AS ox2, c.y2 AS oy2 FROM b a JOIN b c ON a.page_id = c.page_id AND a.area_id < c.area_id) "
_MEET = "x1 < ox2 AND ox1 < x2 AND y1 < oy2 AND oy1 < y2"
_CA = "(greatest(least(x2, ox2) - greatest(x1, ox1), 0) * greatest(least(y2, oy2) - greatest(y1, oy1), 0))"
_A, _O = "((x2 - x1) * (y2 - y1))", "((ox2 - ox1) * (oy2 - oy1))"
_H = "((greatest(x2, ox2) - least(x1, ox1)) * (greatest(y2, oy2) - least(y1, oy1)))"


def _cat(df, *names):
    return df.where(F.col("category").isin(*names))


def _pairs(spark, d, test):
    b = boxes(spark, d)
    return spatial.box_join(b, b, lambda x, y: (F.col("a.area_id") < F.col("b.area_id")) & test(x, y), distinct=None)


def _ids():
    return [F.col("a.area_id").alias("a_id"), F.col("b.area_id").alias("b_id")]


@query("box_normalize", _B + "SELECT area_id, least(greatest(x1 - 300, 0), greatest(x2 - 300, 0)) AS x1, least(greatest(400 - y1, 0), greatest(400 - y2, 0)) AS y1, greatest(greatest(x1 - 300, 0), greatest(x2 - 300, 0)) AS x2, greatest(greatest(400 - y1, 0), greatest(400 - y2, 0)) AS y2 FROM b")
def box_normalize(spark, d):
    b = Box.of()
    return boxes(spark, d).select("area_id", *Box(b.x1 - 300, 400 - b.y1, b.x2 - 300, 400 - b.y2).normalized().columns())


@query("box_metrics", _B + f"SELECT area_id, x2 - x1 AS w, y2 - y1 AS h, {_A} AS area, (x1 + x2) * 0.5 AS mx, (y1 + y2) * 0.5 AS my, y2 - y1 > x2 - x1 AS vertical, x2 - x1 > y2 - y1 AS horizontal FROM b")
def box_metrics(spark, d):
    b = Box.of()
    return boxes(spark, d).select("area_id", b.width.alias("w"), b.height.alias("h"), b.area.alias("area"), b.middle[0].alias("mx"), b.middle[1].alias("my"), b.is_vertical.alias("vertical"), b.is_horizontal.alias("horizontal"))


@query("box_space_convert", _B + "SELECT area_id, x1 * 2.5 AS x1, y1 * 2.0 AS y1, x2 * 2.5 AS x2, y2 * 2.0 AS y2 FROM b")
def box_space_convert(spark, d):
    return boxes(spark, d).select("area_id", *Box.of().scaled(F.lit(2.5), F.lit(2.0)).columns())


@query("box_transpose", _B + "SELECT area_id, y1 AS x1, -x2 AS y1, y2 AS x2, -x1 AS y2 FROM b")
def box_transpose(spark, d):
    return boxes(spark, d).select("area_id", *Box.of().transposed().columns())


@query("box_centre_form", _B + "SELECT area_id, (x1 + x2) * 0.5 AS cx, (y1 + y2) * 0.5 AS cy, x2 - x1 AS w, y2 - y1 AS h, greatest(0, least(1000, CAST(trunc(x1 / 650.0 * 1000) AS INTEGER))) AS t FROM b")
def box_centre_form(spark, d):
    c = Box.of().centred()
    return boxes(spark, d).select("area_id", *[v.alias(n) for v, n in zip(c, ("cx", "cy", "w", "h"))], Box.of().thousandths(F.lit(650.0), F.lit(850.0))[0].alias("t"))


@query("box_pair_overlap", _PAIR + f"SELECT a_id, b_id, greatest(x1, ox1) AS x1, greatest(y1, oy1) AS y1, least(x2, ox2) AS x2, least(y2, oy2) AS y2 FROM p WHERE {_MEET}")
def box_pair_overlap(spark, d):
    a, b = Box.of("a"), Box.of("b")
    return _pairs(spark, d, lambda x, y: x.overlaps(y)).select(*_ids(), *a.intersection(b).columns())


@query("box_pair_iou", _PAIR + f"SELECT a_id, b_id, {_CA} / ({_A} + {_O} - {_CA}) AS iou, {_CA} / {_H} AS hull_iou, {_CA} / {_A} AS share FROM p WHERE {_MEET}")
def box_pair_iou(spark, d):
    a, b = Box.of("a"), Box.of("b")
    return _pairs(spark, d, lambda x, y: x.overlaps(y)).select(*_ids(), a.iou(b).alias("iou"), a.hull_iou(b).alias("hull_iou"), a.covered_share(b).alias("share"))


@query("box_giou", _PAIR + f"SELECT a_id, b_id, {_CA} / ({_A} + {_O} - {_CA}) - ({_H} - ({_A} + {_O} - {_CA})) / {_H} AS giou FROM p WHERE {_MEET}")
def box_giou(spark, d):
    return _pairs(spark, d, lambda x, y: x.overlaps(y)).select(*_ids(), Box.of("a").giou(Box.of("b")).alias("giou"))


@query("box_pair_contains", _PAIR + "SELECT a_id, b_id, x1 <= ox1 AND x2 >= ox2 AND y1 <= oy1 AND y2 >= oy2 AS holds FROM p WHERE (x1 <= ox1 AND x2 >= ox2 AND y1 <= oy1 AND y2 >= oy2) OR (ox1 <= x1 AND ox2 >= x2 AND oy1 <= y1 AND oy2 >= y2)")
def box_pair_contains(spark, d):
    return _pairs(spark, d, lambda x, y: x.contains(y) | y.contains(x)).select(*_ids(), Box.of("a").contains(Box.of("b")).alias("holds"))


@query("box_pair_gaps", _PAIR + "SELECT a_id, b_id, greatest(ox1 - x2, x1 - ox2, 0) AS gx, greatest(oy1 - y2, y1 - oy2, 0) AS gy FROM p WHERE y1 <= oy2 AND y2 >= oy1 AND greatest(ox1 - x2, x1 - ox2, 0) <= 35")
def box_pair_gaps(spark, d):
    a, b = Box.of("a"), Box.of("b")
    return _pairs(spark, d, lambda x, y: x.meets_y(y) & (x.gap_x(y) <= 35)).select(*_ids(), a.gap_x(b).alias("gx"), a.gap_y(b).alias("gy"))


@query("box_pair_line_distance", _PAIR + f"SELECT a_id, b_id, round(abs((ox2 - ox1) * (y1 - oy1) - (x1 - ox1) * (oy2 - oy1)) / sqrt((ox2 - ox1) * (ox2 - ox1) + (oy2 - oy1) * (oy2 - oy1)), 6) AS dist FROM p WHERE {_MEET}")
def box_pair_line_distance(spark, d):
    return _pairs(spark, d, lambda x, y: x.overlaps(y)).select(*_ids(), F.round(Box.of("a").diagonal_distance(Box.of("b")), 6).alias("dist"))


@query("overlap_by_category", _B + "SELECT a.page_id, a.area_id, count(*) FILTER (WHERE o.category = 'String') AS string, count(*) FILTER (WHERE o.category = 'DrawnLine') AS drawnline FROM b a LEFT JOIN b o ON a.page_id = o.page_id AND a.area_id <> o.area_id AND a.x1 < o.x2 AND o.x1 < a.x2 AND a.y1 < o.y2 AND o.y1 < a.y2 WHERE a.category = 'TableCell' GROUP BY 1, 2")
def overlap_by_category(spark, d):
    b = boxes(spark, d)
    return spatial.overlaps_by_category(_cat(b, "TableCell"), b, ["String", "DrawnLine"])


@query("point_lookup", _B + "SELECT p.page_id, p.x, p.y, a.area_id FROM (SELECT page_id, (x1 + x2) * 0.5 AS x, (y1 + y2) * 0.5 AS y FROM b WHERE category = 'Line') p JOIN b a ON a.page_id = p.page_id AND a.x1 <= p.x AND a.x2 >= p.x AND a.y1 <= p.y AND a.y2 >= p.y")
def point_lookup(spark, d):
    b = boxes(spark, d)
    return spatial.at_positions(b, b.where("category = 'Line'").select("page_id", *[c.alias(n) for c, n in zip(Box.of().middle, "xy")]))


@query("neighbors_lrtb", _B + ", q AS (SELECT page_id, area_id AS own, unnest([{'side': 'left', 'x': x1 - 1, 'y': (y1 + y2) * 0.5}, {'side': 'right', 'x': x2 + 1, 'y': (y1 + y2) * 0.5}, {'side': 'above', 'x': (x1 + x2) * 0.5, 'y': y1 - 1}, {'side': 'below', 'x': (x1 + x2) * 0.5, 'y': y2 + 1}]) AS s FROM b) SELECT q.own AS area_id, s.side AS side, a.area_id AS other_id FROM q JOIN b a ON a.page_id = q.page_id AND a.x1 <= s.x AND a.x2 >= s.x AND a.y1 <= s.y AND a.y2 >= s.y WHERE s.x >= 0 AND s.y >= 0 AND q.own <> a.area_id")
def neighbors_lrtb(spark, d):
    return spatial.neighbours(boxes(spark, d))


_NEAR = ", n AS (SELECT a.page_id, a.area_id, a.y1, o.area_id AS other_id, greatest(o.y1 - a.y2, a.y1 - o.y2, 0) AS distance FROM b a JOIN b o ON a.page_id = o.page_id AND a.area_id <> o.area_id AND a.x1 <= o.x2 AND a.x2 >= o.x1 WHERE a.category = 'TableCell' AND o.category = 'Line'), f AS (SELECT *, row_number() OVER (PARTITION BY page_id, area_id ORDER BY distance, other_id) AS k FROM n) "


@query("nearest_caption", _B + _NEAR + "SELECT page_id, area_id, other_id, distance FROM f WHERE k = 1")
def nearest_caption(spark, d):
    b = boxes(spark, d)
    return spatial.nearest(_cat(b, "TableCell"), _cat(b, "Line"), lambda x, y: x.meets_x(y), lambda x, y: x.gap_y(y))


@query("caption_used_once", _B + _NEAR + "SELECT page_id, area_id, other_id, distance FROM (SELECT *, row_number() OVER (PARTITION BY page_id, other_id ORDER BY y1, area_id) AS j FROM f WHERE k = 1) WHERE j = 1")
def caption_used_once(spark, d):
    b = boxes(spark, d)
    return spatial.nearest_once(_cat(b, "TableCell"), _cat(b, "Line"), lambda x, y: x.meets_x(y), lambda x, y: x.gap_y(y))


@query("line_range_adjust", _B + "SELECT a.page_id, a.area_id, coalesce(min(o.x1) FILTER (WHERE o.x2 - o.x1 > o.y2 - o.y1), any_value(a.x1)) AS x1, coalesce(min(o.y1) FILTER (WHERE o.y2 - o.y1 > o.x2 - o.x1), any_value(a.y1)) AS y1, coalesce(max(o.x2) FILTER (WHERE o.x2 - o.x1 > o.y2 - o.y1), any_value(a.x2)) AS x2, coalesce(max(o.y2) FILTER (WHERE o.y2 - o.y1 > o.x2 - o.x1), any_value(a.y2)) AS y2 FROM b a LEFT JOIN b o ON a.page_id = o.page_id AND o.category = 'DrawnLine' AND a.x1 < o.x2 AND o.x1 < a.x2 AND a.y1 < o.y2 AND o.y1 < a.y2 WHERE a.category = 'TableCell' GROUP BY 1, 2")
def line_range_adjust(spark, d):
    b = boxes(spark, d)
    return spatial.fit_to_lines(_cat(b, "TableCell"), _cat(b, "DrawnLine"))


_SLOT = ", s AS (SELECT a_id, b_id, share FROM (SELECT a.area_id AS a_id, o.area_id AS b_id, greatest(least(a.x2, o.x2) - greatest(a.x1, o.x1), 0) * greatest(least(a.y2, o.y2) - greatest(a.y1, o.y1), 0) / ((a.x2 - a.x1) * (a.y2 - a.y1)) AS share, a.page_id FROM b a JOIN b o ON a.page_id = o.page_id AND a.area_id <> o.area_id AND a.x1 < o.x2 AND o.x1 < a.x2 AND a.y1 < o.y2 AND o.y1 < a.y2 WHERE a.category = 'String' AND o.category = 'TableCell')) "


@query("slot_best_container", _B + _SLOT + "SELECT a_id AS area_id, b_id AS container_id, share FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY share DESC, b_id) AS k FROM s) WHERE k = 1 AND share >= 0.5")
def slot_best_container(spark, d):
    b = boxes(spark, d)
    return spatial.slots(_cat(b, "String"), _cat(b, "TableCell")).drop("page_id")


@query("slot_multi", _B + _SLOT + "SELECT a_id AS area_id, b_id AS container_id, share FROM s WHERE share >= 0.25")
def slot_multi(spark, d):
    b = boxes(spark, d)
    return spatial.slots(_cat(b, "String"), _cat(b, "TableCell"), 0.25, unique=False).drop("page_id")


@query("row_col_cells", _B + ", c AS (SELECT r.page_id, r.area_id AS row_id, k.area_id AS column_id, greatest(r.x1, k.x1) AS x1, greatest(r.y1, k.y1) AS y1, least(r.x2, k.x2) AS x2, least(r.y2, k.y2) AS y2 FROM b r JOIN b k ON r.page_id = k.page_id AND r.area_id <> k.area_id AND r.x1 < k.x2 AND k.x1 < r.x2 AND r.y1 < k.y2 AND k.y1 < r.y2 WHERE r.category = 'Line' AND k.category = 'TableCell') SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM b s WHERE s.category = 'String' AND s.page_id = c.page_id AND s.area_id <> c.row_id AND s.area_id <> c.column_id AND greatest(least(c.x2, s.x2) - greatest(c.x1, s.x1), 0) * greatest(least(c.y2, s.y2) - greatest(c.y1, s.y1), 0) > 0.5 * (c.x2 - c.x1) * (c.y2 - c.y1))")
def row_col_cells(spark, d):
    b = boxes(spark, d)
    return spatial.row_column_cells(_cat(b, "Line"), _cat(b, "TableCell"), _cat(b, "String"))


@query("merge_uncrossed", _PAIR.replace("FROM b a JOIN b c", "FROM (SELECT * FROM b WHERE category = 'String') a JOIN (SELECT * FROM b WHERE category = 'String') c").replace("SELECT a.area_id AS a_id", "SELECT a.page_id, a.area_id AS a_id") + ", h AS (SELECT page_id, a_id, b_id, least(x1, ox1) AS x1, least(y1, oy1) AS y1, greatest(x2, ox2) AS x2, greatest(y2, oy2) AS y2 FROM p WHERE y1 <= oy2 AND y2 >= oy1 AND greatest(ox1 - x2, x1 - ox2, 0) <= 35) SELECT h.* FROM h WHERE NOT EXISTS (SELECT 1 FROM b l WHERE l.category = 'DrawnLine' AND l.page_id = h.page_id AND l.x1 < h.x2 AND h.x1 < l.x2 AND l.y1 < h.y2 AND h.y1 < l.y2 AND NOT (l.x1 <= h.x1 AND l.x2 >= h.x2 AND l.y1 <= h.y1 AND l.y2 >= h.y2))")
def merge_uncrossed(spark, d):
    b = boxes(spark, d)
    s = _cat(b, "String")
    met = spatial.box_join(s, s, lambda x, y: (F.col("a.area_id") < F.col("b.area_id")) & x.meets_y(y) & (x.gap_x(y) <= 35), distinct=None)
    return spatial.uncrossed(met.select(F.col("a.page_id").alias("page_id"), *_ids(), *Box.of("a").union(Box.of("b")).columns()), _cat(b, "DrawnLine"))


@query("group_hull", _B + "SELECT page_id, category, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, count(*) AS n, avg(y2 - y1) AS mean_h, median(y2 - y1) AS median_h FROM b GROUP BY 1, 2")
def group_hull(spark, d):
    h = F.col("y2") - F.col("y1")
    return boxes(spark, d).groupBy("page_id", "category").agg(*hull(), F.count("*").alias("n"), F.avg(h).alias("mean_h"), F.median(h).alias("median_h"))


_ISL = _B + ", n AS (SELECT *, CASE WHEN max(y2) OVER w IS NULL OR y1 > max(y2) OVER w - 3 THEN 1 ELSE 0 END AS new FROM b WINDOW w AS (PARTITION BY page_id ORDER BY y1, area_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), i AS (SELECT *, CAST(sum(new) OVER (PARTITION BY page_id ORDER BY y1, area_id) AS BIGINT) AS row_no FROM n) "


@query("row_islands", _ISL + "SELECT page_id, area_id, row_no FROM i")
def row_islands(spark, d):
    return cluster.row_islands(boxes(spark, d)).select("page_id", "area_id", F.col("row_no").cast("long").alias("row_no"))


@query("top3_row_width", _ISL + ", c AS (SELECT page_id, row_no, count(*) AS n FROM i GROUP BY 1, 2), f AS (SELECT page_id, n, count(*) AS k FROM c GROUP BY 1, 2), t AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY k DESC, n DESC) AS j FROM f) SELECT page_id, max(n) AS width FROM t WHERE j <= 3 GROUP BY 1")
def top3_row_width(spark, d):
    from ..operators.tables import modal_width

    rows = cluster.row_islands(boxes(spark, d)).groupBy("page_id", "row_no").agg(F.count("*").alias("n"))
    return modal_width(rows, "page_id")


@query("column_gaps", _B + ", v AS (SELECT DISTINCT page_id, x1 AS v FROM b), l AS (SELECT page_id, v, lead(v) OVER (PARTITION BY page_id ORDER BY v) AS n FROM v) SELECT page_id, (v + n) / 2 AS gap FROM l WHERE n - v > 3")
def column_gaps(spark, d):
    from ..operators.tables import gaps

    return gaps(boxes(spark, d).select("page_id", F.col("x1").alias("v")), 3.0)


@query("split_ntile", _B + ", t AS (SELECT page_id, (y1 + y2) * 0.5 AS m, ntile(3) OVER (PARTITION BY page_id ORDER BY (y1 + y2) * 0.5, area_id) AS part FROM b) SELECT page_id, CAST(part AS BIGINT) AS part, CAST(trunc(min(m)) AS BIGINT) AS lo, CAST(trunc(max(m)) AS BIGINT) AS hi, count(*) AS n FROM t GROUP BY 1, 2")
def split_ntile(spark, d):
    from ..operators.tables import split_parts

    return split_parts(boxes(spark, d), 3)


@query("table_index_on_page", _B + "SELECT page_id, area_id, row_number() OVER (PARTITION BY page_id ORDER BY y1, area_id) - 1 AS number FROM b WHERE category = 'TableCell'")
def table_index_on_page(spark, d):
    from pyspark.sql import Window

    return _cat(boxes(spark, d), "TableCell").select("page_id", "area_id", (F.row_number().over(Window.partitionBy("page_id").orderBy("y1", "area_id")) - 1).cast("long").alias("number"))


@query("regression_line", _B + "SELECT page_id, round(regr_slope(y1, x1), 6) AS slope, round(regr_intercept(y1, x1), 4) AS intercept FROM b WHERE category = 'DrawnLine' GROUP BY 1")
def regression_line(spark, d):
    return _cat(boxes(spark, d), "DrawnLine").groupBy("page_id").agg(F.round(F.regr_slope("y1", "x1"), 6).alias("slope"), F.round(F.regr_intercept("y1", "x1"), 4).alias("intercept"))


@query("coco_annotations", _B + "SELECT page_id AS image_id, area_id AS id, category, CAST(trunc(x1) AS BIGINT) AS x, CAST(trunc(y1) AS BIGINT) AS y, CAST(trunc(x2 - x1) AS BIGINT) AS w, CAST(trunc(y2 - y1) AS BIGINT) AS h, (x2 - x1) * (y2 - y1) AS area, coalesce(confidence, 0) AS score FROM b")
def coco_annotations(spark, d):
    from ..sources.writers import coco_annotations as rows

    return rows(boxes(spark, d))


@query("reading_order")
def reading_order(spark, d):
    return cluster.reading_order(boxes(spark, d))


@query("merge_boxes_fixpoint")
def merge_boxes_fixpoint(spark, d):
    return cluster.merge_boxes(_cat(boxes(spark, d), "String"), 16, -2, 40).drop("score")


@query("nms_merge")
def nms_merge(spark, d):
    return cluster.nms(boxes(spark, d), 0.1, "merge")


@query("nms_delete")
def nms_delete(spark, d):
    return cluster.nms(boxes(spark, d), 0.1, "delete")


@query("nms_score")
def nms_score(spark, d):
    return cluster.nms(boxes(spark, d), 0.5, "score", "iou")


@query("cells_first_fit")
def cells_first_fit(spark, d):
    b = boxes(spark, d)
    return cluster.first_fit_cells(_cat(b, "String"), _cat(b, "DrawnLine"))


_REFS = "WITH areas AS (SELECT o_orderkey AS area_id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS content FROM orders UNION ALL SELECT DISTINCT 1000000000 + l_orderkey * 10 + l_linenumber, l_returnflag FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2)), refs AS (SELECT DISTINCT l_orderkey AS parent_id, 1000000000 + l_orderkey * 10 + l_linenumber AS child_id, l_linenumber AS pos FROM lineitem) "


def _tree(spark, d):
    line = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("content"))
    child = line.select((F.col("l_orderkey") * 10 + F.col("l_linenumber") + 1000000000).alias("child_id"), F.col("l_orderkey").alias("parent_id"), F.col("l_linenumber").alias("pos"), "content")
    top = table(spark, d, "orders").select(F.col("o_orderkey").alias("area_id"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("content"))
    return top.unionByName(child.select(F.col("child_id").alias("area_id"), "content")), child.select("parent_id", "child_id", "pos")


@query("semi_referenced", _REFS + "SELECT area_id, content FROM areas WHERE area_id IN (SELECT child_id FROM refs)")
def semi_referenced(spark, d):
    return references.referenced(*_tree(spark, d)).select("area_id", "content")


@query("anti_deleted", _REFS + "SELECT parent_id, child_id, pos FROM refs WHERE parent_id % 7 <> 0 AND child_id % 7 <> 0")
def anti_deleted(spark, d):
    areas, refs = _tree(spark, d)
    gone = areas.select("area_id").unionByName(refs.select(F.col("parent_id").alias("area_id"))).where("area_id % 7 = 0").distinct()
    return references.delete(areas, refs, gone)[1]


@query("refs_cleanup", _REFS + "SELECT parent_id, child_id, pos FROM refs WHERE child_id IN (SELECT area_id FROM areas WHERE area_id % 5 <> 0)")
def refs_cleanup(spark, d):
    areas, refs = _tree(spark, d)
    return references.cleanup(refs, areas.where("area_id % 5 <> 0")).select("parent_id", "child_id", "pos")


@query("data_value_or_children", _REFS + "SELECT a.area_id, CASE WHEN any_value(a.content) IS NOT NULL THEN any_value(a.content) ELSE coalesce(string_agg(c.content, ',' ORDER BY pos, c.content), '') END AS vals FROM areas a LEFT JOIN refs r ON r.parent_id = a.area_id LEFT JOIN areas c ON c.area_id = r.child_id GROUP BY a.area_id")
def data_value_or_children(spark, d):
    return references.value_or_children(*_tree(spark, d), "content").select("area_id", F.array_join("vals", ",").alias("vals"))
