"""Rows of cells between drawn lines, and spans widened over empty cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chains
from .fixtures import BOXES_SQL, boxes, deal, table
from .registry import query

_ROWS = f"""WITH RECURSIVE b AS ({BOXES_SQL}), c AS (SELECT * FROM b WHERE category = 'TableCell'), l AS (SELECT page_id, x1 - 100 AS x1, y1, x2 + 100 AS x2, y1 AS y2 FROM b WHERE category = 'DrawnLine'),
q AS (SELECT a.page_id, a.area_id AS u, o.area_id AS v, least(a.x1, o.x1) AS x1, least(a.y1, o.y1) AS y1, greatest(a.x2, o.x2) AS x2, greatest(a.y2, o.y2) AS y2 FROM c a JOIN c o ON a.page_id = o.page_id AND a.area_id < o.area_id AND a.y1 <= o.y2 - 2 AND a.y2 >= o.y1 + 2),
p AS (SELECT page_id, u, v FROM q WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.page_id = q.page_id AND ((q.x1 < l.x1 AND q.x2 > l.x1 AND q.y1 > l.y1 AND q.y2 < l.y2) OR (q.y1 < l.y1 AND q.y2 > l.y1 AND q.x1 > l.x1 AND q.x2 < l.x2)))),
e AS (SELECT page_id, u, v FROM p UNION ALL SELECT page_id, v, u FROM p),
reach AS (SELECT page_id, area_id AS u, area_id AS v FROM c UNION SELECT r.page_id, r.u, e.v FROM reach r JOIN e ON e.page_id = r.page_id AND e.u = r.v),
g AS (SELECT page_id, u AS area_id, min(v) AS least FROM reach GROUP BY ALL),
t AS (SELECT g.page_id, g.area_id, least, x1, min(y1) OVER (PARTITION BY g.page_id, least) AS top FROM g JOIN c ON c.page_id = g.page_id AND c.area_id = g.area_id),
rows AS (SELECT page_id, area_id, dense_rank() OVER (PARTITION BY page_id ORDER BY top, least) - 1 AS row_no, row_number() OVER (PARTITION BY page_id, least ORDER BY x1, area_id) - 1 AS place, count(*) OVER (PARTITION BY page_id, least) AS n FROM t)
"""


def _barriers(b: DataFrame) -> DataFrame:
    """Drawn lines as flat barriers, drawn out to both sides."""
    return b.where("category = 'DrawnLine'").select("page_id", (F.col("x1") - 100).alias("x1"), "y1", (F.col("x2") + 100).alias("x2"), F.col("y1").alias("y2"))


@query("row_chains", _ROWS + "SELECT page_id, area_id, row_no, place, n FROM rows")
def row_chains(spark, d):
    b = boxes(spark, d)
    return chains.row_chains(b.where("category = 'TableCell'"), _barriers(b), 2.0)


_CELLS = "SELECT l_orderkey AS table_id, r, c, l_orderkey * 100 + r * 10 + c AS cell_id, CAST(60 * c + l_orderkey % 7 AS DOUBLE) AS x1, CAST(60 * c + 40 AS DOUBLE) AS x2 FROM (SELECT DISTINCT l_orderkey FROM {lineitem}), (SELECT unnest(range(0, 4)) AS r), (SELECT unnest(range(0, 8)) AS c) WHERE (l_orderkey * 31 + r * 17 + c * (7 + r)) % 5 NOT IN (0, 3) OR r = 2 AND l_orderkey % 2 = 0"


def _widened_sql() -> str:
    """The plain rule, place by place from left to right, as a recursion over pairs of rows and columns."""
    return f"""WITH RECURSIVE k AS ({_CELLS.format(lineitem="lineitem")}),
v AS (SELECT l_orderkey AS table_id, CAST(60 * l_linenumber + 50 AS DOUBLE) AS x1 FROM lineitem WHERE l_linenumber % 3 = 0),
full_rows AS (SELECT t.table_id, r.r, list(k.cell_id ORDER BY c.c) AS ids, list(k.x1 ORDER BY c.c) AS x1, list(k.x2 ORDER BY c.c) AS x2 FROM (SELECT DISTINCT table_id FROM k) t CROSS JOIN (SELECT unnest(range(0, 3)) AS r) r CROSS JOIN (SELECT unnest(range(0, 8)) AS c) c LEFT JOIN k ON k.table_id = t.table_id AND k.r = r.r AND k.c = c.c GROUP BY ALL),
s AS (SELECT a.table_id, a.ids AS a0, b.ids AS a1, c.ids AS a2, [a.x1, b.x1, c.x1] AS x1, [a.x2, b.x2, c.x2] AS x2, coalesce((SELECT list(v.x1) FROM v WHERE v.table_id = a.table_id), []) AS stabs FROM full_rows a, full_rows b, full_rows c WHERE a.table_id = b.table_id AND b.table_id = c.table_id AND a.r = 0 AND b.r = 1 AND c.r = 2),
w AS (
  SELECT table_id, a0, a1, a2, x1, x2, stabs, 0 AS step FROM s
  UNION ALL
  SELECT table_id, CASE WHEN p < 2 THEN new ELSE a0 END, CASE WHEN p = 2 THEN new ELSE a1 END, a2, x1, x2, stabs, step + 1 FROM (
    SELECT *, CASE WHEN u[c] IS NOT NULL AND u[c - 1] IS NULL AND u[c + 1] IS NULL AND l[c - 1] IS NOT NULL AND l[c] IS NOT NULL AND l[c + 1] IS NOT NULL AND len(list_filter(stabs, lambda e: e >= floor(x1[low + 1][c - 1]) AND e < floor(x2[low + 1][c + 1]))) = 0 THEN list_concat(u[1 : c - 2], [u[c], u[c], u[c]], u[c + 2 :]) ELSE u END AS new
    FROM (SELECT *, step // 6 AS p, step % 6 + 2 AS c, CASE WHEN step // 6 = 2 THEN a1 ELSE a0 END AS u, CASE WHEN step // 6 = 0 THEN a1 ELSE a2 END AS l, CASE WHEN step // 6 = 0 THEN 1 ELSE 2 END AS low FROM w WHERE step < 18)
  )
),
z AS (SELECT table_id, list_transform(range(1, 9), lambda i: coalesce(a0[i], a1[i])) AS a0, list_transform(range(1, 9), lambda i: coalesce(a1[i], a0[i])) AS a1, a2 FROM w WHERE step = 18),
o AS (SELECT table_id, r, c, CASE r WHEN 0 THEN a0[c + 1] WHEN 1 THEN a1[c + 1] ELSE a2[c + 1] END AS cell_id FROM z, (SELECT unnest(range(0, 3)) AS r), (SELECT unnest(range(0, 8)) AS c))
SELECT table_id, CAST(r AS INTEGER) AS r, c, cell_id FROM o WHERE cell_id IS NOT NULL UNION ALL SELECT table_id, CAST(r AS INTEGER), c, cell_id FROM k WHERE r = 3"""


@query("widened_spans", _widened_sql())
def widened_spans(spark, d):
    """Cells of every order's table widened between upright lines."""
    lines = deal(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("table_id"), "l_linenumber"), "table_id")
    i = F.col("table_id")
    grid = lines.select("table_id").distinct().withColumn("r", F.explode(F.array(*map(F.lit, range(4))))).withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))))
    kept = ~((i * 31 + F.col("r") * 17 + F.col("c") * (7 + F.col("r"))) % 5).isin(0, 3) | ((F.col("r") == 2) & (i % 2 == 0))
    cells = grid.where(kept).select("table_id", "r", "c", (i * 100 + F.col("r") * 10 + F.col("c")).alias("cell_id"), (60 * F.col("c") + i % 7).cast("double").alias("x1"), (60 * F.col("c") + 40).cast("double").alias("x2"))
    upright = lines.where("l_linenumber % 3 = 0").select("table_id", (60 * F.col("l_linenumber") + 50).cast("double").alias("x1"))
    return chains.widened(cells, upright)
