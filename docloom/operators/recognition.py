"""From detected rows, columns and spanning cells of a table to a grid of cells.

All tables carry page_id as the table's key; objects have area_id, a box and a score. Only the shrinking
of overlapping spanning cells depends on their order and runs per table in a grouped function.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import Box


def _best(containers: DataFrame, packages: DataFrame) -> DataFrame:
    """(page_id, package, container, share): the container with the largest share of each package, first by score, then id."""
    a, b = Box.of("p"), Box.of("c")
    met = packages.alias("p").join(containers.alias("c"), (F.col("p.page_id") == F.col("c.page_id")) & a.overlaps(b))
    share = met.select(F.col("p.page_id").alias("page_id"), F.col("p.area_id").alias("package"), F.col("c.area_id").alias("container"), F.coalesce("c.score", F.lit(0.0)).alias("score"), a.covered_share(b).alias("share"))
    best = share.groupBy("page_id", "package").agg(F.max(F.struct("share", "score", (-F.col("container")).alias("k"))).alias("m"))
    return best.select("page_id", "package", (-F.col("m.k")).alias("container"), F.col("m.share").alias("share"))


def holding(objects: DataFrame, tokens: DataFrame, share: float = 0.5) -> DataFrame:
    """Rows or columns that keep tokens of their own: each token goes to the object with most of it, if that is the share.

    The object with the best score stays in any case. (Tokens have one object each, so no two objects ever share
    one, and emptiness is all that suppression by containment can find.)
    """
    full = _best(objects, tokens).where(F.col("share") >= share).select("page_id", F.col("container").alias("area_id")).distinct()
    top = objects.groupBy("page_id").agg(F.max(F.struct("score", (-F.col("area_id")).alias("k"))).alias("m")).select("page_id", (-F.col("m.k")).alias("area_id"))
    return objects.join(full.unionByName(top).distinct(), ["page_id", "area_id"], "left_semi")


def with_content(objects: DataFrame, tokens: DataFrame, share: float = 0.5) -> DataFrame:
    """Objects that hold at least the share of some token with a text."""
    a, b = Box.of("o"), Box.of("t")
    on = (F.col("o.page_id") == F.col("t.page_id")) & a.overlaps(b) & (b.covered_share(a) >= share) & (F.trim("t.content") != "")
    return objects.alias("o").join(tokens.alias("t"), on, "left_semi")


def ordered(objects: DataFrame, axis: str = "y", number: str = "r") -> DataFrame:
    """Objects numbered from the top (axis y) or the left (axis x) by their middles."""
    w = Window.partitionBy("page_id").orderBy(F.col(f"{axis}1") + F.col(f"{axis}2"), "area_id")
    return objects.withColumn(number, F.row_number().over(w) - 1)


def stretched(objects: DataFrame, tables: DataFrame, axis: str = "x") -> DataFrame:
    """Rows stretched to the table's left and right (axis x), columns to its top and bottom (axis y)."""
    t = tables.select("page_id", F.col(f"{axis}1").alias("lo"), F.col(f"{axis}2").alias("hi"))
    return objects.join(t, "page_id").withColumns({f"{axis}1": F.col("lo"), f"{axis}2": F.col("hi")}).drop("lo", "hi")


def _overlap(a: str, b: str, axis: str) -> Column:
    return F.least(F.col(f"{a}.{axis}2"), F.col(f"{b}.{axis}2")) - F.greatest(F.col(f"{a}.{axis}1"), F.col(f"{b}.{axis}1"))


def aligned_spans(spans: DataFrame, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """Spanning cells with the rows and columns they cover by half: (page_id, area_id, score, header, rs, cs).

    ``rows`` has r and header, ``columns`` c. A cell does not reach over the edge of the header: the smaller
    side goes (the data rows where both are equal). Cells of fewer than two rows and columns are none.
    """
    s, r, c = spans.alias("s"), rows.alias("r"), columns.alias("c")
    over_rows = s.join(r, (F.col("s.page_id") == F.col("r.page_id")) & (_overlap("r", "s", "y") >= 0.5 * (F.col("r.y2") - F.col("r.y1"))))
    key = [F.col("s.page_id").alias("page_id"), F.col("s.area_id").alias("area_id")]
    part = over_rows.groupBy(*key).agg(F.first("s.score").alias("score"), F.sort_array(F.collect_set(F.when(F.col("r.header"), F.col("r.r")))).alias("hs"), F.sort_array(F.collect_set(F.when(~F.col("r.header"), F.col("r.r")))).alias("ds"))
    header = (F.size("hs") > 0) & (F.size("ds") <= F.size("hs"))
    part = part.select("page_id", "area_id", "score", header.alias("header"), F.when(header, F.col("hs")).otherwise(F.col("ds")).alias("rs"))
    over_columns = s.join(c, (F.col("s.page_id") == F.col("c.page_id")) & (_overlap("c", "s", "x") >= 0.5 * (F.col("c.x2") - F.col("c.x1"))))
    cols = over_columns.groupBy(*key).agg(F.sort_array(F.collect_set("c.c")).alias("cs"))
    out = part.join(cols, ["page_id", "area_id"])
    return out.where((F.size("rs") > 0) & (F.size("cs") > 0) & (F.size("rs") + F.size("cs") > 2))


def disjoint_spans(spans: DataFrame) -> DataFrame:
    """Spanning cells without common grid places: by falling score, each loses as few rows or columns as it can to those before it.

    Where it meets an earlier one it loses its last or first common line along its longer side, or is emptied
    if the common lines lie inside; with fewer than two rows and two columns left it goes.
    """
    schema = spans.schema

    def run(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["score", "area_id"], ascending=[False, True])
        grids = [[sorted(r), sorted(c)] for r, c in zip(table["rs"], table["cs"])]
        for k, mine in enumerate(grids):
            for other in grids[:k]:
                while (common := [set(a) & set(b) for a, b in zip(mine, other)])[0] and common[1]:
                    axis = 1 if len(mine[0]) < len(mine[1]) else 0
                    if mine[axis][-1] in common[axis]:
                        mine[axis].pop()
                    elif mine[axis][0] in common[axis]:
                        mine[axis].pop(0)
                    else:
                        mine[axis] = []
        keep = [k == 0 or (len(r) > 0 and len(c) > 0 and len(r) + len(c) > 2) for k, (r, c) in enumerate(grids)]
        return table.assign(rs=[g[0] for g in grids], cs=[g[1] for g in grids])[keep]

    return spans.groupBy("page_id").applyInPandas(run, schema)


def header_tree(spans: DataFrame) -> DataFrame:
    """Spanning cells without those of the header that have not exactly one header cell above them in every row above."""
    heads = spans.where("header")
    a = heads.select("page_id", "area_id", "cs", F.array_min("rs").alias("top"))
    b = heads.select("page_id", F.col("rs").alias("rs2"), F.col("cs").alias("cs2"), F.array_max("rs").alias("low"))
    met = a.join(b, "page_id").where((F.col("low") < F.col("top")) & (F.size(F.array_except("cs", "cs2")) == 0))
    above = met.select("page_id", "area_id", "top", F.explode("rs2").alias("row")).groupBy("page_id", "area_id", "top", "row").agg(F.count("*").alias("n")).where("n = 1")
    fine = above.groupBy("page_id", "area_id", "top").agg(F.count("*").alias("rows")).where("rows = top").select("page_id", "area_id")
    bad = a.where("top > 0").join(fine, ["page_id", "area_id"], "left_anti").select("page_id", "area_id")
    return spans.join(bad, ["page_id", "area_id"], "left_anti")


def grid_cells(rows: DataFrame, columns: DataFrame, spans: DataFrame) -> DataFrame:
    """Cells of a table: (page_id, cell_id, rs, cs, header, box). Grid places that a spanning cell takes are one cell with it.

    A spanning cell is a header if all its places are. Cells are numbered by their first row and column.
    """
    taken = spans.select("page_id", "area_id", "cs", F.explode("rs").alias("r")).select("page_id", "area_id", "r", F.explode("cs").alias("c"))
    taken = taken.groupBy("page_id", "r", "c").agg(F.min("area_id").alias("span"))
    r = rows.select("page_id", "r", "header", F.col("y1"), F.col("y2"))
    c = columns.select("page_id", "c", F.col("x1"), F.col("x2"))
    place = r.join(c, "page_id").join(taken, ["page_id", "r", "c"], "left")
    key = F.when(F.col("span").isNotNull(), F.struct(F.lit(1).alias("k"), F.col("span").cast("long").alias("a"), F.lit(0).cast("long").alias("b"))).otherwise(F.struct(F.lit(0).alias("k"), F.col("r").cast("long").alias("a"), F.col("c").cast("long").alias("b")))
    cells = place.groupBy("page_id", key.alias("key")).agg(
        F.sort_array(F.collect_set("r")).alias("rs"), F.sort_array(F.collect_set("c")).alias("cs"), F.bool_and("header").alias("header"),
        F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"),
    )
    w = Window.partitionBy("page_id").orderBy(F.array_min("rs"), F.array_min("cs"), "key")
    return cells.withColumn("cell_id", (F.row_number().over(w) - 1).cast("long")).drop("key")


def slotted(cells: DataFrame, tokens: DataFrame, share: float = 0.001) -> DataFrame:
    """(page_id, cell_id, token, share): every token's best cell."""
    packed = cells.select("page_id", F.col("cell_id").alias("area_id"), "x1", "y1", "x2", "y2", F.lit(0.0).alias("score"))
    return _best(packed, tokens).where(F.col("share") >= share).select("page_id", F.col("container").alias("cell_id"), F.col("package").alias("token"), "share")


def table_confidence(cells: DataFrame, tokens: DataFrame) -> DataFrame:
    """Mean of the average and the least best share of a table's tokens; tokens that meet no cell count as 0."""
    best = slotted(cells, tokens, 0.0)
    every = tokens.select("page_id", F.col("area_id").alias("token")).join(best, ["page_id", "token"], "left").fillna({"share": 0.0})
    return every.groupBy("page_id").agg(((F.avg("share") + F.min("share")) / 2).alias("confidence"))


def refit(cells: DataFrame, slots: DataFrame, tokens: DataFrame, axis: str = "y") -> DataFrame:
    """Rows (axis y) or columns (axis x) from their tokens: (page_id, line, lo, hi).

    A line begins with the first token of cells that begin in it and ends with the last token of cells that
    end in it; null where there is none.
    """
    lines = "rs" if axis == "y" else "cs"
    met = slots.join(cells.select("page_id", "cell_id", F.array_min(lines).alias("a"), F.array_max(lines).alias("b")), ["page_id", "cell_id"])
    met = met.join(tokens.select("page_id", F.col("area_id").alias("token"), F.col(f"{axis}1").alias("lo"), F.col(f"{axis}2").alias("hi")), ["page_id", "token"])
    ends = met.select("page_id", F.explode(F.array(F.struct(F.col("a").alias("line"), F.col("lo").alias("lo"), F.lit(None).cast("double").alias("hi")), F.struct(F.col("b").alias("line"), F.lit(None).cast("double").alias("lo"), F.col("hi").alias("hi")))).alias("e"))
    return ends.groupBy("page_id", "e.line").agg(F.min("e.lo").alias("lo"), F.max("e.hi").alias("hi"))


def cell_texts(cells: DataFrame, slots: DataFrame, tokens: DataFrame) -> DataFrame:
    """Cells with the texts of their tokens in reading order (top, then left)."""
    texts = slots.join(tokens.select("page_id", F.col("area_id").alias("token"), "x1", "y1", "content"), ["page_id", "token"])
    joined = texts.groupBy("page_id", "cell_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("y1", "x1", "token", "content"))), lambda x: x["content"]), " ").alias("content"))
    return cells.join(joined, ["page_id", "cell_id"], "left")


def crops(tables: DataFrame, tokens: DataFrame, pad: float = 10.0, share: float = 0.5) -> DataFrame:
    """Tokens that lie in a padded table by the share, in its coordinates; ``rotated`` tables are turned clockwise."""
    t, k = Box.of("t"), Box.of("k")
    frame = Box(F.greatest(F.col("t.x1") - pad, F.lit(0.0)), F.greatest(F.col("t.y1") - pad, F.lit(0.0)), F.col("t.x2") + pad, F.col("t.y2") + pad)
    met = tables.alias("t").join(tokens.alias("k"), (F.col("t.page_id") == F.col("k.page_id")) & k.overlaps(frame) & (k.covered_share(frame) >= share))
    own = [k.x1 - frame.x1, k.y1 - frame.y1, k.x2 - frame.x1, k.y2 - frame.y1]
    turned = [frame.height - own[3], own[0], frame.height - own[1], own[2]]
    cols = [F.when(F.col("t.rotated"), b).otherwise(a).alias(n) for a, b, n in zip(own, turned, ("x1", "y1", "x2", "y2"))]
    return met.select(F.col("t.page_id").alias("page_id"), F.col("t.area_id").alias("table_id"), F.col("k.area_id").alias("area_id"), *cols)
