"""Spatial joins. Every one keeps the page key as an equi condition, with the box test as residual:
Spark shuffles once on the key and never forms a Cartesian product."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Box

Test = Callable[[Box, Box], Column]


def box_join(left: DataFrame, right: DataFrame, test: Test, keys: tuple[str, ...] = ("page_id",), how: str = "inner", distinct: str | None = "area_id") -> DataFrame:
    """Rows a of ``left`` and b of ``right`` on the same page whose boxes pass ``test``; aliases a and b; equal ids excluded."""
    a, b = left.alias("a"), right.alias("b")
    on = test(Box.of("a"), Box.of("b"))
    for k in keys:
        on = (F.col(f"a.{k}") == F.col(f"b.{k}")) & on
    if distinct:
        on = on & (F.col(f"a.{distinct}") != F.col(f"b.{distinct}"))
    return a.join(b, on, how)


def overlapping(areas: DataFrame, others: DataFrame) -> DataFrame:
    return box_join(areas, others, lambda a, b: a.overlaps(b))


def overlaps_by_category(areas: DataFrame, others: DataFrame, categories: list[str]) -> DataFrame:
    """Number of overlapping areas of each category, all categories present."""
    met = overlapping(areas, others).groupBy("a.page_id", "a.area_id").agg(*[F.count_if(F.col("b.category") == c).alias(c.lower()) for c in categories])
    every = areas.select("page_id", "area_id").join(met, ["page_id", "area_id"], "left")
    return every.select("page_id", "area_id", *[F.coalesce(c.lower(), F.lit(0)).alias(c.lower()) for c in categories])


def at_positions(areas: DataFrame, points: DataFrame) -> DataFrame:
    """Areas that hold each point (page_id, x, y), edges included."""
    on = (F.col("a.page_id") == F.col("p.page_id")) & Box.of("a").holds(F.col("p.x"), F.col("p.y"))
    return points.alias("p").join(areas.alias("a"), on).select("p.*", "a.area_id")


def neighbours(areas: DataFrame, reach: float = 1.0) -> DataFrame:
    """Areas found one step outside the middle of each edge: area_id, side, other_id."""
    b, (mx, my) = Box.of(), Box.of().middle
    probe = lambda side, x, y: F.struct(F.lit(side).alias("side"), x.alias("x"), y.alias("y"))
    probes = F.array(probe("left", b.x1 - reach, my), probe("right", b.x2 + reach, my), probe("above", mx, b.y1 - reach), probe("below", mx, b.y2 + reach))
    points = areas.select("page_id", F.col("area_id").alias("own"), F.explode(probes).alias("probe")).select("page_id", "own", "probe.side", "probe.x", "probe.y").where("x >= 0 AND y >= 0")
    return at_positions(areas, points).where("own <> area_id").select(F.col("own").alias("area_id"), "side", F.col("area_id").alias("other_id"))


def nearest(left: DataFrame, right: DataFrame, test: Test, distance: Test, limit: float | None = None) -> DataFrame:
    """For each left area the nearest right area that passes ``test``; ties go to the least id."""
    met = box_join(left, right, test).select(F.col("a.page_id").alias("page_id"), F.col("a.area_id").alias("area_id"), F.col("b.area_id").alias("other_id"), distance(Box.of("a"), Box.of("b")).alias("distance"))
    if limit is not None:
        met = met.where(F.col("distance") <= limit)
    best = met.groupBy("page_id", "area_id").agg(F.min(F.struct("distance", "other_id")).alias("m"))
    return best.select("page_id", "area_id", F.col("m.other_id").alias("other_id"), F.col("m.distance").alias("distance"))


def nearest_once(left: DataFrame, right: DataFrame, test: Test, distance: Test) -> DataFrame:
    """As ``nearest``, and an other area serves only the topmost left area that wants it."""
    best = nearest(left, right, test, distance).join(left.select("page_id", "area_id", "y1"), ["page_id", "area_id"])
    own = best.groupBy("page_id", "other_id").agg(F.min(F.struct("y1", "area_id", "distance")).alias("m"))
    return own.select("page_id", F.col("m.area_id").alias("area_id"), "other_id", F.col("m.distance").alias("distance"))


def fit_to_lines(tables: DataFrame, lines: DataFrame) -> DataFrame:
    """Tables drawn to their overlapping lines: x from horizontal, y from vertical ones, unchanged where none."""
    h, v, b = Box.of("b").is_horizontal, Box.of("b").is_vertical, Box.of("b")
    met = overlapping(tables, lines).groupBy("a.page_id", "a.area_id").agg(F.min(F.when(h, b.x1)).alias("hx1"), F.max(F.when(h, b.x2)).alias("hx2"), F.min(F.when(v, b.y1)).alias("vy1"), F.max(F.when(v, b.y2)).alias("vy2"))
    out = tables.join(met, ["page_id", "area_id"], "left")
    return out.select("page_id", "area_id", F.coalesce("hx1", "x1").alias("x1"), F.coalesce("vy1", "y1").alias("y1"), F.coalesce("hx2", "x2").alias("x2"), F.coalesce("vy2", "y2").alias("y2"))


def slots(packages: DataFrame, containers: DataFrame, threshold: float = 0.5, unique: bool = True, forced: bool = False) -> DataFrame:
    """Containers of each package by covered share: the best one, or all at or above the threshold.

    With ``forced`` the best one counts whatever its share, as long as they overlap at all.
    """
    met = overlapping(packages, containers).select(F.col("a.page_id").alias("page_id"), F.col("a.area_id").alias("area_id"), F.col("b.area_id").alias("container_id"), Box.of("a").covered_share(Box.of("b")).alias("share"))
    if not unique and not forced:
        return met.where(F.col("share") >= threshold)
    best = met.groupBy("page_id", "area_id").agg(F.min(F.struct((-F.col("share")).alias("s"), "container_id")).alias("m"))
    best = best.select("page_id", "area_id", F.col("m.container_id").alias("container_id"), (-F.col("m.s")).alias("share"))
    if not unique:
        return best.unionByName(met.where(F.col("share") >= threshold)).distinct()
    return best if forced else best.where(F.col("share") >= threshold)


def row_column_cells(rows: DataFrame, columns: DataFrame, spans: DataFrame, share: float = 0.5) -> DataFrame:
    """Common boxes of a page's rows and columns, without those a spanning area covers by more than ``share``."""
    a, b = Box.of("a"), Box.of("b")
    met = box_join(rows, columns, lambda a, b: a.overlaps(b))
    cut = met.select(F.col("a.page_id").alias("page_id"), F.col("a.area_id").alias("row_id"), F.col("b.area_id").alias("column_id"), *a.intersection(b).columns())
    on = (F.col("a.page_id") == F.col("b.page_id")) & (a.covered_share(b) > share) & (F.col("a.row_id") != F.col("b.area_id")) & (F.col("a.column_id") != F.col("b.area_id"))
    return cut.alias("a").join(spans.alias("b"), on, "left_anti")


def uncrossed(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Merged boxes (page_id, x1..y2) that no line strictly enters unless the line's box contains them."""
    a, b = Box.of("a"), Box.of("b")
    on = (F.col("a.page_id") == F.col("b.page_id")) & a.overlaps(b) & ~b.contains(a)
    return pairs.alias("a").join(lines.alias("b"), on, "left_anti")
