"""Density clusters of points, and lines as clusters of segments with the regression through their pixels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Box
from .graph import least_roots, page_components
from .spatial import box_join


#: Pairs of points that are looked at together.
_PAIRS = 1 << 18


def _near_points(x: np.ndarray, y: np.ndarray, distance: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b) of points within the distance, in both directions and with themselves, some at a time: each point meets those of the grid cells around it."""
    cx, cy = (np.floor(v / distance) for v in (x, y))
    # numbers of the columns and rows of cells that hold points; those side by side differ by one, others by more
    cx, cy = (np.cumsum(np.r_[0, np.minimum(np.diff(own), 2)])[at].astype(np.int64) for own, at in (np.unique(c, return_inverse=True) for c in (cx, cy)))
    tall = int(cy.max()) + 3
    code = cx * tall + cy + 1
    order = np.argsort(code, kind="stable")
    held = code[order]
    for step in (-tall, 0, tall):
        first, end = (np.searchsorted(held, held + step + k, side) for k, side in ((-1, "left"), (1, "right")))
        n = end - first
        upto, at = np.cumsum(n), 0
        while at < len(n):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + _PAIRS, "right")))
            some = n[at:to]
            a, b = np.repeat(order[at:to], some), order[np.repeat(first[at:to] - np.cumsum(some) + some, some) + np.arange(some.sum())]
            met = (x[a] - x[b]) ** 2 + (y[a] - y[b]) ** 2 <= distance**2
            yield a[met], b[met]
            at = to


def _clusters(x: np.ndarray, y: np.ndarray, distance: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each of one page's points is a core point, and its cluster's first point (the number of points where there is none)."""
    count, root = np.zeros(len(x), np.int64), None
    for a, _ in _near_points(x, y, distance):
        count += np.bincount(a, minlength=len(x))
    core = count >= least
    for a, b in _near_points(x, y, distance):
        kept = core[a] & core[b] & (a < b)
        root = least_roots(len(x), a[kept], b[kept], root)
    named = np.where(core, root, len(x))
    for a, b in _near_points(x, y, distance):
        kept = core[a] & ~core[b]
        np.minimum.at(named, b[kept], root[a[kept]])
    return core, named


def density_clusters(points: DataFrame, distance: float, least: int, keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Points (keys, point_id, x, y) with ``core`` and ``cluster``.

    A point with at least ``least`` points within ``distance``, itself included, is a core point. Core points within the
    distance of each other are one cluster, named by its least point_id; another point belongs to the least cluster with a core point
    within the distance, and to none (null) where there is none. Points meet those of the nine grid cells around them only; a page is done where its points are.
    """

    def run(page: pa.Table) -> pa.Table:
        page = page.take(pc.sort_indices(page, [("point_id", "ascending")]))  # the first point is the least
        x, y = (pc.cast(page[c], pa.float64()).to_numpy() for c in ("x", "y"))
        placed = np.flatnonzero(np.isfinite(x) & np.isfinite(y))
        core, named = np.zeros(len(x), bool), np.full(len(x), len(placed))
        if len(placed):
            core[placed], named[placed] = _clusters(x[placed], y[placed], float(distance), least)
        first = pa.array(np.r_[placed, 0][named], mask=named == len(placed))
        return page.append_column("core", pa.array(core)).append_column("cluster", page["point_id"].take(first))

    types = ", ".join(f"`{c}` {t}" for c, t in points.dtypes)
    return points.groupBy(*keys).applyInArrow(run, f"{types}, core boolean, cluster {dict(points.dtypes)['point_id']}")


def _sums(x1, x2, y1, y2) -> dict:
    """Count and sums of x, y, x², y² and xy over the whole pixels of a box."""
    w, h = x2 - x1 + 1, y2 - y1 + 1
    to = lambda a: a * (a + 1) * (2 * a + 1) / 6  # noqa: E731  0² + ... + a²
    sx, sy = w * (x1 + x2) / 2, h * (y1 + y2) / 2
    return {"n": w * h, "sx": sx * h, "sy": sy * w, "sxx": (to(x2) - to(x1 - 1)) * h, "syy": (to(y2) - to(y1 - 1)) * w, "sxy": sx * sy}


def line_clusters(lines: DataFrame, distance: float = 25.0) -> DataFrame:
    """Lines (page_id, group_id, upright, x1, y1, x2, y2, slope, intercept, n) in place of segments that lie near each other.

    The clusters are those of the segments' pixels with two points in ``distance`` as the least density: two boxes of pixels are in one where their
    distance is that or less, directly or through others. Flat and upright segments (higher than wide) are clustered apart. The line is the
    regression of y on x over all pixels (of x on y for upright ones), as overlapping segments count each; sums over a box of pixels have a closed form, so no pixel is made. At
    least one pixel wide and high; a single pixel is no line.
    """
    whole = lambda c: F.floor(c).cast("double")
    own = lines.select("page_id", "area_id", whole(F.col("x1")).alias("x1"), whole(F.col("y1")).alias("y1"), whole(F.col("x2")).alias("x2"), whole(F.col("y2")).alias("y2")).withColumn("upright", F.col("y2") - F.col("y1") > F.col("x2") - F.col("x1"))
    gap = lambda a, b: a.gap_x(b) ** 2 + a.gap_y(b) ** 2
    near = box_join(own, own.select(*[F.col(c).alias(c) for c in own.columns]), lambda a, b: gap(a, b) <= float(distance) ** 2, keys=("page_id", "upright"))
    pairs = near.where("a.area_id < b.area_id").select(F.col("a.page_id").alias("page_id"), F.col("a.area_id").alias("u"), F.col("b.area_id").alias("v"))
    roots = page_components(pairs).select("page_id", F.col("u").alias("area_id"), "root")
    met = own.join(roots, ["page_id", "area_id"], "left").withColumn("group_id", F.coalesce("root", "area_id"))
    sums = _sums(*(F.col(c) for c in ("x1", "x2", "y1", "y2")))
    total = met.groupBy("page_id", "group_id", "upright").agg(*[F.sum(v).alias(k) for k, v in sums.items()], F.min("x1").alias("x1"), F.max("x2").alias("x2"), F.min("y1").alias("y1"), F.max("y2").alias("y2"), F.count("*").alias("segments")).where("n > 1")
    pick = lambda a, b: F.when(F.col("upright"), F.col(a)).otherwise(F.col(b))
    s, t, ss = pick("sy", "sx"), pick("sx", "sy"), pick("syy", "sxx")
    spread = F.col("n") * ss - s * s
    slope = F.when(spread == 0, F.lit(0.0)).otherwise((F.col("n") * F.col("sxy") - s * t) / spread)
    fit = total.withColumn("slope", slope).withColumn("intercept", (t - F.col("slope") * s) / F.col("n"))
    low, high = (F.col("intercept") + F.col("slope") * pick(a, b) for a, b in (("y1", "x1"), ("y2", "x2")))
    fit = fit.withColumn("p", F.least(low, high)).withColumn("q", F.greatest(low, high))
    box = fit.select("page_id", "group_id", "upright", F.when(F.col("upright"), F.col("p")).otherwise(F.col("x1")).alias("x1"), F.when(F.col("upright"), F.col("y1")).otherwise(F.col("p")).alias("y1"), F.when(F.col("upright"), F.col("q")).otherwise(F.col("x2")).alias("x2"), F.when(F.col("upright"), F.col("y2")).otherwise(F.col("q")).alias("y2"), "slope", "intercept", "segments")
    for a, b in (("x1", "x2"), ("y1", "y2")):
        box = box.withColumn("_same", F.col(a) == F.col(b)).withColumn(a, F.when(F.col("_same"), F.col(a) - 1).otherwise(F.col(a))).withColumn(b, F.when(F.col("_same"), F.col(b) + 1).otherwise(F.col(b))).drop("_same")
    return box.select("page_id", "group_id", "upright", *[F.rint(c).alias(c) for c in ("x1", "y1", "x2", "y2")], "slope", "intercept", F.col("segments").alias("n"))
