"""Rows of cells by repeated walks between barriers, and cells widened over empty neighbours."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cluster import runs
from .graph import least_roots
from .tables import modal_width

_BOX = ("x1", "y1", "x2", "y2")


def _corners(boxes: pa.Table) -> np.ndarray:
    return np.stack([boxes[c].to_numpy().astype(float) for c in _BOX], 1)


def barred(hulls: np.ndarray, lines: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """Whether a line runs across each hull: strictly between its sides and beyond both of its ends."""
    out = np.zeros(len(hulls), bool)
    step = max(1, block // max(1, len(lines)))
    for k in range(0, len(hulls), step):
        h, d = hulls[k : k + step, None], lines[None]
        upright = (h[..., 0] < d[..., 0]) & (h[..., 2] > d[..., 0]) & (h[..., 1] > d[..., 1]) & (h[..., 3] < d[..., 3])
        flat = (h[..., 1] < d[..., 1]) & (h[..., 3] > d[..., 1]) & (h[..., 0] > d[..., 0]) & (h[..., 2] < d[..., 2])
        out[k : k + step] = (upright | flat).any(1)
    return out


def open_pairs(b: np.ndarray, lines: np.ndarray, tolerance: float, reach: float = 10_000.0) -> tuple[np.ndarray, np.ndarray]:
    """(u, v), u < v: cells of a page with at least ``tolerance`` of their heights in common, at most ``reach`` apart sideways, whose hull no line runs across.

    Cells sorted by their tops meet only a run of those after them.
    """
    order, us, vs = np.argsort(b[:, 1], kind="stable"), [], []
    end = b[order, 3] - tolerance
    for i, j in runs(np.searchsorted(b[order, 1], end + 1e-9 * (np.abs(end) + 1), side="right")):
        u, v = np.minimum(order[i], order[j]), np.maximum(order[i], order[j])
        met = (b[u, 1] <= b[v, 3] - tolerance) & (b[u, 3] >= b[v, 1] + tolerance) & (b[u, 0] <= b[v, 2] + reach) & (b[u, 2] >= b[v, 0] - reach)
        u, v = u[met], v[met]
        free = ~barred(np.c_[np.minimum(b[u, :2], b[v, :2]), np.maximum(b[u, 2:], b[v, 2:])], lines)
        us.append(u[free])
        vs.append(v[free])
    return np.concatenate(us), np.concatenate(vs)


def _walk(n: int, u: np.ndarray, v: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Each cell with the cell of its group that the order (places of the cells) puts first."""
    return np.argsort(order)[least_roots(n, order[u], order[v])[order]]


def _apart(old: np.ndarray, new: np.ndarray) -> float:
    """Mean share of a group, of the largest one's size, in which two groupings of a page differ."""
    n_old, n_new = np.bincount(old), np.bincount(new)
    pair, both = np.unique(np.c_[new, old], axis=0, return_counts=True)
    # the old group that shares most with a new one is what that one was
    best = np.lexsort((n_old[pair[:, 1]], both, pair[:, 0]))
    best = best[np.r_[pair[best[1:], 0] != pair[best[:-1], 0], True]]
    own, was = pair[best].T
    return float((n_new[own] + n_old[was] - 2 * both[best]).mean() / n_new.max())


def row_chains(cells: DataFrame, barriers: DataFrame, tolerance: float = 0.0, most_walks: int = 10, convergence: float = 0.1, seed: int = 7) -> DataFrame:
    """Rows of cells: page_id, area_id, row_no (from 0 by the row's top, then its least area_id), place (from 0 by x1, then area_id), n (cells of the row).

    A walk starts at the first cell of a seeded order and takes all it reaches over open pairs; the next cell not yet taken
    starts the next row. Walks with other seeds are repeated until two groupings of the page differ by ``convergence`` at most, or ``most_walks`` are
    done; as pairs are open both ways, no order changes a group, and the second walk confirms the first. A page is done by itself,
    without an exchange if cells and barriers are dealt by page; cells without a page or an id are left out.
    """

    def run(key: tuple, own: pa.Table, drawn: pa.Table) -> pa.Table:
        own = own.sort_by("area_id")
        ids, b = own["area_id"].to_numpy(), _corners(own)
        n = len(ids)
        if not n:
            return pa.table({"page_id": pa.array([], pa.int64()), **{c: pa.array([], pa.int64()) for c in ("area_id", "row_no", "place", "n")}})
        u, v = open_pairs(b, _corners(drawn), tolerance)
        now = None
        for k in range(max(1, most_walks)):
            before, now = now, _walk(n, u, v, np.random.default_rng([seed + k, n]).permutation(n))
            if before is not None and _apart(before, now) <= convergence:
                break
        group, size = np.unique(now, return_inverse=True, return_counts=True)[1:]
        top, least = np.full(len(size), np.nan), np.full(len(size), n)
        np.fmin.at(top, group, b[:, 1])
        np.minimum.at(least, group, np.arange(n))
        rank = np.empty(len(size), np.int64)
        rank[np.lexsort((least, np.where(np.isnan(top), -np.inf, top)))] = np.arange(len(size))
        row, order = rank[group], np.lexsort((np.arange(n), np.where(np.isnan(b[:, 0]), -np.inf, b[:, 0]), group))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        return pa.table({"page_id": pa.array([key[0].as_py()] * n, pa.int64()), **{c: pa.array(x, pa.int64()) for c, x in (("area_id", ids), ("row_no", row), ("place", place), ("n", size[group]))}})

    own = cells.where("page_id IS NOT NULL AND area_id IS NOT NULL").select(*[F.col(c).alias(c) for c in ("page_id", "area_id", *_BOX)])
    drawn = barriers.select(*[F.col(c).alias(c) for c in ("page_id", *_BOX)])
    return own.groupBy("page_id").cogroup(drawn.groupBy("page_id")).applyInArrow(run, "page_id long, area_id long, row_no long, place long, n long")


def probable_width(rows: DataFrame) -> DataFrame:
    """Columns of each page's rows: the greatest of the three most common sizes."""
    return modal_width(rows.groupBy("page_id", "row_no").agg(F.count("*").alias("n")), "page_id")


def widened(cells: DataFrame, lines: DataFrame) -> DataFrame:
    """Cells (table_id, r, c, cell_id, x1, x2; rows of one width, empty places left out) with spans filled: table_id, r, c, cell_id.

    In rows 0 and 1, then 0 and 2, then 1 and 2: where the upper row has a cell with empty neighbours over three cells of the lower one,
    the cell is taken to both sides, from left to right, unless an upright line (table_id, x1) stands between the lower cells' outer ends. A cell
    taken over fills its right neighbour, so of places two apart every other one can be taken: they are counted. Then rows 0 and 1 fill each other's empty places.
    """
    at = lambda r: F.max(F.when(F.col("r") == r, F.struct("cell_id", "x1", "x2")))
    top = cells.where("r < 3").groupBy("table_id", "c").agg(*[at(r).alias(f"a{r}") for r in range(3)])
    # all that follows are windows along a table's columns: with cells and lines dealt by table nothing is exchanged
    stabs = lines.groupBy("table_id").agg(F.collect_set("x1").alias("stabs"))
    top = top.join(stabs.hint("merge"), "table_id", "left")
    w = Window.partitionBy("table_id").orderBy("c")
    before = w.rowsBetween(Window.unboundedPreceding, -1)

    def near(name: str, step: int) -> Column:
        """The cell ``step`` columns on; none where that column has no cell in any row."""
        move = F.lead if step > 0 else F.lag
        return F.when(move("c", abs(step)).over(w) == F.col("c") + step, move(name, abs(step)).over(w))

    for upper, lower in (("a0", "a1"), ("a0", "a2"), ("a1", "a2")):
        seen = top.withColumns({"left": near(lower, -1), "right": near(lower, 1), "l": near(upper, -1), "r": near(upper, 1)})
        lo, hi = F.col("left.x1").cast("long"), F.col("right.x2").cast("long")
        crossed = F.coalesce(F.exists("stabs", lambda s: (s >= lo) & (s < hi)), F.lit(False))
        empty = F.col(upper).isNotNull() & F.col("l").isNull() & F.col("r").isNull() & F.col("left").isNotNull() & F.col(lower).isNotNull() & F.col("right").isNotNull()
        free = seen.withColumn("fits", empty & ~crossed)
        # places two apart follow each other: the first, third, ... of a run are taken
        start = F.col("fits") & ~F.coalesce(F.col("c") - F.last(F.when(F.col("fits"), F.col("c")), ignorenulls=True).over(before) == 2, F.lit(False))
        run = free.withColumn("start", start).withColumn("k", F.sum(F.col("fits").cast("int")).over(w))
        first = F.last(F.when(F.col("start"), F.col("k")), ignorenulls=True).over(w)
        taken = run.withColumn("new", F.when(F.col("fits") & ((F.col("k") - first) % 2 == 0), F.col(upper)))
        top = taken.withColumn(upper, F.coalesce(upper, near("new", -1), near("new", 1))).select("table_id", "c", "a0", "a1", "a2", "stabs")
    top = top.withColumns({"a0": F.coalesce("a0", "a1"), "a1": F.coalesce("a1", "a0")})
    flat = top.select("table_id", "c", F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.col(f"a{r}.cell_id").alias("cell_id")) for r in range(3)])).alias("x")).select("table_id", "x.r", "c", "x.cell_id").where("cell_id IS NOT NULL")
    return flat.unionByName(cells.where("r >= 3").select("table_id", "r", "c", "cell_id"))
