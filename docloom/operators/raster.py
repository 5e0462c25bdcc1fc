"""Page images as rows of ink: runs (page_id, y, x1, x2; x2 behind the last pixel), and what is found on them with joins and windows.

Window sums, dilation and components never see a pixel by itself: a run gives its steps, sums over rows and columns
are taken over those steps one axis after the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import least_roots

#: Pixels of a page that are looked at together where its rows allow.
_STRIPE = 1 << 20

#: Fixed point of the table of sines and cosines.
_ONE = 1 << 16


def ink_runs(images: DataFrame) -> DataFrame:
    """Runs of the dark pixels of grey images (page_id, width, height, data)."""
    from ..sources.images import _array, ink

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                dark = np.pad(ink(_array(r.data, r.width, r.height)).astype(np.int8), ((0, 0), (1, 1)))
                y, a = np.nonzero(np.diff(dark, axis=1) == 1)
                b = np.nonzero(np.diff(dark, axis=1) == -1)[1]
                yield pd.DataFrame({"page_id": r.page_id, "y": y, "x1": a, "x2": b})

    return images.select("page_id", "width", "height", "data").mapInPandas(run, "page_id long, y long, x1 long, x2 long")


def merged_runs(runs: DataFrame, keys: tuple[str, ...] = ("page_id", "y")) -> DataFrame:
    """Runs of a row that overlap or touch as one."""
    w = Window.partitionBy(*keys).orderBy("x1", "x2")
    reach = F.max("x2").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("_new", F.when(reach.isNull() | (F.col("x1") > reach), 1).otherwise(0))
    marked = marked.withColumn("_n", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_n").agg(F.min("x1").alias("x1"), F.max("x2").alias("x2")).select(*keys, "x1", "x2")


def _spread(runs: DataFrame, rows: int) -> DataFrame:
    """Every run in each row up to so many away."""
    return runs.withColumn("y", F.explode(F.sequence(F.col("y") - rows, F.col("y") + rows)))


def dilated(runs: DataFrame, across: int, down: int) -> DataFrame:
    """Runs of the pixels with ink in the window of ``across`` and ``down`` pixels to each side: one axis after the other."""
    wide = merged_runs(runs.select("page_id", "y", (F.col("x1") - across).alias("x1"), (F.col("x2") + across).alias("x2")))
    return merged_runs(_spread(wide, down))


def blurred(runs: DataFrame, across: int, down: int, least: int) -> DataFrame:
    """Runs of the pixels around which the window of ``across`` and ``down`` pixels to each side holds at least ``least`` pixels of ink.

    Along a row the sum changes by one at each pixel while a run enters or leaves the window, so its slope changes at four
    places for each run. Slopes of the rows of a window add up; between two places the sum is a straight line, which is cut at ``least``.
    """
    one = merged_runs(runs)
    step = lambda x, v: F.struct(x.alias("x"), F.lit(v).alias("v"))
    a, b = F.col("x1"), F.col("x2")
    turns = F.array(step(a - across, 1), step(b - across, -1), step(a + across + 1, -1), step(b + across + 1, 1))
    # whole rows first: steps at one place of a row are one before they are dealt to the rows around
    rows = one.select("page_id", "y", F.explode(turns).alias("s")).groupBy("page_id", "y", F.col("s.x").alias("x")).agg(F.sum("s.v").alias("v"))
    steps = _spread(rows, down).groupBy("page_id", "y", "x").agg(F.sum("v").alias("v")).where("v <> 0")
    w = Window.partitionBy("page_id", "y").orderBy("x")
    # from place x on the sum grows by slope at every pixel, that of place x included
    line = steps.withColumn("slope", F.sum("v").over(w)).withColumn("next", F.lead("x").over(w)).where("next IS NOT NULL")
    line = line.withColumn("sum", F.coalesce(F.sum(F.col("slope") * (F.col("next") - F.col("x"))).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    k, s, n = F.lit(least) - F.col("sum"), F.col("slope"), F.col("next") - F.col("x")
    # pixel x + i has sum + slope * (i + 1)
    first = F.when(s > 0, F.greatest(F.lit(0), F.ceil(k / s).cast("long") - 1)).otherwise(F.lit(0))
    behind = F.when(s > 0, n).when(s == 0, F.when(k <= 0, n).otherwise(F.lit(0))).otherwise(F.least(n, F.floor(k / s).cast("long")))
    cut = line.select("page_id", "y", (F.col("x") + first).alias("x1"), (F.col("x") + behind).alias("x2")).where("x1 < x2")
    return merged_runs(cut)


def _components(y: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict[str, np.ndarray]:
    """Components of one page's runs, by row and begin and not overlapping: every run meets the stretch of runs above it that it touches."""
    left = a.min() - 1
    wide = b.max() - left + 2
    above = (y - 1 - y[0]) * wide
    first = np.searchsorted((y - y[0]) * wide + b - left, above + a - left, "left")
    n = np.maximum(np.searchsorted((y - y[0]) * wide + a - left, above + b - left, "right") - first, 0)
    u = np.repeat(np.arange(len(y)), n)
    v = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    root, at = np.unique(least_roots(len(y), u, v), return_inverse=True)
    order = np.argsort(at, kind="stable")
    begin = np.searchsorted(at[order], np.arange(len(root)))
    each = lambda f, v: f.reduceat(v[order], begin)
    return {"group_id": np.arange(len(root)), "x1": each(np.minimum, a), "y1": each(np.minimum, y), "x2": each(np.maximum, b) - 1, "y2": each(np.maximum, y), "pixels": each(np.add, b - a)}


def _joined_runs(group: pd.DataFrame) -> pd.DataFrame:
    """``_components`` of one page's runs."""
    group = group.sort_values(["y", "x1"])
    return pd.DataFrame({"page_id": group["page_id"].iloc[0], **_components(*(group[c].to_numpy() for c in ("y", "x1", "x2")))})


def run_components(runs: DataFrame) -> DataFrame:
    """Boxes (page_id, group_id, x1, y1, x2, y2; whole pixels, the last included) and pixels of connected runs, diagonal neighbours included; page by page."""
    one = merged_runs(runs).select("page_id", *[F.col(c).cast("long").alias(c) for c in ("y", "x1", "x2")])
    page = dict(one.dtypes)["page_id"]
    return one.groupBy("page_id").applyInPandas(_joined_runs, f"page_id {page}, group_id long, x1 long, y1 long, x2 long, y2 long, pixels long")


def _window(room: list[np.ndarray], long: int, n: int, step: int, join: np.ufunc) -> int:
    """``join`` of ``n`` values, each ``step`` behind the one before, for all places of the first ``long`` of ``room[0]`` that have them: of windows doubled in size.

    The result is in ``room[0]`` again, its length is returned; the other two arrays of ``room`` are worked in.
    """
    part, out, has, size = 0, None, 0, 1
    while True:
        if n & size and out is None:
            out, has = part, size
        elif n & size:
            left = long - (has + size - 1) * step
            join(room[out][:left], room[part][has * step : has * step + left], out=room[out][:left])
            has += size
        if has == n:
            room[0], room[out] = room[out], room[0]
            return long - (n - 1) * step
        to, left = min({0, 1, 2} - {part, out}), long - (2 * size - 1) * step
        join(room[part][:left], room[part][size * step : size * step + left], out=room[to][:left])
        part, size = to, 2 * size


def _paragraph_runs(y: np.ndarray, a: np.ndarray, b: np.ndarray, across: int, down: int, least: int, grow: int, room: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (y, x1, x2) of one page's ink blurred, cut and dilated, by stripes of rows; by row and begin.

    A stripe is one flat array, with so much room between rows that windows never reach the next one's ink. ``room`` keeps the arrays from page to page.
    """
    edge, tall = across + grow, down + grow
    left, wide = int(a.min()) - edge, int(b.max() - a.min()) + 4 * edge + 1
    step = max(8 * tall, _STRIPE // wide, 1)
    kind = np.min_scalar_type((2 * across + 1) * (2 * down + 1))
    out = [[], [], []]
    for top in range(int(y.min()) - tall, int(y.max()) + tall + 1, step):
        on = np.flatnonzero((y >= top - tall) & (y < top + step + tall))
        if not len(on):
            continue
        rows = min(step, int(y[on].max()) + tall + 1 - top)
        # place p of the windows' results is the pixel ``edge`` to the right and ``tall`` below of place p of the ink
        long = (rows + 2 * tall) * wide + 2 * edge
        if not room or len(room[0]) < long:
            room[:] = [np.empty(long, kind) for _ in range(3)]
        ink = room[0]
        ink[:long] = 0
        start, n = (y[on] - top + tall) * wide + a[on] - left + edge, b[on] - a[on]
        upto, k = np.cumsum(n), 0
        while k < len(n):
            to = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + (1 << 14), "right")))
            ink[np.repeat(start[k:to] - upto[k:to] + n[k:to], n[k:to]) + np.arange(upto[k] - n[k], upto[to - 1])] = 1
            k = to
        long = _window(room, _window(room, long, 2 * across + 1, 1, np.add), 2 * down + 1, wide, np.add)
        dark = [room[k].view(np.bool_) for k in (1, 2, 0)]
        np.greater_equal(room[0][:long], least, out=dark[0][:long])
        long = _window(dark, _window(dark, long, 2 * grow + 1, 1, np.logical_or), 2 * grow + 1, wide, np.logical_or)
        on, turned = dark[0][:long], dark[1][: long - 1]
        np.not_equal(on[1:], on[:-1], out=turned)
        turn = np.r_[[0] * int(on[0]), np.flatnonzero(turned) + 1, [long] * int(on[-1])].astype(np.int64)
        row, first = np.divmod(turn[::2], wide)
        for c, v in zip(out, (row + top, first + left, turn[1::2] - row * wide + left)):
            c.append(v)
    return tuple(np.concatenate(c) for c in out)


def paragraph_boxes(runs: DataFrame, across: int = 21, down: int = 3, share: float = 0.1, grow: int = 8) -> DataFrame:
    """Paragraphs: components of the ink blurred (a share of the window), cut and dilated by ``grow`` pixels; a page is done in stripes where its runs are.

    The same as ``run_components(dilated(blurred(...)))``. A run may stand for all rows from y to ``y2``, y2 behind the last.
    """
    least, room = max(1, round(share * (2 * across + 1) * (2 * down + 1))), []

    def run(group: pd.DataFrame) -> pd.DataFrame:
        y, a, b, n = (group[c].to_numpy() for c in ("y", "x1", "x2", "n"))
        y, a, b = np.repeat(y - np.cumsum(n) + n, n) + np.arange(n.sum()), np.repeat(a, n), np.repeat(b, n)
        found = _paragraph_runs(y, a, b, across, down, least, grow, room)
        if not len(found[0]):
            return pd.DataFrame(columns=["page_id", "group_id", "x1", "y1", "x2", "y2", "pixels"])
        return pd.DataFrame({"page_id": group["page_id"].iloc[0], **_components(*found)})

    rows = F.col("y2").cast("long") - F.col("y").cast("long") if "y2" in runs.columns else F.lit(1).cast("long")
    one = runs.select("page_id", *[F.col(c).cast("long").alias(c) for c in ("y", "x1", "x2")], rows.alias("n")).where("x1 < x2 AND y IS NOT NULL AND n > 0")
    return one.groupBy("page_id").applyInPandas(run, f"page_id {dict(one.dtypes)['page_id']}, group_id long, x1 long, y1 long, x2 long, y2 long, pixels long")


# straight lines


def _angles(n: int) -> list[tuple[int, int, int]]:
    """(number, cosine, sine) of directions over half a turn, in fixed point: exact on every machine."""
    return [(i, round(math.cos(math.pi * i / n) * _ONE), round(math.sin(math.pi * i / n) * _ONE)) for i in range(n)]


def _rho(x: np.ndarray, y: np.ndarray, c: int, s: int) -> np.ndarray:
    """Distance of points from the origin across a direction, in whole pixels."""
    return (x * c + y * s + _ONE // 2) >> 16


def _page_votes(x: np.ndarray, y: np.ndarray, angles: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(angle, rho, votes) of the lines that at least ``least`` of a page's points vote for, one direction after the other."""
    found, turns = [], np.array(_angles(angles), np.int64)
    for part in np.array_split(turns, -(-len(turns) * len(x) // (1 << 18))) if len(x) < 1 << 18 else turns[:, None]:
        rho = _rho(x, y, part[:, 1:2], part[:, 2:3])
        low = int(rho.min())
        wide = int(rho.max()) - low + 1
        code = rho - low + np.arange(len(part))[:, None] * wide
        if wide * len(part) < 16 * code.size + (1 << 20):
            n = np.bincount(code.ravel())
            k = np.flatnonzero(n >= least)
            n = n[k]
        else:
            k, n = np.unique(code, return_counts=True)
            k, n = k[n >= least], n[n >= least]
        found.append((part[k // wide, 0], k % wide + low, n))
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*found))


def _by_page(points: DataFrame, keys: list[str], run, columns: str) -> DataFrame:
    """``run`` over the whole x and y of each page, named by ``keys``: its columns behind the keys."""
    names, types = [c.split()[0] for c in columns.split(", ")], dict(points.dtypes)

    def one(group: pd.DataFrame) -> pd.DataFrame:
        found = dict(zip(names, run(group["x"].to_numpy(), group["y"].to_numpy())))
        return pd.DataFrame({**{k: [group[k].iloc[0]] * len(found[names[0]]) for k in keys}, **found})

    whole = points.select(*keys, F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    return whole.groupBy(*keys).applyInPandas(one, ", ".join(f"{k} {types[k]}" for k in keys) + ", " + columns)


def line_votes(points: DataFrame, angles: int = 180, least: int = 10, keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """(keys, angle, rho, votes): lines ``x cos + y sin = rho`` that at least ``least`` points vote for; a page's votes are counted where its points are and never shuffled."""
    return _by_page(points, list(keys), lambda x, y: _page_votes(x, y, angles, least), "angle int, rho long, votes long")


def _peaks(angle: np.ndarray, rho: np.ndarray, votes: np.ndarray, angles: int) -> np.ndarray:
    """Places of the lines with the most votes (then the least angle and rho) within two steps, by falling votes."""
    order = np.lexsort((rho, angle, -votes))
    if not len(order):
        return order
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    # a turn of half a circle gives the same line with the other sign
    wide = 2 * int(np.abs(rho).max()) + 7
    code = lambda a, r: a * wide + r + wide // 2
    own = code(angle, rho)
    by = np.argsort(own)
    best = rank.copy()
    for i in range(-2, 3):
        a = angle + i
        turned = np.where((a < 0) | (a >= angles), -rho, rho)
        for j in range(-2, 3):
            asked = code(a % angles, turned + j)
            at = by[np.minimum(np.searchsorted(own, asked, sorter=by), len(by) - 1)]
            best = np.minimum(best, np.where(own[at] == asked, rank[at], best))
    return order[best[order] == rank[order]]


def _segments(x: np.ndarray, y: np.ndarray, angles: int, least: int, length: float, gap: float) -> tuple:
    """The segments of one page's points."""
    angle, rho, votes = _page_votes(x, y, angles, least)
    turns = np.array(_angles(angles), np.int64)
    line, t = np.full(len(x), -1), np.zeros(len(x), np.int64)
    peaks = _peaks(angle, rho, votes, angles)
    free = np.arange(len(x))
    # lines of equal votes together: a free point takes the nearest, then the first by angle and rho
    for level in np.split(peaks, np.flatnonzero(np.diff(votes[peaks])) + 1):
        off, own = np.full(len(free), 2), np.full(len(free), -1)
        for some in np.array_split(level, max(1, len(level) * len(free) >> 20)):
            if len(some) and len(free):
                away = np.abs(_rho(x[free], y[free], turns[angle[some], 1][:, None], turns[angle[some], 2][:, None]) - rho[some][:, None])
                near = away.argmin(0)
                least_off = away[near, np.arange(len(free))]
                own, off = np.where(least_off < off, some[near], own), np.minimum(off, least_off)
        met, k = free[own >= 0], own[own >= 0]
        line[met], t[met] = k, y[met] * turns[angle[k], 1] - x[met] * turns[angle[k], 2]
        free = free[own < 0]
    kept = np.flatnonzero(line >= 0)
    kept = kept[np.lexsort((y[kept], x[kept], t[kept], rho[line[kept]], angle[line[kept]]))]
    x, y, line, t = x[kept], y[kept], line[kept], t[kept]
    again = np.r_[False, (x[1:] == x[:-1]) & (y[1:] == y[:-1]) & (line[1:] == line[:-1])][: len(x)]
    x, y, line, t = x[~again], y[~again], line[~again], t[~again]
    begin = np.flatnonzero(np.r_[True, (line[1:] != line[:-1]) | (np.diff(t) > int(gap * _ONE))][: len(x)])
    end = np.r_[begin[1:], len(x)][: len(begin)]
    far = ((x[begin] - x[end - 1]) ** 2 + (y[begin] - y[end - 1]) ** 2) >= float(length) ** 2
    p, q, n = begin[far], end[far] - 1, (end - begin)[far]
    first = x[p] <= x[q]
    p, q = np.where(first, p, q), np.where(first, q, p)
    place = np.lexsort((y[p], x[p], rho[line[p]], angle[line[p]]))
    p, q, n = p[place], q[place], n[place]
    return angle[line[p]], rho[line[p]], n, x[p], y[p], x[q], y[q], np.arange(len(p))


def straight_lines(points: DataFrame, angles: int = 180, least: int = 10, length: float = 200.0, gap: float = 10.0, keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Segments (keys, line_id, x1, y1, x2, y2, votes) of distinct points (keys, x, y) that stand in a line, at any angle.

    Lines are the most voted ones of their neighbourhood (two steps in angle and distance). A point belongs to the most voted of the lines within a
    pixel of it; a line's points, in order along it, are one segment until a gap, and stay if the segment is long enough. All of a page is done where its points are.
    """
    return _by_page(points, list(keys), lambda x, y: _segments(x, y, angles, least, length, gap), "angle int, rho long, votes long, x1 long, y1 long, x2 long, y2 long, line_id long")


def run_points(runs: DataFrame) -> DataFrame:
    """The pixels of runs at both their ends and inside: page_id, x, y."""
    return runs.select("page_id", F.explode(F.sequence(F.col("x1"), F.col("x2") - 1)).alias("x"), "y")


def outline_points(runs: DataFrame) -> DataFrame:
    """The pixels of runs with no ink above or no ink below, and the ends of runs: what edges of strokes are made of."""
    one = merged_runs(runs)
    end = F.explode(F.array_distinct(F.array(F.col("x1"), F.col("x2") - 1)))
    return one.select("page_id", end.alias("x"), "y").distinct()
