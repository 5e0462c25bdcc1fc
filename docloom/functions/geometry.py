"""Bounding-box arithmetic as Column functions: no UDFs, so filters and joins on boxes stay in generated code.

A box is four columns; ``Box("a")`` names ``a.x1 .. a.y2`` of an aliased DataFrame, ``Box()`` the bare columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    """Four coordinate columns."""

    x1: Column
    y1: Column
    x2: Column
    y2: Column

    @classmethod
    def of(cls, alias: str = "") -> Box:
        p = f"{alias}." if alias else ""
        return cls(*[F.col(p + c) for c in ("x1", "y1", "x2", "y2")])

    def columns(self) -> list[Column]:
        return [self.x1.alias("x1"), self.y1.alias("y1"), self.x2.alias("x2"), self.y2.alias("y2")]

    @property
    def width(self) -> Column:
        return self.x2 - self.x1

    @property
    def height(self) -> Column:
        return self.y2 - self.y1

    @property
    def area(self) -> Column:
        return self.width * self.height

    @property
    def middle(self) -> tuple[Column, Column]:
        return (self.x1 + self.x2) * 0.5, (self.y1 + self.y2) * 0.5

    @property
    def is_vertical(self) -> Column:
        return self.height > self.width

    @property
    def is_horizontal(self) -> Column:
        return self.width > self.height

    def normalized(self) -> Box:
        """Negative coordinates become 0, corners are put in order."""
        z = F.lit(0.0)
        x, y = [F.greatest(c, z) for c in (self.x1, self.x2)], [F.greatest(c, z) for c in (self.y1, self.y2)]
        return Box(F.least(*x), F.least(*y), F.greatest(*x), F.greatest(*y))

    def scaled(self, fx: Column, fy: Column) -> Box:
        """To pixels with the page's factors; with their inverses to points."""
        return Box(self.x1 * fx, self.y1 * fy, self.x2 * fx, self.y2 * fy)

    def unscaled(self, fx: Column, fy: Column) -> Box:
        return Box(self.x1 / fx, self.y1 / fy, self.x2 / fx, self.y2 / fy)

    def shifted(self, by) -> Box:
        """All coordinates moved by an amount."""
        return Box(self.x1 + by, self.y1 + by, self.x2 + by, self.y2 + by)

    def transposed(self) -> Box:
        return Box(self.y1, -self.x2, self.y2, -self.x1)

    def corners(self) -> Column:
        """Four corners clockwise."""
        p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
        return F.array(p(self.x1, self.y1), p(self.x2, self.y1), p(self.x2, self.y2), p(self.x1, self.y2))

    def union(self, o: Box) -> Box:
        return Box(F.least(self.x1, o.x1), F.least(self.y1, o.y1), F.greatest(self.x2, o.x2), F.greatest(self.y2, o.y2))

    def average(self, o: Box) -> Box:
        return Box((self.x1 + o.x1) * 0.5, (self.y1 + o.y1) * 0.5, (self.x2 + o.x2) * 0.5, (self.y2 + o.y2) * 0.5)

    def intersection(self, o: Box, gap: bool = False) -> Box:
        """Common part; null where disjoint, or with ``gap`` the rectangle between the boxes."""
        x = F.greatest(self.x1, o.x1), F.least(self.x2, o.x2)
        y = F.greatest(self.y1, o.y1), F.least(self.y2, o.y2)
        if gap:
            return Box(F.least(*x), F.least(*y), F.greatest(*x), F.greatest(*y))
        met = (x[0] <= x[1]) & (y[0] <= y[1])
        return Box(*[F.when(met, c) for c in (x[0], y[0], x[1], y[1])])

    def overlaps(self, o: Box) -> Column:
        """Strict: touching edges do not overlap."""
        return (self.x1 < o.x2) & (o.x1 < self.x2) & (self.y1 < o.y2) & (o.y1 < self.y2)

    def contains(self, o: Box) -> Column:
        return (self.x1 <= o.x1) & (self.x2 >= o.x2) & (self.y1 <= o.y1) & (self.y2 >= o.y2)

    def holds(self, x: Column, y: Column) -> Column:
        return (self.x1 <= x) & (self.x2 >= x) & (self.y1 <= y) & (self.y2 >= y)

    def meets_x(self, o: Box) -> Column:
        return (self.x1 <= o.x2) & (self.x2 >= o.x1)

    def meets_y(self, o: Box) -> Column:
        return (self.y1 <= o.y2) & (self.y2 >= o.y1)

    def beside(self, o: Box, right: bool = True) -> Column:
        """Whole-number rows in common and the other begins to the right (left)."""
        rows = F.greatest(self.y1.cast("int"), o.y1.cast("int")) < F.least(self.y2.cast("int"), o.y2.cast("int"))
        return rows & ((o.x1 > self.x1) if right else (o.x1 < self.x1))

    def gap_x(self, o: Box) -> Column:
        return F.greatest(o.x1 - self.x2, self.x1 - o.x2, F.lit(0.0))

    def gap_y(self, o: Box) -> Column:
        return F.greatest(o.y1 - self.y2, self.y1 - o.y2, F.lit(0.0))

    def diagonal_distance(self, o: Box) -> Column:
        """Distance from this box's first corner to the line through it and the other's diagonal; 0 without an extent."""
        a, b = o.x2 - o.x1, o.y2 - o.y1
        n = F.sqrt(a * a + b * b)
        return F.when(n == 0, 0.0).otherwise(F.abs(a * (self.y1 - o.y1) - (self.x1 - o.x1) * b) / n)

    def common_area(self, o: Box) -> Column:
        z = F.lit(0.0)
        return F.greatest(F.least(self.x2, o.x2) - F.greatest(self.x1, o.x1), z) * F.greatest(F.least(self.y2, o.y2) - F.greatest(self.y1, o.y1), z)

    def iou(self, o: Box) -> Column:
        i = self.common_area(o)
        return F.when(i <= 0, 0.0).otherwise(i / (self.area + o.area - i))

    def hull_iou(self, o: Box) -> Column:
        """Common area over the area of the hull."""
        return self.common_area(o) / self.union(o).area

    def giou(self, o: Box) -> Column:
        i, hull = self.common_area(o), self.union(o).area
        both = self.area + o.area - i
        return i / both - (hull - both) / hull

    def covered_share(self, o: Box) -> Column:
        """Share of this box's area inside the other."""
        return F.when(self.area > 0, self.common_area(o) / self.area).otherwise(0.0)

    def inside(self, o: Box, share: float = 0.95) -> Column:
        return self.covered_share(o) > share

    def centred(self) -> tuple[Column, Column, Column, Column]:
        """Centre, width and height."""
        return (*self.middle, self.width, self.height)

    @classmethod
    def from_centre(cls, cx: Column, cy: Column, w: Column, h: Column) -> Box:
        return cls(cx - w * 0.5, cy - h * 0.5, cx + w * 0.5, cy + h * 0.5)

    def thousandths(self, w: Column, h: Column) -> Column:
        """Integer coordinates from 0 to 1000 relative to a page."""
        f = lambda v, n: F.greatest(F.lit(0), F.least(F.lit(1000), (v / n * 1000).cast("int")))
        return F.array(f(self.x1, w), f(self.y1, h), f(self.x2, w), f(self.y2, h))


def overlap_1d(x1: Column, x2: Column, a1: Column, a2: Column, tolerance=0) -> Column:
    return (x1 <= a2 + tolerance) & (x2 >= a1 - tolerance)


def int_ranges_meet(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(a0.cast("int"), b0.cast("int")) < F.least(a1.cast("int"), b1.cast("int"))


def same_half(width: Column, a: Box, b: Box) -> Column:
    """Both middles on the same side of the page's middle."""
    return (a.middle[0] < width / 2) == (b.middle[0] < width / 2)


def polyline_box(points: Column) -> Box:
    """Hull of an array of (x, y) arrays; the unit box where there is none."""
    xs, ys = F.transform(points, lambda p: F.get(p, F.lit(0))), F.transform(points, lambda p: F.get(p, F.lit(1)))
    ok = F.array_min(xs).isNotNull() & F.array_min(ys).isNotNull()
    pick = lambda c, d: F.when(ok, c).otherwise(F.lit(d))
    return Box(pick(F.array_min(xs), 0.0), pick(F.array_min(ys), 0.0), pick(F.array_max(xs), 1.0), pick(F.array_max(ys), 1.0))


def hull() -> list[Column]:
    """Aggregates of a group's hull."""
    return [F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")]
