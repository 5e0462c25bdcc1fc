"""Masks of image segments as intervals: runs (image_id, segment_id, x, y1, y2) down the columns of an image, y2 behind the last pixel.

Polygons, run lengths and coloured images all become such runs; areas are sums over them and common pixels of two masks are
sums over overlaps of intervals in one column, so no pixel is made on the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .cluster import _near
from .evaluation import panoptic_quality, quality_of_counts

_KEYS = ("image_id", "segment_id")


def merged(runs: DataFrame, *more: str) -> DataFrame:
    """Runs of one segment in a column that overlap or touch as one."""
    by = [*_KEYS, *more, "x"]
    w = Window.partitionBy(*by).orderBy("y1", "y2")
    reach = F.max("y2").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("_new", F.when(reach.isNull() | (F.col("y1") > reach), 1).otherwise(0))
    marked = marked.withColumn("_n", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*by, "_n").agg(F.min("y1").alias("y1"), F.max("y2").alias("y2")).select(*by, "y1", "y2")


#: Cuts of columns that are looked at together; the columns of one polygon always are.
_CUTS = 1 << 15


def _numbers(column: pa.Array) -> np.ndarray:
    """Numbers of a column; what is null is no number."""
    return pc.cast(column, pa.float64()).to_numpy(zero_copy_only=False)


def _corners(points: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of points of each row, and x and y of them all."""
    n = pc.fill_null(pc.list_value_length(points), 0).to_numpy().astype(np.int64)
    flat = pc.list_flatten(points)
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return n, _numbers(pc.struct_field(flat, "x")), _numbers(pc.struct_field(flat, "y"))


def _spans(n: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each of the numbers, one after the other."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _again(*columns: np.ndarray) -> np.ndarray:
    """Whether a row is like the one before it."""
    same = np.ones(max(len(columns[0]) - 1, 0), bool)
    for c in columns:
        same &= c[1:] == c[:-1]
    return np.r_[False, same][: len(columns[0])]


def _united(segment: np.ndarray, x: np.ndarray, y1: np.ndarray, y2: np.ndarray, sort: bool = True) -> tuple[np.ndarray, ...]:
    """Runs by segment, column and begin; those of one column that overlap or touch as one."""
    if sort:
        order = np.lexsort((y1, x, segment))
        segment, x, y1, y2 = (c[order] for c in (segment, x, y1, y2))
    again = _again(segment, x)
    if not again.any():
        return segment, x, y1, y2
    # ends of earlier columns lie below those of later ones, so one running maximum serves all
    low = int(y1.min())
    lift = (np.cumsum(~again) - 1) * (int(y2.max()) - low + 1) - low
    reach = np.maximum.accumulate(y2 + lift)
    new = np.flatnonzero(~again | (y1 + lift > np.r_[0, reach[:-1]]))
    end = reach[np.r_[new[1:], len(x)] - 1] - lift[new]
    return segment[new], x[new], y1[new], end


def _sorted(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Whole numbers in rows, sorted; as one number each where that holds them."""
    low = [int(c.min()) for c in columns]
    bits = [(int(c.max()) - a).bit_length() for c, a in zip(columns, low)]
    if sum(bits) > 62:
        order = np.lexsort(columns[::-1])
        return tuple(c[order] for c in columns)
    code = columns[0] - low[0]
    for c, a, n in zip(columns[1:], low[1:], bits[1:]):
        code = (code << n) + (c - a)
    code.sort()
    out = []
    for a, n in list(zip(low, bits))[:0:-1]:
        out.append((code & ((1 << n) - 1)) + a)
        code = code >> n
    return code + low[0], *out[::-1]


def _polygon_runs(n: np.ndarray, x: np.ndarray, y: np.ndarray, segment: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs (segment, x, y1, y2) of polygons with so many points each, ``n``, and the points' ``x`` and ``y``; ``segment`` numbers the polygons' segments and does not fall. Some segments at a time.

    A pixel is inside if its middle is, by the even-odd rule: every column of middles is cut by a polygon's edges, and the cuts are
    taken in pairs. A middle on a left or upper edge is inside, on a right or lower edge outside.
    """
    ring = np.repeat(np.arange(len(n)), n)
    last = np.cumsum(n)[n > 0] - 1
    to = np.arange(1, len(x) + 1)
    to[last] = last + 1 - n[n > 0]
    # columns whose middle lies in [low, high)
    lo, hi = np.ceil(np.fmin(x, x[to]) - 0.5), np.ceil(np.fmax(x, x[to]) - 0.5)
    kept = np.flatnonzero(lo < hi)
    ring, xa, ya, dx, dy = ring[kept], x[kept], y[kept], (x[to] - x)[kept], (y[to] - y)[kept]
    lo, wide = lo[kept].astype(np.int64), (hi - lo)[kept].astype(np.int64)
    upto, own, at, parts = np.cumsum(wide), segment[ring], 0, bool(_again(segment).any())
    while at < len(ring):
        to = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + _CUTS, "right"))
        # whole segments
        to = int(np.searchsorted(own, own[max(to, at + 1) - 1], "right")) if to < len(own) else to
        w = wide[at:to]
        e = np.repeat(np.arange(at, to), w)
        column = lo[e] + _spans(w)
        cut = np.ceil(np.round(ya[e] + (column + 0.5 - xa[e]) * dy[e] / dx[e] - 0.5, 9))
        r, known = ring[e], np.isfinite(cut)
        if not known.all():
            r, column, cut = r[known], column[known], cut[known]
        at = to
        if len(r):
            r, column, cut = _sorted(r, column, cut.astype(np.int64))
            # cuts of a column in pairs
            begin = np.flatnonzero(~_again(r, column))
            place = np.arange(len(r)) - np.repeat(begin, np.diff(np.r_[begin, len(r)]))
            first = np.flatnonzero((place[:-1] & 1 == 0) & (place[1:] & 1 == 1) & (cut[:-1] < cut[1:]))
            yield _united(segment[r[first]], column[first], cut[first], cut[first + 1], parts)


def _gathered(polygons: DataFrame, one_part: bool, *more: str) -> DataFrame:
    """One row for each segment: ``rings``, the points of its parts."""
    rings = polygons.where(F.size("points") > 2)
    if one_part:
        return rings.select(*_KEYS, *more, F.array("points").alias("rings"))
    return rings.groupBy(*_KEYS, *more).agg(F.collect_list("points").alias("rings"))


def _rasterised(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """``_polygon_runs`` of rows with ``rings``; a segment is numbered by its row."""
    rings = table["rings"]
    rings = rings.combine_chunks() if isinstance(rings, pa.ChunkedArray) else rings
    parts = pc.list_value_length(rings).to_numpy()
    yield from _polygon_runs(*_corners(pc.list_flatten(rings)), np.repeat(np.arange(len(parts)), parts))


def _typed(df: DataFrame, *names: str) -> str:
    return ", ".join(f"{c} {dict(df.dtypes)[c]}" for c in names)


def polygon_runs(polygons: DataFrame, one_part: bool = False) -> DataFrame:
    """Runs of polygons (image_id, segment_id, part, points as an array of (x, y)); parts of one segment are united, so no runs overlap.

    Columns are cut where the segment's row is, many segments at a time. Where every segment is known to have one polygon (``one_part``), rows are taken as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, x, y1, y2 in _rasterised(batch):
                yield pa.RecordBatch.from_arrays([*(batch[k].take(pa.array(segment)) for k in _KEYS), *map(pa.array, (x, y1, y2))], [*_KEYS, "x", "y1", "y2"])

    rows = _gathered(polygons, one_part)
    return rows.mapInArrow(run, _typed(rows, *_KEYS) + ", x long, y1 long, y2 long")


def polygon_areas(polygons: DataFrame, one_part: bool = False) -> DataFrame:
    """``areas`` of polygons; their runs are summed where they are made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, x, y1, y2 in _rasterised(batch):
                if len(segment):
                    new = np.flatnonzero(~_again(segment))
                    end = np.r_[new[1:], len(x)] - 1
                    # runs are in the order of their columns
                    sums = np.add.reduceat(y2 - y1, new), x[new], np.minimum.reduceat(y1, new), x[end], np.maximum.reduceat(y2, new) - 1
                    yield pa.RecordBatch.from_arrays([*(batch[k].take(pa.array(segment[new])) for k in _KEYS), *map(pa.array, sums)], [*_KEYS, "pixels", "x1", "y1", "x2", "y2"])

    rows = _gathered(polygons, one_part)
    return rows.mapInArrow(run, _typed(rows, *_KEYS) + ", pixels long, x1 long, y1 long, x2 long, y2 long")


def _shared(row: np.ndarray, x: np.ndarray, y1: np.ndarray, y2: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pixels of each mask of one image, and (own, true, pixels) of the masks that share some; ``row`` numbers the masks, whose runs come in order, ``real`` tells which are true.

    Masks whose boxes meet are compared column by column: what a mask has in a column is looked up by the column's place.
    """
    size = np.bincount(row, y2 - y1, len(real)).astype(np.int64)
    new = np.flatnonzero(~_again(row))
    if not len(new):
        return size, *[np.zeros(0, np.int64)] * 3
    some, first, last = row[new], x[new], x[np.r_[new[1:], len(x)] - 1]
    box = np.stack([first, np.minimum.reduceat(y1, new), last, np.maximum.reduceat(y2, new) - 1], 1)
    base = np.cumsum(last - first + 1) - (last - first + 1) - first  # place of a mask's column 0
    begin = np.r_[0, np.cumsum(np.bincount(np.repeat(base, np.diff(np.r_[new, len(x)])) + x, minlength=int(base[-1] + last[-1]) + 1))]
    pairs = _near(box, 0, 0)
    turned = real[some[pairs[:, 0]]]
    own, true = np.where(turned, pairs[:, 1], pairs[:, 0]), np.where(turned, pairs[:, 0], pairs[:, 1])
    met = ~real[some[own]] & real[some[true]]
    own, true = own[met], true[met]
    low, pixels = np.maximum(first[own], first[true]), np.zeros(len(own), np.int64)
    wide = np.minimum(last[own], last[true]) - low + 1
    upto, at = np.cumsum(wide), 0
    while at < len(own):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + _CUTS, "right")))
        k = np.repeat(np.arange(at, to), wide[at:to])
        column = low[k] + _spans(wide[at:to])
        i, j = base[own[k]] + column, base[true[k]] + column
        n = begin[j + 1] - begin[j]
        # every run of one with every run of the other
        each = (begin[i + 1] - begin[i]) * n
        k, i, j, n, place = np.repeat(k, each), np.repeat(begin[i], each), np.repeat(begin[j], each), np.repeat(n, each), _spans(each)
        i, j = i + place // n, j + place % n
        pixels[at:to] = np.bincount(k - at, np.maximum(np.minimum(y2[i], y2[j]) - np.maximum(y1[i], y1[j]), 0), to - at)
        at = to
    own, true, pixels = own[pixels > 0], true[pixels > 0], pixels[pixels > 0]
    return size, some[own], some[true], pixels


def _polygons_shared(image: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    runs = [np.concatenate(c) for c in zip(*_rasterised(image))] or [np.zeros(0, np.int64)] * 4
    return _shared(*runs, image["real"].to_numpy().astype(bool))


def polygon_overlap(polygons: DataFrame, one_part: bool = False) -> DataFrame:
    """``overlap`` of polygons (image_id, segment_id, part, real, points), true ones where ``real``; an image is done where its polygons are."""

    def run(image: pa.Table) -> pa.Table:
        size, own, true, pixels = _polygons_shared(image)
        ids = image["segment_id"]
        columns = [image["image_id"].take(pa.array(own)), ids.take(pa.array(own)), ids.take(pa.array(true)), *map(pa.array, (pixels, pixels / (size[own] + size[true] - pixels)))]
        return pa.table(columns, names=["image_id", "segment_id", "true_id", "pixels", "iou"])

    types = dict(polygons.dtypes)
    return _gathered(polygons, one_part, "real").groupBy("image_id").applyInArrow(run, _typed(polygons, *_KEYS) + f", true_id {types['segment_id']}, pixels long, iou double")


def polygon_quality(polygons: DataFrame, one_part: bool = False) -> DataFrame:
    """``mask_quality`` of polygons (image_id, segment_id, part, category, real, points), true ones where ``real``; only counts of each category leave an image."""

    def run(image: pa.Table) -> pa.Table:
        size, own, true, pixels = _polygons_shared(image)
        names = image["category"].combine_chunks().dictionary_encode()
        code, real = pc.fill_null(names.indices, len(names.dictionary)).to_numpy(), image["real"].to_numpy().astype(bool)
        iou = pixels / (size[own] + size[true] - pixels)
        hit = (code[own] == code[true]) & (code[own] < len(names.dictionary)) & (iou > 0.5)
        n = lambda rows, weights=None: np.bincount(code[rows], weights, len(names.dictionary) + 1)
        category = pa.concat_arrays([names.dictionary, pa.nulls(1, names.dictionary.type)])
        columns = n(~real & (size > 0)), n(real & (size > 0)), n(own[hit]), n(own[hit], iou[hit]).astype(float)
        return pa.table([category, *map(pa.array, columns)], names=["category", "found", "real", "tp", "iou"])

    rows = _gathered(polygons, one_part, "category", "real")
    counts = rows.groupBy("image_id").applyInArrow(run, _typed(polygons, "category") + ", found long, real long, tp long, iou double")
    return quality_of_counts(counts.groupBy("category").agg(*[F.sum(c).alias(c) for c in ("found", "real", "tp", "iou")]).where("found + real > 0"))


def counted_runs(masks: DataFrame) -> DataFrame:
    """Runs of run-length masks (image_id, segment_id, height, counts): lengths of background and mask in turn, column by column."""
    each = masks.select(*_KEYS, "height", F.posexplode("counts").alias("k", "n"))
    w = Window.partitionBy(*_KEYS).orderBy("k")
    spans = each.withColumn("b", F.sum("n").over(w)).withColumn("a", F.col("b") - F.col("n")).where("k % 2 = 1 AND n > 0")
    h = F.col("height")
    columns = spans.withColumn("x", F.explode(F.sequence(F.floor(F.col("a") / h), F.floor((F.col("b") - 1) / h))))
    return merged(columns.select(*_KEYS, F.col("x").cast("long").alias("x"), F.greatest(F.col("a") - F.col("x") * h, F.lit(0)).cast("long").alias("y1"), F.least(F.col("b") - F.col("x") * h, h).cast("long").alias("y2")))


def run_counts(runs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Run-length masks (image_id, segment_id, height, width, counts) of runs; ``sizes``: image_id, width, height."""
    placed = merged(runs).join(sizes, "image_id").select(*_KEYS, "width", "height", (F.col("x") * F.col("height") + F.col("y1")).alias("a"), (F.col("x") * F.col("height") + F.col("y2")).alias("b"))
    w = Window.partitionBy(*_KEYS).orderBy("a")
    reach = F.lag("b").over(w)
    parts = placed.withColumn("_n", F.sum(F.when(reach.isNull() | (F.col("a") > reach), 1).otherwise(0)).over(w)).groupBy(*_KEYS, "width", "height", "_n").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    told = parts.withColumn("gap", F.col("a") - F.coalesce(F.lag("b").over(w), F.lit(0)))
    lists = told.groupBy(*_KEYS, "width", "height").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("a", "gap", "b"))), lambda r: F.array(r["gap"], r["b"] - r["a"]))).alias("counts"), F.max("b").alias("end"))
    rest = F.col("width") * F.col("height") - F.col("end")
    return lists.select(*_KEYS, "height", "width", F.when(rest > 0, F.concat("counts", F.array(rest))).otherwise(F.col("counts")).alias("counts"))


def coloured_runs(images: DataFrame) -> DataFrame:
    """Runs of images (image_id, width, height, data of three bytes a pixel: red, green, blue) whose colours number the segments."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                a = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, 3).astype(np.int64)
                ids = (a[:, :, 0] + (a[:, :, 1] << 8) + (a[:, :, 2] << 16)).T  # columns first
                flat = ids.ravel()
                begin = np.flatnonzero(np.r_[True, (flat[1:] != flat[:-1]) | (np.arange(1, len(flat)) % r.height == 0)]) if len(flat) else np.zeros(0, np.int64)
                end = np.r_[begin[1:], len(flat)] if len(flat) else begin
                x = begin // max(r.height, 1)
                yield pd.DataFrame({"image_id": r.image_id, "segment_id": flat[begin], "x": x, "y1": begin - x * r.height, "y2": end - x * r.height})

    return images.select("image_id", "width", "height", "data").mapInPandas(run, "image_id long, segment_id long, x long, y1 long, y2 long")


def read_panoptic(spark: SparkSession, path: str, pictures: DataFrame) -> DataFrame:
    """Segments (image_id, segment_id, category, iscrowd, file_name) of an annotation file, for images (``pictures``: file_name without its ending) that are there."""
    schema = "annotations ARRAY<STRUCT<image_id: LONG, file_name: STRING, segments_info: ARRAY<STRUCT<id: LONG, category_id: LONG, iscrowd: INT>>>>, categories ARRAY<STRUCT<id: LONG, name: STRING>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    segments = raw.select(F.explode("annotations").alias("a")).select("a.image_id", F.regexp_replace("a.file_name", r"\.[^.]*$", "").alias("file_name"), F.explode("a.segments_info").alias("s"))
    names = raw.select(F.explode("categories").alias("c")).select(F.col("c.id").alias("category_id"), F.col("c.name").alias("category"))
    told = segments.select("image_id", F.col("s.id").alias("segment_id"), F.col("s.category_id").alias("category_id"), F.coalesce("s.iscrowd", F.lit(0)).alias("iscrowd"), "file_name")
    return told.join(names, "category_id", "left").join(pictures.select("file_name").distinct(), "file_name", "left_semi").select("image_id", "segment_id", "category", "iscrowd", "file_name")


def areas(runs: DataFrame) -> DataFrame:
    """Pixels and box (last pixel included) of every segment."""
    return merged(runs).groupBy(*_KEYS).agg(F.sum(F.col("y2") - F.col("y1")).alias("pixels"), F.min("x").alias("x1"), F.min("y1").alias("y1"), F.max("x").alias("x2"), (F.max("y2") - 1).alias("y2"))


def common(runs: DataFrame, truth: DataFrame) -> DataFrame:
    """(image_id, segment_id, true_id, pixels): pixels that two masks of an image share; pairs without any are left out."""
    a = merged(runs)
    b = merged(truth).select("image_id", F.col("segment_id").alias("true_id"), "x", F.col("y1").alias("a"), F.col("y2").alias("b"))
    met = a.join(b, ["image_id", "x"]).where("y1 < b AND a < y2")
    return met.groupBy("image_id", "segment_id", "true_id").agg(F.sum(F.least("y2", "b") - F.greatest("y1", "a")).alias("pixels"))


def overlap(runs: DataFrame, truth: DataFrame, crowds: DataFrame | None = None) -> DataFrame:
    """``common`` with the share of both masks together (``iou``); for a true segment among ``crowds`` (image_id, true_id), the share of the found one alone."""
    own, real = areas(runs).select(*_KEYS, F.col("pixels").alias("own")), areas(truth).select("image_id", F.col("segment_id").alias("true_id"), F.col("pixels").alias("real"))
    met = common(runs, truth).join(own, list(_KEYS)).join(real, ["image_id", "true_id"])
    crowd = F.lit(False)
    if crowds is not None:
        met, crowd = met.join(crowds.select("image_id", "true_id", F.lit(True).alias("_crowd")), ["image_id", "true_id"], "left"), F.coalesce("_crowd", F.lit(False))
    share = F.when(crowd, F.col("pixels") / F.col("own")).otherwise(F.col("pixels") / (F.col("own") + F.col("real") - F.col("pixels")))
    return met.select("image_id", "segment_id", "true_id", "pixels", share.alias("iou"))


def mask_quality(runs: DataFrame, truth: DataFrame, found: DataFrame, real: DataFrame) -> DataFrame:
    """Panoptic quality from the masks; ``found`` and ``real`` name the category of each segment (image_id, segment_id, category)."""
    sized = lambda names, r: names.select(*_KEYS, "category").join(areas(r).select(*_KEYS, "pixels"), list(_KEYS))
    return panoptic_quality(sized(found, runs), sized(real, truth), common(runs, truth))
