"""Page images as arrays: crops, halves, binarisation, connected components and text lines from them.

Images are rows of page_id, width, height and data (one byte per pixel, rows from the top). Pixels need numpy, so these
run in Arrow batches, an image at a time; everything after the components is box operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.cluster import merge_boxes

_IMAGE = "page_id long, width int, height int, data binary"


def _array(data: bytes, width: int, height: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(int(height), int(width))


def longest_side(width: Column, height: Column, most: int = 800) -> Column:
    """Width and height of an image scaled so that its longest side has ``most`` pixels."""
    f = most / F.greatest(width, height)
    return F.struct(F.round(width * f).cast("int").alias("width"), F.round(height * f).cast("int").alias("height"))


def snippets(images: DataFrame, boxes: DataFrame, pad: int = 0) -> DataFrame:
    """Crops (page_id, area_id, width, height, data) of boxes with padding, cut at the image's edges; empty ones are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                cut = _array(r.data, r.width, r.height)[max(0, int(r.y1) - pad) : max(0, int(r.y2) + pad), max(0, int(r.x1) - pad) : max(0, int(r.x2) + pad)]
                if cut.size:
                    out.append((r.page_id, r.area_id, cut.shape[1], cut.shape[0], cut.tobytes()))
            yield pd.DataFrame(out, columns=["page_id", "area_id", "width", "height", "data"])

    met = images.join(boxes.select("page_id", "area_id", "x1", "y1", "x2", "y2"), "page_id")
    return met.mapInPandas(run, "page_id long, area_id long, width int, height int, data binary")


def halves(images: DataFrame) -> DataFrame:
    """Left and right half of every image, numbered on: page n gives pages 2n and 2n + 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                a, m = _array(r.data, r.width, r.height), r.width // 2
                out += [(2 * r.page_id + k, x.shape[1], x.shape[0], x.tobytes()) for k, x in enumerate((a[:, :m], a[:, m:]))]
            yield pd.DataFrame(out, columns=["page_id", "width", "height", "data"])

    return images.select("page_id", "width", "height", "data").mapInPandas(run, _IMAGE)


def transposed(images: DataFrame) -> DataFrame:
    """Images turned by a quarter, as boxes are by ``Box.transposed``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(r.page_id, r.height, r.width, np.rot90(_array(r.data, r.width, r.height)).tobytes()) for r in batch.itertuples(index=False)]
            yield pd.DataFrame(out, columns=["page_id", "width", "height", "data"])

    return images.select("page_id", "width", "height", "data").mapInPandas(run, _IMAGE)


def ink(a: np.ndarray, window: int = 25, k: float = 0.2, spread: float = 128.0) -> np.ndarray:
    """Dark pixels by a local threshold: the mean of the window around, lowered where its spread is small."""
    p, r = np.pad(a.astype(float), window // 2 + 1, mode="reflect")[:, :], window // 2
    sums = [np.pad(x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (p, p * p)]
    h, w = a.shape
    box = lambda s: s[1 + 2 * r + 1 : 1 + 2 * r + 1 + h, 1 + 2 * r + 1 : 1 + 2 * r + 1 + w] - s[1 : 1 + h, 1 + 2 * r + 1 : 1 + 2 * r + 1 + w] - s[1 + 2 * r + 1 : 1 + 2 * r + 1 + h, 1 : 1 + w] + s[1 : 1 + h, 1 : 1 + w]
    n = (2 * r + 1) ** 2
    mean = box(sums[0]) / n
    dev = np.sqrt(np.maximum(0, box(sums[1]) / n - mean * mean))
    return a <= mean * (1 + k * (dev / spread - 1))


def label(mask: np.ndarray) -> np.ndarray:
    """Numbers of the components of a mask, diagonal neighbours included, from runs of its rows; 0 is the background."""
    out = np.zeros(mask.shape, np.int64)
    root = [0]

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    before: list[tuple[int, int, int]] = []
    for y, row in enumerate(mask):
        edge = np.flatnonzero(np.diff(np.r_[0, row.astype(np.int8), 0]))
        now, k = [], 0
        for a, b in zip(edge[::2], edge[1::2]):
            n = 0
            while k < len(before) and before[k][1] < a:
                k += 1
            j = k
            while j < len(before) and before[j][0] <= b:
                m = find(before[j][2])
                n = min(n, m) if n else m
                j += 1
            if not n:
                n = len(root)
                root.append(n)
            for i in range(k, j):
                root[find(before[i][2])] = n
            now.append((a, b, n))
            out[y, a:b] = n
        before = now
    final = np.array([find(i) for i in range(len(root))])
    return np.unique(final[out], return_inverse=True)[1].reshape(mask.shape)


def mask_boxes(masks: np.ndarray) -> np.ndarray:
    """Boxes (x1, y1, x2, y2) of a stack of masks; zeros for an empty one."""
    out = np.zeros((len(masks), 4))
    for i, m in enumerate(masks):
        y, x = np.nonzero(m)
        if len(x):
            out[i] = x.min(), y.min(), x.max(), y.max()
    return out


def components(images: DataFrame, least: int = 3, most: int = 100) -> DataFrame:
    """Boxes of an image's dark components: ``Character``, or ``DrawnLine`` for those over ``most`` pixels on a side; under ``least`` on both none."""
    schema = "page_id long, area_id long, category string, x1 double, y1 double, x2 double, y2 double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                n = label(ink(_array(r.data, r.width, r.height)))
                y, x = np.nonzero(n)
                k = n[y, x]
                order = np.argsort(k, kind="stable")
                begin = np.flatnonzero(np.r_[True, np.diff(k[order]) > 0]) if len(k) else np.zeros(0, int)
                edge = [f(v[order], begin) if len(begin) else np.zeros(0) for f, v in ((np.minimum.reduceat, x), (np.minimum.reduceat, y), (np.maximum.reduceat, x), (np.maximum.reduceat, y))]
                out += [(r.page_id, i, *map(float, b)) for i, b in enumerate(zip(*edge))]
            yield pd.DataFrame(out, columns=["page_id", "area_id", "x1", "y1", "x2", "y2"])

    boxes = images.mapInPandas(run, "page_id long, area_id long, x1 double, y1 double, x2 double, y2 double")
    side = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    kind = F.when(side > most, "DrawnLine").when(side >= least, "Character")
    return boxes.withColumn("category", kind).where("category IS NOT NULL").select(*[c.split()[0] for c in schema.split(", ")])


def text_lines(characters: DataFrame, word_gap: float = 16.0, line_gap: float = 24.0) -> dict[str, DataFrame]:
    """Words and lines of characters: merged by horizontal gaps, no hull over twice the median height of the page."""
    tall = characters.groupBy("page_id").agg(F.median(F.col("y2") - F.col("y1")).alias("h"))
    small = characters.join(tall, "page_id").where(F.col("y2") - F.col("y1") <= 2 * F.col("h")).drop("h")
    words = merge_boxes(small, word_gap, 0.0).withColumn("area_id", F.col("group_id"))
    return {"words": words, "lines": merge_boxes(words, line_gap, 0.0)}


def ocr_lines(rows: DataFrame) -> DataFrame:
    """Text lines of recogniser rows (page, block, par, line, word_no, conf, text, box): confident non-blank words, joined in order."""
    own = rows.where((F.col("conf") >= 0) & (F.trim("text") != "") & (F.lower("text") != "nan"))
    words = F.transform(F.sort_array(F.collect_list(F.struct("word_no", "text"))), lambda x: x["text"])
    return own.groupBy("page", "block", "par", "line").agg(F.array_join(words, " ").alias("content"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.avg("conf").alias("conf"))


def ruled_lines(images: DataFrame, least: int = 200, gap: int = 10, thick: int = 8) -> DataFrame:
    """Horizontal and vertical ruled lines of images (page_id, area_id, box): runs of dark pixels, breaks up to ``gap`` closed,
    of at least ``least`` pixels; neighbouring runs that overlap are one line, up to ``thick`` pixels."""

    def runs(mask: np.ndarray) -> list[tuple[int, int, int]]:
        out = []
        for y, row in enumerate(mask):
            edge = np.flatnonzero(np.diff(np.r_[0, row.astype(np.int8), 0]))
            a, b = edge[::2], edge[1::2]
            if len(a):
                new = np.r_[True, a[1:] - b[:-1] > gap]
                first, last = a[new], b[np.r_[np.flatnonzero(new)[1:] - 1, len(b) - 1]]
                out += [(y, int(x), int(z)) for x, z in zip(first, last) if z - x >= least]
        return out

    def joined(found: list[tuple[int, int, int]]) -> list[list[int]]:
        lines: list[list[int]] = []
        for y, a, b in found:
            near = next((k for k in lines if k[3] == y - 1 and k[0] < b and a < k[1] and y - k[2] < thick), None)
            if near:
                near[:] = [min(near[0], a), max(near[1], b), near[2], y]
            else:
                lines.append([a, b, y, y])
        return lines

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                mask = ink(_array(r.data, r.width, r.height))
                boxes = [(a, y, b, z + 1) for a, b, y, z in joined(runs(mask))] + [(y, a, z + 1, b) for a, b, y, z in joined(runs(mask.T))]
                out += [(r.page_id, i, *map(float, b)) for i, b in enumerate(boxes)]
            yield pd.DataFrame(out, columns=["page_id", "area_id", "x1", "y1", "x2", "y2"])

    return images.mapInPandas(run, "page_id long, area_id long, x1 double, y1 double, x2 double, y2 double")


def masked(images: DataFrame, boxes: DataFrame, thickness: int = 2, shade: int = 0) -> DataFrame:
    """Images with the outlines of their boxes drawn in; images without boxes stay as they are."""
    lists = boxes.groupBy("page_id").agg(*[F.collect_list(F.col(c).cast("int")).alias(c) for c in ("x1", "y1", "x2", "y2")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                a = _array(r.data, r.width, r.height).copy()
                for x1, y1, x2, y2 in zip(*(v if v is not None else [] for v in (r.x1, r.y1, r.x2, r.y2))):
                    x1, y1 = max(0, x1), max(0, y1)
                    for part in (a[y1 : y1 + thickness, x1:x2], a[max(0, y2 - thickness) : y2, x1:x2], a[y1:y2, x1 : x1 + thickness], a[y1:y2, max(0, x2 - thickness) : x2]):
                        part[:] = shade
                out.append((r.page_id, r.width, r.height, a.tobytes()))
            yield pd.DataFrame(out, columns=["page_id", "width", "height", "data"])

    return images.join(lists, "page_id", "left").select("page_id", "width", "height", "data", "x1", "y1", "x2", "y2").mapInPandas(run, _IMAGE)


def portable(images: DataFrame) -> DataFrame:
    """Images as files in the portable grey format: page_id and content."""
    head = F.concat(F.lit("P5 "), F.col("width").cast("string"), F.lit(" "), F.col("height").cast("string"), F.lit(" 255\n"))
    return images.select("page_id", F.concat(F.encode(head, "UTF-8"), F.col("data")).alias("content"))
