"""Ink, lines, paragraphs and masks against pixels."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.operators import density, masks, raster
from docloom.plans import raster_queries
from docloom.plans.fixtures import boxes
from docloom.sources.images import label

rng = random.Random(5)


def runs_of(spark, grids: dict[int, np.ndarray]):
    rows = []
    for page, g in grids.items():
        for y, row in enumerate(g):
            edge = np.flatnonzero(np.diff(np.r_[0, row.astype(int), 0]))
            rows += [(page, y, int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])]
    return spark.createDataFrame(rows, "page_id long, y long, x1 long, x2 long")


def grid_of(runs, page, shape, off=0):
    out = np.zeros(shape, bool)
    for r in runs:
        if r.page_id == page:
            out[r.y + off, r.x1 + off : r.x2 + off] = True
    return out


def sums(g, across, down):
    """Ink in the window around every pixel, the margin of the window included."""
    h, w = g.shape
    wide = np.pad(g.astype(int), ((2 * down, 2 * down), (2 * across, 2 * across)))
    return np.array([[wide[y : y + 2 * down + 1, x : x + 2 * across + 1].sum() for x in range(w + 2 * across)] for y in range(h + 2 * down)])


@pytest.mark.parametrize("across,down,least", [(3, 1, 1), (3, 1, 6), (0, 0, 1), (5, 2, 20), (2, 2, 25)])
def test_window_sums(spark, across, down, least):
    grids = {k: np.random.default_rng(k).random((17, 31)) < p for k, p in enumerate((0.1, 0.5, 0.9, 0.0, 1.0))}
    runs = runs_of(spark, grids)
    got = raster.blurred(runs.unionByName(runs), across, down, least).collect()
    grown = raster.dilated(runs, across, down).collect()
    for k, g in grids.items():
        want = sums(g, across, down)
        place = lambda found: np.array([[any(r.page_id == k and r.y == y - down and r.x1 <= x - across < r.x2 for r in found[y - down]) for x in range(want.shape[1])] for y in range(want.shape[0])])
        by_row = lambda rows: {y: [r for r in rows if r.y == y] for y in range(-down, g.shape[0] + down)}
        assert (place(by_row(got)) == (want >= least)).all() and (place(by_row(grown)) == (want >= 1)).all()


def test_components_of_runs(spark):
    grids = {k: np.random.default_rng(k + 9).random((40, 50)) < p for k, p in enumerate((0.15, 0.3, 0.45))}
    spiral = np.zeros((41, 41), bool)
    for k in range(0, 20, 2):
        spiral[k, k : 41 - k] = spiral[k : 41 - k, 40 - k] = spiral[40 - k, k : 41 - k] = True
        spiral[k + 2 : 41 - k, k] = True
    grids[7] = spiral
    got = raster.run_components(runs_of(spark, grids)).collect()
    for k, g in grids.items():
        marks = label(g)
        want = sorted((int(x.min()), int(y.min()), int(x.max()), int(y.max()), len(x)) for m in range(1, marks.max() + 1) for y, x in [np.nonzero(marks == m)])
        assert sorted((r.x1, r.y1, r.x2, r.y2, r.pixels) for r in got if r.page_id == k) == want


def test_paragraphs_of_whole_pages(spark, sf):
    runs = raster_queries._text_runs(spark, sf).collect()
    got = raster_queries.paragraph_boxes(spark, sf).where("page_id < 6").collect()
    for page in range(6):
        g = grid_of(runs, page, (900, 720), 20)
        c = np.pad(g.astype(int), ((1, 0), (1, 0))).cumsum(0).cumsum(1)
        window = lambda h, w, s: s[2 * h + 1 :, 2 * w + 1 :] - s[: -2 * h - 1, 2 * w + 1 :] - s[2 * h + 1 :, : -2 * w - 1] + s[: -2 * h - 1, : -2 * w - 1]
        dark = np.zeros_like(g)
        dark[3:-3, 10:-10] = window(3, 10, c) >= round(0.3 * 21 * 7)
        c = np.pad(dark.astype(int), ((1, 0), (1, 0))).cumsum(0).cumsum(1)
        grown = np.zeros_like(g)
        grown[4:-4, 4:-4] = window(4, 4, c) > 0
        marks = label(grown)
        want = sorted((int(x.min()) - 20, int(y.min()) - 20, int(x.max()) - 20, int(y.max()) - 20, len(x)) for m in range(1, marks.max() + 1) for y, x in [np.nonzero(marks == m)])
        assert sorted((r.x1, r.y1, r.x2, r.y2, r.pixels) for r in got if r.page_id == page) == want


def test_density_clusters(spark):
    points = [(p, i, rng.gauss(50, 25), rng.gauss(50, 25)) for p in range(3) for i in range(90)] + [(3, 0, 1.0, 1.0), (3, 1, 1.0, 1.0), (3, 2, -9.0, 1.0)]
    got = {(r.page_id, r.point_id): (r.core, r.cluster) for r in density.density_clusters(spark.createDataFrame(points, "page_id long, point_id long, x double, y double"), 6.0, 4).collect()}
    for p in range(4):
        own = [(i, x, y) for q, i, x, y in points if q == p]
        near = {i: [j for j, u, v in own if (x - u) ** 2 + (y - v) ** 2 <= 36] for i, x, y in own}
        core = {i for i in near if len(near[i]) >= 4}
        root = {i: i for i in core}
        for _ in core:
            for i in core:
                root[i] = min(root[j] for j in near[i] if j in core)
        for i, _, _ in own:
            assert got[p, i] == (i in core, root[i] if i in core else min((root[j] for j in near[i] if j in core), default=None))


def test_line_clusters_pixel_by_pixel(spark, sf):
    """Every page: density clusters of all pixels, and the regression through them."""
    lines = boxes(spark, sf).where("category = 'DrawnLine'").toPandas()
    got = raster_queries.line_clusters(spark, sf).toPandas()
    assert len(lines) > 300
    for page, own in list(lines.groupby("page_id"))[:8]:
        for upright in (False, True):
            part = [(int(r.area_id), int(r.x1), int(r.y1), int(r.x2), int(r.y2)) for r in own.itertuples() if (int(r.y2) - int(r.y1) > int(r.x2) - int(r.x1)) == upright]
            pixels = {a: np.array([(x, y) for x in range(x1, x2 + 1) for y in range(y1, y2 + 1)]) for a, x1, y1, x2, y2 in part}
            root = {a: a for a in pixels}
            near = {a: [b for b in pixels if min(((pixels[a][:, None] - pixels[b][None]) ** 2).sum(2).min(1)) <= 25] for a in pixels}
            for _ in pixels:
                for a in pixels:
                    root[a] = min(root[b] for b in near[a])
            for g in set(root.values()):
                xy = np.concatenate([pixels[a] for a in pixels if root[a] == g])
                u, v = (xy[:, 1], xy[:, 0]) if upright else (xy[:, 0], xy[:, 1])
                slope, intercept = np.polyfit(u, v, 1) if len(set(u)) > 1 else (0.0, v.mean())
                r = got[(got.page_id == page) & (got.group_id == g)].iloc[0]
                assert bool(r.upright) == upright and abs(r.slope - slope) < 1e-5 and abs(r.intercept - intercept) < 1e-3 and r.n == sum(x == g for x in root.values())


def test_slanted_lines(spark):
    """Lines at many angles, one with a gap and one too short, and noise."""
    drawn = [(10, 10, 300, 60), (20, 300, 280, 90), (150, 5, 160, 310), (5, 200, 310, 200), (40, 20, 40, 250)]
    points = {(round(x1 + (x2 - x1) * k / 600), round(y1 + (y2 - y1) * k / 600)) for x1, y1, x2, y2 in drawn for k in range(601)}
    points |= {(200 + k, 250 + k) for k in range(30)} | {(rng.randint(0, 320), rng.randint(0, 320)) for _ in range(150)}
    points -= {(x, 200) for x in range(100, 105)}
    got = raster.straight_lines(spark.createDataFrame([(1, x, y) for x, y in points], "page_id long, x long, y long"), 180, 30, 120.0, 12.0).collect()
    ends = {(r.x1, r.y1, r.x2, r.y2) for r in got}
    for x1, y1, x2, y2 in drawn:
        assert any(abs(a - x1) + abs(b - y1) <= 14 and abs(c - x2) + abs(e - y2) <= 14 or abs(c - x1) + abs(e - y1) <= 14 and abs(a - x2) + abs(b - y2) <= 14 for a, b, c, e in ends), (x1, y1, x2, y2, ends)
    assert len(ends) <= 2 * len(drawn)


def inside(points, x, y):
    """Even-odd rule at a pixel's middle."""
    hit = False
    for (xa, ya), (xb, yb) in zip(points, points[1:] + points[:1]):
        if (xa <= x) != (xb <= x) and y >= ya + (x - xa) * (yb - ya) / (xb - xa):
            hit = not hit
    return hit


def test_polygons(spark):
    shapes = {(1, k, 0): [(rng.randint(0, 120) / 4, rng.randint(0, 120) / 4) for _ in range(rng.randint(3, 8))] for k in range(30)}
    shapes |= {(1, 40, 0): [(0, 0), (4, 0), (4, 4), (0, 4)], (1, 40, 1): [(2, 2), (9, 2), (9, 5), (2, 5)], (1, 41, 0): [(1, 1), (2, 2)], (1, 42, 0): [(3, 3), (3, 9), (3, 5)]}
    df = spark.createDataFrame([(*k, [{"x": float(x), "y": float(y)} for x, y in p]) for k, p in shapes.items()], "image_id long, segment_id long, part int, points array<struct<x double, y double>>".replace("x double, y double", "x:double,y:double"))
    runs = masks.polygon_runs(df)
    got = {(r.segment_id, r.x, y) for r in runs.collect() for y in range(r.y1, r.y2)}
    want = {(k, x, y) for (_, k, _), p in shapes.items() if len(p) > 2 for x in range(-1, 32) for y in range(-1, 32) if inside(p, x + 0.5, y + 0.5)}
    assert got == want
    sizes = spark.createDataFrame([(1, 33, 31)], "image_id long, width long, height long")
    counted = masks.run_counts(runs.where("y1 >= 0 AND y2 <= 31 AND x < 33"), sizes)
    assert all(sum(r.counts) == 33 * 31 for r in counted.collect())
    assert sorted(map(tuple, masks.counted_runs(counted).collect())) == sorted(map(tuple, runs.collect()))
    met = masks.overlap(runs, runs, spark.createDataFrame([(1, 40)], "image_id long, true_id long")).collect()
    pixels = {}
    for k, x, y in want:
        pixels.setdefault(k, set()).add((x, y))
    assert {(r.segment_id, r.true_id): (r.pixels, round(r.iou, 9)) for r in met} == {(a, b): (len(p & q), round(len(p & q) / (len(p) if b == 40 else len(p | q)), 9)) for a, p in pixels.items() for b, q in pixels.items() if p & q}


def test_coloured_masks(spark, tmp_path):
    ids = np.random.default_rng(4).choice([0, 7, 300, 70000], (9, 11))
    ids[:, 3] = 7
    data = np.stack([ids & 255, ids >> 8 & 255, ids >> 16], 2).astype(np.uint8).tobytes()
    images = spark.createDataFrame([(5, 11, 9, bytearray(data))], "image_id long, width int, height int, data binary")
    runs = masks.coloured_runs(images)
    assert {(r.segment_id, r.x, y) for r in runs.collect() for y in range(r.y1, r.y2)} == {(int(ids[y, x]), x, y) for y in range(9) for x in range(11)}
    assert {r.segment_id: r.pixels for r in masks.areas(runs).collect()} == {int(k): int((ids == k).sum()) for k in np.unique(ids)}
    (tmp_path / "p.json").write_text(json.dumps({"annotations": [{"image_id": 5, "file_name": "a.png", "segments_info": [{"id": 7, "category_id": 1}, {"id": 300, "category_id": 2, "iscrowd": 1}]}, {"image_id": 6, "file_name": "b.png", "segments_info": [{"id": 1, "category_id": 1}]}], "categories": [{"id": 1, "name": "cat"}]}))
    told = masks.read_panoptic(spark, str(tmp_path / "p.json"), spark.createDataFrame([("a",)], "file_name string")).collect()
    assert sorted((r.image_id, r.segment_id, r.category, r.iscrowd) for r in told) == [(5, 7, "cat", 0), (5, 300, None, 1)]
    assert masks.areas(runs.where(F.lit(False))).count() == 0


def _exchanges(df) -> int:
    return str(df._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning")


def test_votes_and_lines_stay_with_their_page(spark, sf):
    """All points of a page are in one task: boxes are dealt once, pixels and votes never."""
    for query in (raster_queries.line_votes, raster_queries.straight_lines, raster_queries.paragraph_boxes):
        plan = query(spark, sf)._jdf.queryExecution().toString().split("Physical Plan")[-1]
        assert plan.count("Exchange") == 1 and plan.count("FlatMapGroupsInPandas") == 1


def test_paragraphs_are_those_of_the_single_steps(spark):
    grids = {k: np.random.default_rng(k).random((30, 60)) < p for k, p in enumerate((0.02, 0.1, 0.4, 0.9))}
    runs = runs_of(spark, grids).unionByName(spark.createDataFrame([(0, -40, -7, 3), (0, 500, 900, 990), (9, 3, 5, 5)], "page_id long, y long, x1 long, x2 long"))
    for across, down, share, grow in ((4, 1, 0.3, 2), (0, 0, 0.5, 0), (3, 2, 0.05, 1)):
        least = max(1, round(share * (2 * across + 1) * (2 * down + 1)))
        want = raster.run_components(raster.dilated(raster.blurred(runs.where("x1 < x2"), across, down, least), grow, grow))
        assert sorted(raster.paragraph_boxes(runs, across, down, share, grow).collect()) == sorted(want.collect())


def test_votes_of_far_points(spark):
    """Places far apart are counted without a table of all distances between."""
    points = spark.createDataFrame([(1, x, 7) for x in range(12)] + [(1, 10**9 + x, 7) for x in range(12)], "page_id long, x long, y long")
    assert {(r.angle, r.rho): r.votes for r in raster.line_votes(points, 4, 24).collect()} == {(2, 7): 24}


def test_masks_are_measured_in_their_row(spark, sf):
    """Columns of a segment never leave its row: boxes are dealt once, and nothing else is."""
    plan = raster_queries.mask_areas(spark, sf)._jdf.queryExecution().toString().split("Physical Plan")[-1]
    assert plan.count("Exchange") == 1 and "Window" not in plan


def _stars(spark, seed=3):
    """Polygons of two images for both sides: some of several parts, some with one point only, one far away; one image has true ones only."""
    r = random.Random(seed)
    at = lambda: {"x": r.randint(-40, 80) / 4, "y": r.randint(-40, 80) / 4}
    rows = [(image, k, part, real, "abc"[k % 3] if k else None, [at() for _ in range(r.choice((1, 3, 4, 7)))]) for image in (1, 2) for k in range(14) for real in (False, True) for part in range(r.randint(1, 3))]
    rows += [(2, 99, 0, real, "a", [{"x": x, "y": y} for x, y in ((1e6, 1e9), (1e6 + 3, 1e9), (1e6, 1e9 + 4))]) for real in (False, True)] + [(3, 5, 0, True, "a", [at() for _ in range(9)])]
    return spark.createDataFrame(rows, "image_id long, segment_id long, part int, real boolean, category string, points array<struct<x:double,y:double>>")


def test_polygons_meet_in_their_image(spark, sf):
    """Polygons compared inside the image are those compared by runs, and boxes are dealt once."""
    stars = _stars(spark)
    own, true = (masks.polygon_runs(stars.where(side)) for side in ("NOT real", "real"))
    want = sorted(map(tuple, masks.overlap(own, true).collect()))
    assert sorted(map(tuple, masks.polygon_overlap(stars).collect())) == want and len(want) > 100
    plan = raster_queries.mask_overlaps(spark, sf)._jdf.queryExecution().toString().split("Physical Plan")[-1]
    assert plan.count("Exchange") == 1 and plan.count("FlatMapGroupsInArrow") == 1 and "Join" not in plan


def test_quality_is_counted_in_the_image(spark, sf):
    """Counts of images give the quality that joins give; nothing but counts is exchanged."""
    stars = _stars(spark, 8)
    stars = stars.unionByName(stars.where("NOT real AND segment_id < 7").select(F.lit(7).cast("long").alias("image_id"), "segment_id", "part", F.explode(F.array(F.lit(False), F.lit(True))).alias("real"), "category", "points"))
    sides = [stars.where(side) for side in ("NOT real", "real")]
    named = [side.select("image_id", "segment_id", "category").distinct() for side in sides]
    want = {r.category: r for r in masks.mask_quality(*map(masks.polygon_runs, sides), *named).collect()}
    got = {r.category: r for r in masks.polygon_quality(stars).collect()}
    assert set(got) == set(want) == {"a", "b", "c", None} and all(got[k] == pytest.approx(tuple(want[k])) if k else got[k][1:] == (0, 0, 0) for k in got) and got["b"].pq > 0
    plan = raster_queries.mask_quality(spark, sf)._jdf.queryExecution().toString().split("Physical Plan")[-1]
    assert plan.count("Exchange") == 2 and plan.count("FlatMapGroupsInArrow") == 1 and "Join" not in plan


def test_areas_are_summed_where_runs_are_made(spark, sf):
    """Many segments of a batch at a time, the same as areas of their runs."""
    rows = _stars(spark, 11).where("real")
    assert sorted(map(tuple, masks.polygon_areas(rows).collect())) == sorted(map(tuple, masks.areas(masks.polygon_runs(rows)).collect()))
    plan = raster_queries.mask_areas(spark, sf)._jdf.queryExecution().toString().split("Physical Plan")[-1]
    assert plan.count("MapInArrow") == 1 and "lambda" not in plan


def test_text_boxes_are_ink_without_rows_of_their_own(spark, sf):
    """Boxes go to their page as they are, and mean the same as their rows."""
    rows = raster_queries._text_rows(spark, sf)
    assert sorted(raster_queries.paragraph_boxes(spark, sf).collect()) == sorted(raster.paragraph_boxes(rows, 10, 3, 0.3, 4).collect())
    assert "Generate" not in raster_queries.paragraph_boxes(spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_stripes_of_a_page_are_the_page(monkeypatch):
    """Windows reach over the edges of stripes, rows far apart and ink up to both sides."""
    y, x = np.nonzero(np.random.default_rng(2).random((300, 40)) < 0.2)
    y = np.r_[y, y + 900]
    x = np.r_[x, x]
    whole = raster._paragraph_runs(y, x, x + 1, 3, 2, 8, 1, [])
    monkeypatch.setattr(raster, "_STRIPE", 1)
    assert all((a == b).all() for a, b in zip(whole, raster._paragraph_runs(y, x, x + 1, 3, 2, 8, 1, []), strict=True)) and len(whole[0]) > 500


def test_density_clusters_stay_with_their_page(spark, sf):
    """Boxes are dealt by page once; points, pairs and clusters never, whatever the sides' sizes."""
    plan = raster_queries.density_clusters(spark, sf)._jdf.queryExecution().toString().split("Physical Plan")[-1]
    assert plan.count("Exchange") == 1 and plan.count("FlatMapGroupsInArrow") == 1 and "Join" not in plan


def test_density_clusters_of_odd_points(spark):
    """Points without a place, far apart, of another name's type, and columns that are only passed on."""
    rows = [(1, "b", 0.0, 0.0, "p"), (1, "a", 3.0, 0.0, None), (1, "c", 6.0, 0.0, "q"), (1, "d", None, 0.0, "r"), (1, "e", float("nan"), 1.0, "s"), (1, "g", -1e12, 1e12, "t"), (1, "f", -1e12, 1e12 + 2, "u"), (2, "z", None, None, "v")]
    got = density.density_clusters(spark.createDataFrame(rows, "page_id long, point_id string, x double, y double, more string"), 3.0, 3)
    assert got.columns == ["page_id", "point_id", "x", "y", "more", "core", "cluster"]
    assert {(r.point_id, r.core, r.cluster, r.more) for r in got.collect()} == {("a", True, "a", None), ("b", False, "a", "p"), ("c", False, "a", "q"), *((k, False, None, m) for k, m in zip("degfz", "rstuv"))}
