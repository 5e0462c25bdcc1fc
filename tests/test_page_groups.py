"""Groups of a page's boxes against plain versions of their rules, and how the plans hand pages over."""

import random

import pytest
from docloom import catalogue
from docloom.operators import cluster, layout

BOX = "page_id long, area_id long, x1 double, y1 double, x2 double, y2 double, confidence double"


def plan(spark, sf, name) -> str:
    return catalogue.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


def pages(seed, n=3, boxes=70):
    rng, out = random.Random(seed), []
    for page in range(n):
        for i in rng.sample(range(1000), boxes):
            x, y = rng.randint(0, 300), rng.choice([rng.randint(0, 200), 20 * rng.randint(0, 10)])
            out.append((page, i, float(x), float(y), float(x + rng.randint(0, 60)), float(y + rng.choice([8, 9, 12, 45])), rng.randint(0, 20) / 20))
    return out


def each_page(rows):
    for page in sorted({r[0] for r in rows}):
        yield page, sorted(r for r in rows if r[0] == page)


def members(df):
    return {(r.page_id, tuple(r.members)) for r in df.collect()}


def hull(g):
    return min(r[2] for r in g), min(r[3] for r in g), max(r[4] for r in g), max(r[5] for r in g)


@pytest.mark.parametrize("name", ["nms_merge", "nms_delete", "nms_score"])
def test_suppressed_pages_come_as_arrow(spark, sf, name):
    p = plan(spark, sf, name)
    assert "FlatMapGroupsInArrow" in p and "FlatMapGroupsInPandas" not in p and p.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("mode", ["merge", "delete"])
def test_nms_is_the_plain_rule(spark, mode):
    rows, want = pages(5), set()
    for page, left in each_page(rows):
        while left:
            last, kept, gone = left[-1], [], [left[-1]]
            for r in left[:-1]:
                w, h = (max(0, min(r[k + 2], last[k + 2]) - max(r[k], last[k]) + 1) for k in (2, 3))
                (gone if w * h / ((r[4] - r[2] + 1) * (r[5] - r[3] + 1)) > 0.1 else kept).append(r)
            ids = tuple(sorted(r[1] for r in gone))
            box = hull(gone) if mode == "merge" else last[2:6]
            said = [r[6] for r in gone if r is last or not (r[2] >= last[2] and r[3] >= last[3] and r[4] <= last[4] and r[5] <= last[5])] if mode == "merge" else [last[6]]
            want.add((page, last[1], ids, tuple(box), round(sum(said) / len(said), 9)))
            left = kept
    got = cluster.nms(spark.createDataFrame(rows, BOX), 0.1, mode).collect()
    assert {(r.page_id, r.group_id, tuple(r.members), (r.x1, r.y1, r.x2, r.y2), round(r.score, 9)) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("name", ["distance_groups", "aligned_groups", "candidate_tables"])
def test_grouped_pages_come_as_arrow(spark, sf, name):
    p = plan(spark, sf, name)
    assert "FlatMapGroupsInArrow" in p and "FlatMapGroupsInPandas" not in p and p.count("Exchange hashpartitioning") == 1


def first_fit(rows, fits):
    groups = []
    for a in rows:
        for g in groups:
            if fits(a, g):
                g.append(a)
                break
        else:
            groups.append([a])
    return groups


def plain_rows(rows, gap, height, shift):
    tall = lambda r: r[5] - r[3] > r[4] - r[2]

    def fits(a, o):
        level = abs(a[3] - o[3]) <= shift and abs(a[5] - o[5]) <= shift
        return level and (abs(a[2] - o[4]) < gap or abs(a[4] - o[2]) < gap) and abs(a[5] - a[3] - o[5] + o[3]) < height and not tall(o)

    return first_fit([r for r in rows if not (tall(r) and r[5] - r[3] > 30)], lambda a, g: any(fits(a, o) for o in g))


@pytest.mark.parametrize("merge", [False, True])
def test_distance_groups_are_the_plain_rule(spark, merge):
    rows, want = pages(6), set()
    for page, own in each_page(rows):
        groups, again = plain_rows(own, 20, 4, 5), merge
        while again:
            h = [hull(g) for g in groups]

            def one(p, q):
                w = max(0, min(p[2], q[2]) - max(p[0], q[0])) * max(0, min(p[3], q[3]) - max(p[1], q[1]))
                size = sum((x[2] - x[0]) * (x[3] - x[1]) for x in (p, q)) - w
                holds = lambda a, b: a[0] <= b[0] and a[1] <= b[1] and a[2] >= b[2] and a[3] >= b[3]
                return holds(p, q) or holds(q, p) or w > 0 and w / size > 0.1

            label = list(range(len(h)))
            for i in range(len(h)):
                for j in range(i):
                    if one(h[i], h[j]):
                        label = [label[j] if x == label[i] else x for x in label]
            again = len(set(label)) < len(groups)
            groups = [sum((g for g, x in zip(groups, label) if x == k), []) for k in set(label)]
        want |= {(page, tuple(sorted(r[1] for r in g))) for g in groups}
    assert members(layout.distance_groups(spark.createDataFrame(rows, BOX), 20, 4, 5, merge)) == want


def test_aligned_groups_are_the_plain_rule(spark):
    rows, want = pages(7), set()
    for page, own in each_page(rows):
        fits = lambda a, h: abs(h[0] - a[2]) <= 5 or abs(h[2] - a[4]) <= 5 or abs((h[0] + h[2] - a[2] - a[4]) / 2) <= 5
        groups = first_fit(own, lambda a, g: fits(a, hull(g)))
        want |= {(page, tuple(sorted(r[1] for r in g))) for g in groups}
    assert members(layout.aligned_groups(spark.createDataFrame(rows, BOX), 5.0)) == want
