"""Measures of detections against true boxes: greedy and optimal matching, average precision, panoptic quality, losses."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import Box
from .cluster import _near
from .graph import cut

#: Overlaps at which precision is averaged, and the edges of small, medium and large areas.
OVERLAPS = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))
SIZES = {"all": (0.0, 1e10), "small": (0.0, 32.0**2), "medium": (32.0**2, 96.0**2), "large": (96.0**2, 1e10)}


def assign(cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the cheapest one-to-one assignment of a cost matrix, by shortest augmenting paths."""
    turned = cost.shape[0] > cost.shape[1]
    c = cost.T if turned else cost
    n, m = c.shape
    u, v, owner = np.zeros(n), np.zeros(m), np.full(m, -1)
    for i in range(n):
        least, came, done = np.full(m, np.inf), np.full(m, -1), np.zeros(m, bool)
        row, j, best = i, -1, 0.0
        while True:
            step = best + c[row] - u[row] - v
            better = ~done & (step < least)
            least[better], came[better] = step[better], j
            open_ = np.where(done, np.inf, least)
            j = int(np.argmin(open_))
            best = open_[j]
            done[j] = True
            if owner[j] < 0:
                break
            row = owner[j]
        used = done & (owner >= 0)
        u[i] += best
        u[owner[used]] += best - least[used]
        v[done] -= best - least[done]
        while j >= 0:
            before = came[j]
            owner[j] = owner[before] if before >= 0 else i
            j = before
    cols = np.flatnonzero(owner >= 0)
    rows = owner[cols]
    order = np.argsort(rows)
    return (cols[order], rows[order]) if turned else (rows[order], cols[order])


def optimal_matches(detections: DataFrame, truth: DataFrame, weights: tuple[float, float, float] = (1.0, 5.0, 2.0)) -> DataFrame:
    """(page_id, area_id, true_id, cost): each page's cheapest one-to-one assignment of detections to true boxes.

    The cost is the weighted sum of minus the score where labels agree, the distance of the boxes' coordinates, and
    minus their generalised overlap.
    """

    def run(key, d: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        a, b = d[["x1", "y1", "x2", "y2"]].to_numpy(float), t[["x1", "y1", "x2", "y2"]].to_numpy(float)
        if not len(a) or not len(b):
            return pd.DataFrame(columns=["page_id", "area_id", "true_id", "cost"])
        inter = np.clip(np.minimum(a[:, None, 2:], b[None, :, 2:]) - np.maximum(a[:, None, :2], b[None, :, :2]), 0, None).prod(2)
        size = lambda x: (x[:, 2] - x[:, 0]) * (x[:, 3] - x[:, 1])
        both = size(a)[:, None] + size(b)[None, :] - inter
        hull = (np.maximum(a[:, None, 2:], b[None, :, 2:]) - np.minimum(a[:, None, :2], b[None, :, :2])).prod(2)
        same = d["label"].to_numpy()[:, None] == t["label"].to_numpy()[None, :]
        cost = weights[0] * -np.where(same, d["score"].to_numpy(float)[:, None], 0) + weights[1] * np.abs(a[:, None, :] - b[None, :, :]).sum(2) - weights[2] * (inter / both - (hull - both) / hull)
        i, j = assign(cost)
        return pd.DataFrame({"page_id": key[0], "area_id": d["area_id"].to_numpy()[i], "true_id": t["area_id"].to_numpy()[j], "cost": cost[i, j]})

    # fresh columns on the second side: both may come from one table
    own = ("page_id", "area_id", "label", "score", "x1", "y1", "x2", "y2")
    second = truth.select(*[F.col(c).alias(c) for c in own if c in truth.columns])
    return detections.select(*own).groupBy("page_id").cogroup(second.groupBy("page_id")).applyInPandas(run, "page_id long, area_id long, true_id long, cost double")


def _page(d: pa.Table, t: pa.Table, least: float, most: int | None = None) -> dict[str, np.ndarray]:
    """A page's detections by label, falling score and id (``at``, ``place`` in their label), and the pairs (``det``, ``true``, ``iou``) with true boxes of their label that share ``least`` or more.

    A true box that is a ``crowd`` shares the detection alone.
    """
    code = pa.concat_arrays([c.cast(pa.string()) for x in (d, t) for c in x["label"].chunks] or [pa.array([], pa.string())]).dictionary_encode().indices.fill_null(-1).to_numpy()
    own, other = code[: len(d)], code[len(d) :]
    at = np.lexsort((d["area_id"].to_numpy(), -d["score"].to_numpy().astype(float), own))
    first = np.flatnonzero(np.r_[True, own[at][1:] != own[at][:-1]]) if len(at) else at
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)])) + 1
    if most is not None:
        at, place = at[place <= most], place[place <= most]
    a, b = (np.stack([x[c].to_numpy().astype(float) for c in ("x1", "y1", "x2", "y2")], 1) for x in (d, t))
    a = a[at]
    pairs = np.sort(_near(np.concatenate([a, b]), 0.0, 0.0), axis=1)
    i, j = pairs[(pairs[:, 0] < len(a)) & (pairs[:, 1] >= len(a))].T
    j = j - len(a)
    same = (own[at][i] == other[j]) & (own[at][i] >= 0)
    i, j = i[same], j[same]
    width, height = np.minimum(a[i, 2], b[j, 2]) - np.maximum(a[i, 0], b[j, 0]), np.minimum(a[i, 3], b[j, 3]) - np.maximum(a[i, 1], b[j, 1])
    size = lambda x: (x[:, 2] - x[:, 0]) * (x[:, 3] - x[:, 1])
    crowd = t["crowd"].to_numpy(zero_copy_only=False).astype(bool) if "crowd" in t.column_names else np.zeros(len(b), bool)
    over = (a[i, 0] < b[j, 2]) & (b[j, 0] < a[i, 2]) & (a[i, 1] < b[j, 3]) & (b[j, 1] < a[i, 3])
    with np.errstate(divide="ignore", invalid="ignore"):
        iou = width * height / np.where(crowd[j], size(a)[i], size(a)[i] + size(b)[j] - width * height)
    near = over & (iou >= least)
    return {"at": at, "place": place, "size": size(a), "det": i[near], "true": j[near], "iou": iou[near], "crowd": crowd, "true_size": size(b), "label": other}


def _boxes(boxes: DataFrame, *extra: str) -> DataFrame:
    """Boxes with columns of their own: both sides may come from one table."""
    return boxes.select(*[F.col(c).alias(c) for c in ("page_id", "label", "area_id", *extra, "x1", "y1", "x2", "y2")])


def greedy_detections(detections: DataFrame, truth: DataFrame, overlaps: tuple[float, ...] = (0.5,)) -> DataFrame:
    """``greedy_matches`` as one row for each detection: ``true_ids`` and ``true_sizes`` hold one value for every overlap."""

    def run(key, d: pa.Table, t: pa.Table) -> pa.Table:
        page = _page(d, t, min(overlaps))
        det, true, iou, at = page["det"], page["true"], page["iou"], page["at"]
        ids = t["area_id"].to_numpy()
        order = np.lexsort((-ids[true], -iou, det))
        best = np.full((len(at), len(overlaps)), -1)
        for k, overlap in enumerate(overlaps):
            asked = order[iou[order] >= overlap]
            hit = asked[_first_free(det[asked], true[asked], np.zeros(len(asked), bool), page["place"][det[asked]])]
            best[det[hit], k] = true[hit]
        starts, taken = pa.array(np.arange(len(at) + 1) * len(overlaps), pa.int32()), pa.array(best.ravel(), mask=best.ravel() < 0)
        lists = lambda v: pa.ListArray.from_arrays(starts, pa.array(v).take(taken))
        own = d.select(["page_id", "label", "area_id", "score"]).take(pa.array(at))
        return own.append_column("size", pa.array(page["size"])).append_column("true_ids", lists(ids)).append_column("true_sizes", lists(page["true_size"]))

    schema = "page_id long, label string, area_id long, score double, size double, true_ids array<long>, true_sizes array<double>"
    return _boxes(detections, "score").groupBy("page_id").cogroup(_boxes(truth).groupBy("page_id")).applyInArrow(run, schema)


def _each_overlap(found: DataFrame, overlaps: tuple[float, ...]) -> DataFrame:
    e = F.explode(F.arrays_zip(F.array(*map(F.lit, overlaps)).alias("overlap"), F.col("true_ids").alias("true_id"), F.col("true_sizes").alias("true_size")))
    return found.select("page_id", "label", "area_id", "score", "size", e.alias("e")).select("page_id", "label", "area_id", "score", "size", "e.overlap", "e.true_id", "e.true_size")


def greedy_matches(detections: DataFrame, truth: DataFrame, overlaps: tuple[float, ...] = (0.5,)) -> DataFrame:
    """(page_id, label, area_id, score, size, overlap, true_id): by falling score, each detection takes the free true box it
    overlaps most, at least by ``overlap``; null where none is left. One row for each detection and overlap."""
    return _each_overlap(greedy_detections(detections, truth, overlaps), overlaps).drop("true_size")


def precision_curves(matches: DataFrame, truth: DataFrame, keys: tuple[str, ...] = ("label", "overlap"), of: tuple[str, ...] = ("label",)) -> DataFrame:
    """Precision, recall and average precision (area under the steps) of greedy matches per key.

    Ranks are counted by page first and added up, so no task holds a whole class: detections of one score are one step.
    """
    n = truth.groupBy(*of).agg(F.count("*").alias("n"))
    steps = matches.groupBy(*keys, "score").agg(F.count("*").alias("k"), F.count("true_id").alias("hits"))
    w = Window.partitionBy(*keys).orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    curve = steps.select(*keys, "hits", F.sum("hits").over(w).alias("tp"), F.sum("k").over(w).alias("seen")).join(n, list(of))
    return curve.groupBy(*keys).agg((F.sum(F.col("hits") * F.col("tp") / F.col("seen")) / F.first("n")).alias("ap"), (F.max("tp") / F.first("n")).alias("recall"), (F.max("tp") / F.max("seen")).alias("precision"))


def box_scores(detections: DataFrame, truth: DataFrame) -> DataFrame:
    """Average precision by size of box (all, small, medium, large) over ten overlaps, and at 0.5 and 0.75."""
    sizes = F.explode(F.array(*[F.struct(F.lit(k).alias("boxes"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for k, (lo, hi) in SIZES.items()]))
    sized = lambda t, size, *cols: t.select(*cols, size.alias("own"), sizes.alias("s")).where("own >= s.lo AND own < s.hi").select(*cols, F.col("s.boxes").alias("boxes"))
    # a detection that found a box of another size doesn't count for or against this size
    matches = _each_overlap(greedy_detections(detections, truth, OVERLAPS), OVERLAPS)
    found = sized(matches, F.when(F.col("true_id").isNull(), F.col("size")).otherwise(F.col("true_size")), "label", "overlap", "score", "true_id")
    curves = precision_curves(found, sized(truth, Box.of().area, "label"), ("boxes", "label", "overlap"), ("boxes", "label"))
    return curves.groupBy("boxes").agg(F.avg("ap").alias("ap"), F.avg(F.when(F.col("overlap") == 0.5, F.col("ap"))).alias("ap50"), F.avg(F.when(F.col("overlap") == 0.75, F.col("ap"))).alias("ap75"), F.avg("recall").alias("ar"))


def panoptic_quality(segments: DataFrame, truth: DataFrame, common: DataFrame) -> DataFrame:
    """Per category the segmentation, recognition and panoptic quality.

    ``segments`` and ``truth`` have image_id, segment_id, category and pixels; ``common`` has image_id, segment_id, true_id and
    pixels. A segment is found by the one of its category that shares over half of both together.
    """
    a, b = segments.select("image_id", "segment_id", "category", F.col("pixels").alias("own")), truth.select("image_id", F.col("segment_id").alias("true_id"), F.col("category").alias("true_category"), F.col("pixels").alias("real"))
    met = common.join(a, ["image_id", "segment_id"]).join(b, ["image_id", "true_id"]).where("category = true_category")
    hit = met.withColumn("iou", F.col("pixels") / (F.col("own") + F.col("real") - F.col("pixels"))).where("iou > 0.5").groupBy("category").agg(F.count("*").alias("tp"), F.sum("iou").alias("iou"))
    n = segments.groupBy("category").agg(F.count("*").alias("found"), F.lit(0).cast("long").alias("real")).unionByName(truth.groupBy("category").agg(F.lit(0).cast("long").alias("found"), F.count("*").alias("real"))).groupBy("category").agg(F.sum("found").alias("found"), F.sum("real").alias("real"))
    return quality_of_counts(n.join(hit, "category", "left"))


def quality_of_counts(counts: DataFrame) -> DataFrame:
    """``panoptic_quality`` from each category's segments (``found``, ``real``), the found ones (``tp``) and their shares' sum (``iou``)."""
    out = counts.fillna({"tp": 0, "iou": 0.0})
    rq = F.col("tp") / ((F.col("found") + F.col("real")) / 2)
    sq = F.when(F.col("tp") > 0, F.col("iou") / F.col("tp")).otherwise(0.0)
    return out.select("category", sq.alias("sq"), rq.alias("rq"), (sq * rq).alias("pq"))


def top_accuracy(scores: Column, label: Column, k: int = 1) -> Column:
    """1 where the label's score is among the ``k`` largest, else 0."""
    own = F.get(scores, label)
    return (F.size(F.filter(scores, lambda x: x > own)) < k).cast("int")


def box_losses(matched: DataFrame) -> DataFrame:
    """Mean distance and generalised-overlap loss of matched boxes (aliases a and b) per page."""
    a, b = Box.of("a"), Box.of("b")
    l1 = F.abs(a.x1 - b.x1) + F.abs(a.y1 - b.y1) + F.abs(a.x2 - b.x2) + F.abs(a.y2 - b.y2)
    return matched.groupBy(F.col("a.page_id").alias("page_id")).agg(F.avg(l1).alias("loss_box"), F.avg(1 - a.giou(b)).alias("loss_giou"), F.count("*").alias("n"))


def cardinality_error(detections: DataFrame, truth: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per page the difference between the number of detections at the threshold and of true boxes."""
    n = detections.where(F.col("score") >= threshold).groupBy("page_id").agg(F.count("*").alias("found"))
    m = truth.groupBy("page_id").agg(F.count("*").alias("real"))
    return n.join(m, "page_id", "full").select("page_id", F.abs(F.coalesce("found", F.lit(0)) - F.coalesce("real", F.lit(0))).alias("error"))


def sine_positions(x: Column, y: Column, width: Column, height: Column, size: int = 8, base: float = 10000.0) -> Column:
    """Sine and cosine encoding of a place on a page: ``size`` numbers for y, then for x."""
    turn = 2 * np.pi
    out = []
    for v, n in ((y, height), (x, width)):
        for i in range(size):
            angle = v / n * turn / base ** (2 * (i // 2) / size)
            out.append(F.sin(angle) if i % 2 == 0 else F.cos(angle))
    return F.array(*out)


# evaluation of boxes by size, overlap and number of detections

#: Detections of a range that are counted at once.
PART_ROWS = 250_000
#: Fixed value: most detections of a page and label that count.
LIMITS = (1, 10, 100)


def _first_free(det: np.ndarray, t: np.ndarray, crowd: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of pairs sorted by detection and its choice, the places of those that come about: each true box goes to the best detection that asks for it, crowds to all.

    Detections ask in rounds; who is refused asks for the next. True boxes all prefer the same order, so this is what taking turns in that order gives.
    """
    left = np.arange(len(det))
    while True:
        first = left[np.r_[True, det[left][1:] != det[left][:-1]]] if len(left) else left
        own = first[~crowd[first]]
        own = own[np.lexsort((place[own], t[own]))]
        refused = own[1:][t[own][1:] == t[own][:-1]]
        if not len(refused):
            return first
        left = left[~np.isin(left, refused)]


def judged_detections(detections: DataFrame, truth: DataFrame, overlaps: tuple[float, ...] = OVERLAPS, most: int = LIMITS[-1]) -> DataFrame:
    """``judged_boxes`` as one row for each detection: ``found`` holds for every range of sizes and in it every overlap 1 for a hit, plus 2 if ignored."""
    truth = truth if "crowd" in truth.columns else truth.withColumn("crowd", F.lit(False))

    def run(key, d: pa.Table, t: pa.Table) -> pa.Table:
        page = _page(d, t, min(overlaps), most)
        det, true, iou, at, place = page["det"], page["true"], page["iou"], page["at"], page["place"]
        ids, crowd, size, true_size = t["area_id"].to_numpy()[true], page["crowd"][true], page["size"], page["true_size"][true]
        found = np.empty((len(at), len(SIZES), len(overlaps)), np.int8)
        for i, (low, high) in enumerate(SIZES.values()):
            # own size first, then the most overlap, then the last by id
            other = crowd | ~((low <= true_size) & (true_size <= high))
            order = np.lexsort((-ids, -iou, other, det))
            found[:, i] = np.where((low <= size) & (size <= high), 0, 2)[:, None]
            for j, overlap in enumerate(overlaps):
                asked = order[iou[order] >= overlap]
                hit = asked[_first_free(det[asked], true[asked], crowd[asked], place[det[asked]])]
                found[det[hit], i, j] = 1 + 2 * other[hit]
        own = d.select(["page_id", "label", "area_id", "score"]).take(pa.array(at)).append_column("place", pa.array(place, pa.int32()))
        starts = pa.array(np.arange(len(at) + 1) * len(SIZES) * len(overlaps), pa.int32())
        return own.append_column("found", pa.ListArray.from_arrays(starts, pa.array(found.ravel())))

    own = _boxes(detections, "score").groupBy("page_id").cogroup(_boxes(truth, "crowd").groupBy("page_id"))
    return own.applyInArrow(run, "page_id long, label string, area_id long, score double, place int, found array<byte>")


def judged_boxes(detections: DataFrame, truth: DataFrame, overlaps: tuple[float, ...] = OVERLAPS, most: int = LIMITS[-1]) -> DataFrame:
    """(page_id, label, area_id, score, place, boxes, overlap, hit, ignored): each of a page's ``most`` best detections of a label, for every range of sizes and overlap.

    By falling score (then area_id) a detection takes the free true box that it overlaps most (the last by area_id among equals), at least by ``overlap``; true
    boxes of other sizes and crowds (``crowd``, if there) only where none other is left, and such detections are ignored, as are those of other
    sizes that find nothing. A crowd may be found again and again, and its overlap is the share of the detection alone.
    """
    judged = judged_detections(detections, truth, overlaps, most)
    kinds = F.array(*[F.struct(F.lit(k).alias("boxes"), F.lit(o).alias("overlap")) for k in SIZES for o in overlaps])
    each = judged.select("page_id", "label", "area_id", "score", "place", F.explode(F.arrays_zip(kinds.alias("k"), F.col("found").alias("f"))).alias("e"))
    return each.select("page_id", "label", "area_id", "score", "place", "e.k.boxes", "e.k.overlap", (F.col("e.f") % 2 == 1).alias("hit"), (F.col("e.f") >= 2).alias("ignored"))


def recall_precision(judged: DataFrame, truth: DataFrame, overlaps: tuple[float, ...] = OVERLAPS, limits: tuple[int, ...] = LIMITS) -> DataFrame:
    """(label, boxes, overlap, most, ap, recall): average precision at 101 recall places, and recall, with at most ``most`` detections of a page.

    The precision at a place is the greatest of all steps with that recall or more: steps leave the greatest precision of each place they reach, and a
    running maximum from the right over those 101 places does the rest. Detections are dealt by ranges of their order; hits are counted for each range first and
    inside it afterwards, so no task holds a whole label. ``judged`` has the rows of ``judged_detections`` or of ``judged_boxes``. Labels without a true box of a size have no row for it.
    """
    truth = truth if "crowd" in truth.columns else truth.withColumn("crowd", F.lit(False))
    sizes = F.explode(F.array(*[F.struct(F.lit(k).alias("boxes"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for k, (lo, hi) in SIZES.items()]))
    real = truth.where("NOT crowd").select("label", Box.of().area.alias("size"), sizes.alias("s")).where("size BETWEEN s.lo AND s.hi").groupBy("label", "s.boxes").agg(F.count("*").alias("n"))
    real = cut(real, "real")
    keys = ["label", "boxes", "overlap", "most"]
    kinds = [(k, o, m) for k in SIZES for o in overlaps for m in limits]
    if "found" not in judged.columns:  # one row for each detection
        flag = lambda k, o: F.max(F.when((F.col("boxes") == k) & (F.col("overlap") == o), F.col("hit").cast("int") + 2 * F.col("ignored").cast("int")))
        judged = judged.groupBy("page_id", "label", "area_id", "score", "place").agg(F.array(*[F.coalesce(flag(k, o), F.lit(2)).cast("byte") for k in SIZES for o in overlaps]).alias("found"))
    judged = cut(judged.select("label", "score", "page_id", "area_id", "place", "found"), "judged")
    parts = max(int(judged.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-judged.count() // PART_ROWS))
    ranged = judged.repartitionByRange(parts, "label", F.desc("score"), "page_id", "area_id")
    dealt = cut(ranged.withColumn("part", F.spark_partition_id()), "dealt")

    def steps(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """For rows and kinds whether a detection is a hit and whether it counts at all."""
        f = np.repeat(rows["found"].combine_chunks().flatten().to_numpy().reshape(-1, len(kinds) // len(limits)), len(limits), axis=1)
        counts = (f < 2) & (rows["place"].to_numpy()[:, None] <= np.tile(limits, len(kinds) // len(limits)))
        return counts & (f == 1), counts

    def sums(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            hit, counts = steps(rows)
            label = rows["label"].combine_chunks().dictionary_encode()
            part = rows["part"].to_numpy()
            for p in np.unique(part):
                for k, name in enumerate(label.dictionary.to_pylist()):
                    own = (part == p) & (label.indices.fill_null(-1).to_numpy() == k)
                    if own.any():
                        yield pa.RecordBatch.from_pydict({"part": pa.array([p] * len(kinds), pa.int32()), "label": [name] * len(kinds), "kind": pa.array(range(len(kinds)), pa.int32()), "tp": hit[own].sum(0), "seen": counts[own].sum(0)})

    sum_ = dealt.mapInArrow(sums, "part int, label string, kind int, tp long, seen long").groupBy("part", "label", "kind").agg(F.sum("tp").alias("tp"), F.sum("seen").alias("seen"))
    before = Window.partitionBy("label", "kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    named = F.array(*[F.struct(F.lit(k).alias("boxes"), F.lit(o).alias("overlap"), F.lit(m).alias("most")) for k, o, m in kinds])
    starts = sum_.select("part", "label", "kind", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("tp", "seen")]).withColumn("boxes", F.get(named, F.col("kind"))["boxes"]).join(F.broadcast(real), ["label", "boxes"]).select("part", "label", "kind", "tp", "seen", "n")

    def run(key, rows: pa.Table, begin: pa.Table) -> pa.Table:
        out = []
        label, score = np.array(rows["label"].to_pylist(), object), rows["score"].to_numpy()
        for name in sorted({x for x in begin["label"].to_pylist()}):
            own = np.flatnonzero(label == name)
            own = own[np.lexsort((rows["area_id"].to_numpy()[own], rows["page_id"].to_numpy()[own], -score[own]))]
            hit, counts = steps(rows.take(pa.array(own)))
            for b in begin.filter(pc.equal(begin["label"], name)).to_pylist():
                k = b["kind"]
                at = np.flatnonzero(hit[:, k])
                if not len(at):
                    continue
                # between two hits the precision falls: of all steps with one recall the hits decide
                tp, seen = b["tp"] + np.arange(1, len(at) + 1), b["seen"] + np.cumsum(counts[:, k])[at]
                place = tp * 100 // b["n"]
                first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
                out.append((name, k, place[first], np.maximum.reduceat(tp / seen, first), tp[np.r_[first[1:], len(tp)] - 1]))
        flat = lambda i, kind: pa.array(np.concatenate([x[i] for x in out]) if out else [], kind)
        size = [len(x[2]) for x in out]
        return pa.table({"label": pa.array([x[0] for x, n in zip(out, size) for _ in range(n)], pa.string()), "kind": pa.array([x[1] for x, n in zip(out, size) for _ in range(n)], pa.int32()), "place": flat(2, pa.int64()), "precision": flat(3, pa.float64()), "tp": flat(4, pa.int64())})

    places = dealt.groupBy("part").cogroup(starts.groupBy("part")).applyInArrow(run, "label string, kind int, place long, precision double, tp long")
    places = places.groupBy("label", "kind", "place").agg(F.max("precision").alias("precision"), F.max("tp").alias("tp")).withColumn("k", F.get(named, F.col("kind"))).select("label", "k.*", "place", "precision", "tp")
    up = Window.partitionBy(*keys).orderBy("place")
    right = F.max("precision").over(Window.partitionBy(*keys).orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, 0))
    filled = places.withColumn("w", right * (F.col("place") - F.coalesce(F.lag("place").over(up), F.lit(-1))))
    found = filled.groupBy(*keys).agg((F.sum("w") / 101).alias("ap"), F.max("tp").alias("tp"))
    wanted = F.array(*[F.struct(F.lit(o).alias("overlap"), F.lit(m).alias("most")) for o in overlaps for m in limits])
    every = real.withColumn("x", F.explode(wanted)).select("label", "boxes", "n", "x.overlap", "x.most")
    return every.join(found, keys, "left").select(*keys, F.coalesce("ap", F.lit(0.0)).alias("ap"), (F.coalesce("tp", F.lit(0)) / F.col("n")).alias("recall"))


def box_evaluation(detections: DataFrame, truth: DataFrame, overlaps: tuple[float, ...] = OVERLAPS, limits: tuple[int, ...] = LIMITS) -> DataFrame:
    """Means over labels and overlaps: (boxes, most, ap, ap50, ap75, ar)."""
    curves = recall_precision(judged_detections(detections, truth, overlaps, max(limits)), truth, overlaps, limits)
    at = lambda o: F.avg(F.when(F.col("overlap") == o, F.col("ap")))
    return curves.groupBy("boxes", "most").agg(F.avg("ap").alias("ap"), at(0.5).alias("ap50"), at(0.75).alias("ap75"), F.avg("recall").alias("ar"))
