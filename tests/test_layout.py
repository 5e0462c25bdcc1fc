"""Order-dependent kernels, images, measures, sinks and services against plain Python, on whole pages where SQL cannot say it."""

import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.operators import captions, cluster, dictionary, evaluation, layout, recognition, revisions, titlepage
from docloom.plans import modules, pipeline
from docloom.plans.fixtures import boxes, grid
from docloom.sources import images, readers, spans, writers
from docloom.streaming.service import Service

BOX = "page_id long, area_id long, x1 double, y1 double, x2 double, y2 double"


def areas(spark, rows, page=0):
    return spark.createDataFrame([(page, i, *map(float, b)) for i, b in enumerate(rows)], BOX)


def pages_of(df):
    rows = df.orderBy("page_id", "area_id").toPandas()
    return {p: g for p, g in rows.groupby("page_id")}


@pytest.fixture(scope="module")
def strings(spark, sf):
    return boxes(spark, sf).where("category = 'String'").persist()


def test_reading_order_by_hand(strings):
    got = {(r.page_id, r.area_id): (r.row_no, r.place) for r in cluster.reading_order(strings).collect()}
    for page, g in pages_of(strings).items():
        low, rows, top = (g.y2 - g.y1).min(), [], None
        for r in sorted(g.itertuples(), key=lambda r: (r.y1, r.x1, r.area_id)):
            if top is None or r.y1 - top > low:
                rows.append([])
                top = r.y1
            rows[-1].append(r)
        place = 0
        for n, row in enumerate(rows):
            for r in sorted(row, key=lambda r: (r.x1, r.area_id)):
                place += 1
                assert got[page, r.area_id] == (n, place)


@pytest.mark.parametrize("mode", ["merge", "delete", "score"])
def test_suppression_by_hand(strings, mode):
    got = {}
    for r in cluster.nms(strings, 0.1, mode, "iou" if mode == "score" else "own").collect():
        got.setdefault(r.page_id, {})[r.group_id] = (sorted(r.members), round(r.x1, 6), round(r.y2, 6))
    one = 0 if mode == "score" else 1
    for page, g in pages_of(strings).items():
        left, want = [tuple(r) for r in g[["area_id", "x1", "y1", "x2", "y2", "confidence"]].itertuples(index=False)], {}
        if mode == "score":
            left.sort(key=lambda b: (b[5], -b[0]))
        while left:
            k, gone = left.pop(), []
            for b in left:
                w, h = min(k[3], b[3]) - max(k[1], b[1]) + one, min(k[4], b[4]) - max(k[2], b[2]) + one
                size = lambda x: (x[3] - x[1] + one) * (x[4] - x[2] + one)
                inter = max(w, 0) * max(h, 0)
                if inter / (size(b) if mode != "score" else size(b) + size(k) - inter) > 0.1:
                    gone.append(b)
            group = [k, *gone]
            hull = group if mode == "merge" else [k]
            want[k[0]] = (sorted(b[0] for b in group), round(min(b[1] for b in hull), 6), round(max(b[4] for b in hull), 6))
            left = [b for b in left if b not in gone]
        assert got[page] == want


def test_merged_boxes_by_hand(strings):
    got = {}
    for r in cluster.merge_boxes(strings, 16.0, 0.0, rounds=1000).collect():
        got.setdefault(r.page_id, set()).add(tuple(r.members))
    for page, g in pages_of(strings).items():
        sets = [([r.area_id], [r.x1, r.y1, r.x2, r.y2]) for r in g.itertuples()]
        changed = True
        while changed:
            changed = False
            for a, b in itertools.combinations(range(len(sets)), 2):
                p, q = sets[a][1], sets[b][1]
                if p[0] <= q[2] + 16 and p[2] >= q[0] - 16 and p[1] <= q[3] and p[3] >= q[1]:
                    sets[a] = (sets[a][0] + sets[b][0], [min(p[0], q[0]), min(p[1], q[1]), max(p[2], q[2]), max(p[3], q[3])])
                    del sets[b]
                    changed = True
                    break
        assert got[page] == {tuple(sorted(s)) for s, _ in sets}


def test_groups_of_lines(spark):
    b = areas(spark, [(0, 0, 20, 10), (30, 1, 50, 11), (0, 40, 20, 50), (200, 0, 220, 10), (0, 100, 5, 150)])
    got = {tuple(r.members) for r in layout.distance_groups(b, 20, 3, 5).collect()}
    assert got == {(0, 1), (2,), (3,)}
    assert [tuple(r)[2:] for r in layout.alignments(b.where("area_id < 4"), 2).orderBy("n").collect()] == [(0.0, 10.0, 20.0), (30.0, 40.0, 50.0), (200.0, 210.0, 220.0)]
    assert {tuple(r.members) for r in layout.aligned_groups(b.where("area_id < 4"), 2).collect()} == {(0, 2), (1,), (3,)}


def test_candidate_tables(spark):
    rows = [(x, y, x + 20, y + 10) for y in (0, 20, 40) for x in (0, 100)] + [(0, 300, 20, 310), (100, 300, 120, 310), (0, 500, 90, 510)]
    got = [r.members for r in layout.candidate_tables(areas(spark, rows), distance=60).collect()]
    assert sorted(got) == [[0, 1, 2, 3, 4, 5], [6, 7]]


def test_logical_lines_merge(spark):
    lines = spark.createDataFrame([(0, 1, 50.0, 0.0, 40.0), (0, 2, 52.0, 40.0, 80.0), (0, 1, 200.0, 0.0, 40.0)], "page_id long, part long, at double, lo double, hi double")
    got = sorted(tuple(r)[1:] for r in layout.merge_lines(lines, 20).collect())
    assert got == [(50.0, 0.0, 52.0, 80.0), (200.0, 0.0, 200.0, 40.0)]


def test_page_columns_by_hand(spark, sf):
    b = boxes(spark, sf)
    sizes = b.select("page_id").distinct().select("page_id", F.lit(700.0).alias("img_width"), F.lit(850.0).alias("img_height"))
    got = {r.page_id: ([(c.lo, c.hi) for c in r.columns], r.layout, r.division) for r in layout.page_columns(b, sizes).collect()}
    for page, g in pages_of(b).items():
        cover = np.zeros(701, int)
        for r in g[(g.y2 > 85) & (g.y1 < 765)].itertuples():
            cover[max(int(r.x1), 70) : min(int(r.x2), 630) + 1] += 1
        on = np.flatnonzero((cover > 0) & (cover >= cover[cover > 0].mean()))
        runs = np.split(on, np.flatnonzero(np.diff(on) > 50) + 1)
        want = [(r[0], r[-1] + 1) for r in runs]
        # runs part where the next begins 50 or more after the last end
        assert got[page][0] == want, page
        assert got[page][1] == {1: "one", 2: "two"}.get(len(want), "mixed")


def test_rows_and_places(spark):
    cells = areas(spark, [(0, 0, 20, 10), (50, 1, 70, 11), (100, 0, 120, 10), (0, 30, 20, 40), (100, 31, 120, 41), (0, 60, 20, 70), (50, 60, 70, 70), (100, 60, 120, 70)])
    none = areas(spark, [(0, 900, 1, 901)])
    rows = layout.recognised_rows(cells, none)
    assert [r.members for r in rows.orderBy("row_no").collect()] == [[0, 1, 2], [3, 4], [5, 6, 7]]
    got = {r.area_id: (r.r, r.c) for r in layout.place_cells(rows, cells).collect()}
    assert got == {0: (0, 0), 1: (0, 1), 2: (0, 2), 3: (1, 0), 4: (1, 2), 5: (2, 0), 6: (2, 1), 7: (2, 2)}
    assert layout.modal_size([3, 3, 2, 2, 5, 7, 7]) == 7 and layout.size_score([3, 2, 5], 3) == 5.5


def test_spans_made_disjoint(spark):
    rows = [(0, 1, 0.9, True, [0, 1], [0, 1, 2]), (0, 2, 0.5, True, [1, 2], [2, 3, 4]), (0, 3, 0.4, False, [5], [0, 1]), (0, 4, 0.3, False, [5], [1, 2])]
    s = spark.createDataFrame(rows, "page_id long, area_id long, score double, header boolean, rs array<long>, cs array<long>")
    got = {r.area_id: (r.rs, r.cs) for r in recognition.disjoint_spans(s).collect()}
    assert got[1] == ([0, 1], [0, 1, 2]) and got[2] == ([1, 2], [3, 4]) and got[3] == ([5], [0, 1]) and 4 not in got
    places = [(r, c) for a, b in got.values() for r in a for c in b]
    assert len(places) == len(set(places))


def test_assignment_is_optimal():
    g = np.random.default_rng(1)
    for n, m in [(1, 1), (3, 3), (2, 5), (5, 2), (6, 6)]:
        for _ in range(20):
            cost = g.normal(size=(n, m)).round(2)
            i, j = evaluation.assign(cost)
            wide = cost if n <= m else cost.T
            best = min(sum(wide[k, p[k]] for k in range(len(wide))) for p in itertools.permutations(range(wide.shape[1]), len(wide)))
            assert len(set(i)) == len(set(j)) == min(n, m) and abs(cost[i, j].sum() - best) < 1e-9


def test_matches_take_the_next_best_box(spark):
    schema = "page_id long, area_id long, label string, score double, x1 double, y1 double, x2 double, y2 double"
    truth = spark.createDataFrame([(0, 1, "a", 1.0, 0.0, 0.0, 10.0, 10.0), (0, 2, "a", 1.0, 3.0, 0.0, 13.0, 10.0)], schema)
    found = spark.createDataFrame([(0, 7, "a", 0.9, 1.0, 0.0, 11.0, 10.0), (0, 8, "a", 0.8, 0.5, 0.0, 10.5, 10.0)], schema)
    got = {r.area_id: r.true_id for r in evaluation.greedy_matches(found, truth).collect()}
    assert got == {7: 1, 8: 2}
    r = evaluation.precision_curves(evaluation.greedy_matches(found, truth), truth).first()
    assert (r.ap, r.recall, r.precision) == (1.0, 1.0, 1.0)
    assert {r.area_id: r.true_id for r in evaluation.optimal_matches(found, truth).collect()} == {7: 2, 8: 1}
    sizes = {r.boxes: r.ap50 for r in evaluation.box_scores(found, truth).collect()}
    assert sizes["all"] == 1.0 and sizes["small"] == 1.0


def picture(spark, a, page=0):
    return spark.createDataFrame([(page, a.shape[1], a.shape[0], bytearray(a.astype(np.uint8).tobytes()))], "page_id long, width int, height int, data binary")


def test_components_and_lines(spark):
    mask = np.zeros((12, 30), bool)
    mask[2:5, 2:5] = mask[5, 5] = mask[8:10, 20:22] = True
    n = images.label(mask)
    assert n.max() == 2 and n[2, 2] == n[5, 5] != n[8, 20]
    ring = np.ones((5, 5), bool)
    ring[1:4, 1:4] = False
    assert images.label(ring).max() == 1
    a = np.full((300, 400), 255)
    a[100:104, 20:380] = 0
    a[150:160, 50:56] = a[150:160, 62:68] = a[150:160, 200:206] = 0
    lines = [tuple(r)[2:] for r in images.ruled_lines(picture(spark, a)).collect()]
    assert len(lines) == 1 and lines[0][0] <= 22 and lines[0][2] >= 378
    chars = images.components(picture(spark, a))
    assert chars.where("category = 'DrawnLine'").count() == 1 and chars.where("category = 'Character'").count() == 3
    text = images.text_lines(chars.where("category = 'Character'"))
    assert text["words"].count() == 2
    assert images.mask_boxes(np.array([mask, np.zeros_like(mask)])).tolist() == [[2, 2, 21, 9], [0, 0, 0, 0]]


def test_crops_and_halves(spark):
    a = np.arange(60).reshape(6, 10)
    p = picture(spark, a, 4)
    cut = images.snippets(p, spark.createDataFrame([(4, 1, 2.0, 1.0, 5.0, 3.0), (4, 2, 50.0, 50.0, 60.0, 60.0)], BOX), 1).collect()
    assert len(cut) == 1 and np.frombuffer(cut[0].data, np.uint8).reshape(cut[0].height, cut[0].width).tolist() == a[0:4, 1:6].tolist()
    assert {r.page_id: r.width for r in images.halves(p).collect()} == {8: 5, 9: 5}
    t = images.transposed(p).first()
    assert (t.width, t.height) == (6, 10) and bytes(t.data) == np.rot90(a).astype(np.uint8).tobytes()
    m = images.masked(p, spark.createDataFrame([(4, 1, 0.0, 0.0, 10.0, 6.0)], BOX), 1, 7).first()
    assert bytes(m.data)[:10] == b"\x07" * 10 and bytes(images.portable(p).first().content).startswith(b"P5 10 6 255\n")
    assert tuple(p.select(images.longest_side(F.lit(400), F.lit(1600)).alias("s")).first().s) == (200, 800)


def test_figures_and_records(spark):
    strokes = areas(spark, [(0, 0, 20, 20), (15, 15, 40, 40), (100, 100, 101, 101)])
    f = spans.figures(strokes)
    assert [(r.x2, r.members) for r in f.collect()] == [(40.0, [0, 1])]
    words = areas(spark, [(10, 10, 12, 12)]).withColumn("content", F.lit("w"))
    caps = areas(spark, [(0, 50, 40, 60), (0, 500, 40, 510)]).withColumn("content", F.concat(F.lit("c"), "area_id"))
    r = writers.figure_records(f, words, caps).first()
    assert r.texts == ["w"] and r.caption == "c0"


def test_exports_of_structure(spark, sf, tmp_path):
    from docloom.operators import tables

    cells = tables.label_flags(tables.upright(grid(spark, sf).where("table_id < 12")))
    one = json.loads(writers.table_structure(cells).orderBy("table_id").first().json)
    assert one["cells"] and one["relations"] and one["triples"][0]["column_path"].startswith("Ex. ")
    assert writers.marked_grid(cells).where("line LIKE '%CL<%'").count() > 0
    g = spark.createDataFrame([(0, [0], [0, 1], True, 'a"'), (0, [1], [0], True, "b"), (0, [1], [1], True, "c"), (0, [2], [0], False, "1"), (0, [2], [1], False, None)], "page_id long, rs array<int>, cs array<int>, header boolean, content string")
    assert [r.line for r in writers.flat_csv(g).orderBy("r").collect()] == ['"a"" | b","a"" | c"', '"1",""']
    assert writers.span_html(g).first().html.startswith('<table><tr><th colspan="2">a"</th></tr><tr><th>b</th>')
    wide = spark.createDataFrame([("x", "1"), (" ", "2")], "glass_id string, v string")
    writers.download(wide, str(tmp_path / "w"))
    assert spark.read.csv(str(tmp_path / "w"), header=True).count() == 1
    shapes = areas(spark, [(0, 0, 1, 1), (0, 0, 2, 2), (1, 1, 3, 3)]).withColumns({"shape": F.element_at(F.array(F.lit("line"), F.lit("rect"), F.lit("bezier")), (F.col("area_id") + 1).cast("int")), "confidence": F.lit(0.5)})
    svg = writers.svg_shapes(shapes, confidence=True).first().svg
    assert svg.count("<line") == svg.count("<rect") == svg.count("<path") == 1 and svg.count("0.50") == 3
    assert writers.drawn_line_rows(shapes.withColumn("category", F.lit("DrawnLine"))).count() == 3
    words = areas(spark, [(0, 0, 1, 1)]).withColumn("content", F.lit("w"))
    assert writers.word_lines(words, True, 2.0, 2.0).first().line == "0\tw\t0.0\t0.0\t2.0\t2.0"
    assert writers.page_texts(areas(spark, [(50, 0, 60, 10), (0, 30, 10, 40), (0, 1, 10, 11)]).withColumn("content", F.concat(F.lit("t"), "area_id"))).first().text == "t2\nt0\nt1"
    assert "created" in json.loads(writers.json_records(wide).first().json)


def test_layout_changes_are_checked(spark):
    p = spark.createDataFrame([("p", 0, 0.0)], "page_id string, rotation int, division double")
    assert revisions.set_layout(p, F.lit(90), F.lit(0.5), F.lit("two")).first().rotation == 90
    for bad in ({"rotation": F.lit(45)}, {"division": F.lit(2.0)}, {"layout": F.lit("odd")}):
        with pytest.raises(Exception, match="layout is|rotation is|division lies"):
            revisions.set_layout(p, **bad).collect()
    areas_ = spark.createDataFrame([(1, "a"), (2, "b")], "area_id long, category string")
    refs = spark.createDataFrame([(9, 1, 0)], "parent_id long, child_id long, pos int")
    with pytest.raises(Exception, match="one of its category"):
        revisions.replace_areas(areas_, refs, spark.createDataFrame([(1, 2)], "old long, new long"))[1].collect()
    assert revisions.add_links(spark.createDataFrame([(1, 2, "x")], "source_id long, target_id long, kind string"), spark.createDataFrame([(1, 2, "x"), (2, 3, "y")], "source_id long, target_id long, kind string")).count() == 2
    pages = spark.createDataFrame([("d", "a", 0)], "doc_id string, page_id string, number int")
    assert {r.page_id: r.number for r in revisions.add_pages(pages, spark.createDataFrame([("d", "b"), ("e", "c")], "doc_id string, page_id string")).collect()} == {"a": 0, "b": 1, "c": 0}
    assert revisions.by_ids(areas_, spark.createDataFrame([(2,), (5,)], "area_id long")).count() == 1


def test_captions(spark):
    lines = ["Table 1: Glass", "Table IV. More", "TABLE", "Tables are nice", "Table 2: X continued", "none", "Table. Own"]
    df = spark.createDataFrame(list(enumerate(lines)), "line_no int, line string").withColumn("doc_id", F.lit(1))
    got = {r.line_no: (r.delimiter, r.number, r.continued) for r in captions.captions(df, keep_most_common=False).collect()}
    assert got[0] == (":", 1, False) and got[1] == (".", 4, False) and got[2][0] == "" and 3 not in got and got[4][2] and 5 not in got
    assert {r.line_no for r in captions.captions(df).collect()} == {0, 4}


def test_metadata(spark):
    lines = spark.createDataFrame([(1, 0, "US 7,123,456 B2"), (1, 1, "US 7,123,456 B2 again"), (1, 2, "EP 1234567")], "doc_id long, line_no int, line string")
    n = titlepage.document_numbers(lines).first()
    assert (n.prefix, n.digits, n.suffixes) == ("US", "7123456", ["B2"])
    rows = [("US7123456B2", 0, "(54)", "", "[EN] Glass"), ("US7123456B2", 1, "(43)", "", "May 3, 2012"), ("US7123456B2", 2, "(51)", "", "C03C 3/091) nan) C03C 3/091")]
    bib = titlepage.bibliography(spark.createDataFrame(rows, "patent_no string, pos int, inid string, criterion string, content string"))
    r = titlepage.metadata(titlepage.document_numbers(lines), bib).first()
    assert (r.title, r.publication_date, r.ipc) == ("Glass", "2012-05-03", ["C03C 3/091"])


def test_corrections(spark):
    words = spark.createDataFrame([("glass", 3), ("glaze", 9), ("gloss", 1)], "word string, n long")
    tokens = spark.createDataFrame([("glasz",), ("12",), ("gla",), (None,)], "token string")
    assert [tuple(r) for r in dictionary.corrections(tokens, words).collect()] == [("glasz", "glass", 1)]
    assert [r.word for r in dictionary.with_prefix(words, "gl").collect()] == ["glaze", "glass", "gloss"]


@pytest.mark.parametrize("distance,shared", [(1, 0), (2, 0), (2, 1), (1, 3)])
def test_corrections_against_all_pairs(spark, distance, shared):
    """Edits anywhere, first letters too; equal to the edit distance of all pairs."""
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(0, 6))) for _ in range(80)} | {"glass"})
    tokens = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(0, 7))) for _ in range(80)} | {"lass", "glas", "xglass", "x" * 5000})
    got = dictionary.close_pairs(spark.createDataFrame([(t,) for t in [*tokens, None]], "token string"), spark.createDataFrame([(w,) for w in [*words, None, words[0]]], "word string"), distance, shared)
    want = [(t, w, edits(t, w)) for t, w in itertools.product(tokens, words) if abs(len(t) - len(w)) <= distance and edits(t, w) <= distance and t[:shared] == w[:shared]]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_service(spark, tmp_path):
    def process(files):
        return files.select("path", F.decode("content", "UTF-8").alias("t")).withColumn("n", F.when(F.col("t") == "bad", F.raise_error(F.lit("no"))).otherwise(F.length("t").cast("string")).cast("int")).drop("t")

    s = Service(spark, str(tmp_path), process)
    good, bad = s.submit("a.json", b"{}"), s.submit("b.json", b"bad")
    assert s.status(good) == "queued" and s.status("x") == "unknown"
    s.work()
    assert (s.status(good), s.status(bad)) == ("done", "failed") and s.result(good).first().n == 2
    assert s.knowledge()["Tg"] == ["Tg"]
    s.update_knowledge({"A": ["a"]})
    assert s.knowledge() == {"A": ["a"]}
    with pytest.raises(ValueError):
        s.update_pipeline([{"name": "p", "modules": [{"name": "Nothing"}]}])
    s.update_pipeline([{"name": "p", "modules": [{"name": "FunctionalRecognizer"}]}])
    assert len(s.pipelines()["p"]) == 1
    s.show(grid(spark, "/root/testdata/sf0.001").where("table_id < 100"), spark.createDataFrame([(1, "t")], "doc_id long, title string"))
    assert spark.table("v_claims").count() > 0 and spark.table("v_metadata").count() == 1


def test_stages(spark, sf, tmp_path):
    b = boxes(spark, sf).where("page_id < 3")
    frames = {"areas": b}
    with pytest.warns(UserWarning, match="sub/super_tolerance"):
        p = pipeline.build({"name": "digital", "modules": [{"name": "LogicalLineGuesser", "parameter": {"subelement": "TableCell", "h_split": 1, "v_split": 2}}, {"name": "CellDetector", "parameter": {"space_between_words": 35, "sub/super_tolerance": 1, "apply_to": "String"}}, {"name": "HeuristicDetector", "parameter": {"apply_to": "Line"}}, {"name": "HeuristicRecognizer"}]})
    out = p.run(frames)
    assert out["cells"].count() > 0 and out["grid"].count() > 0 and out["areas"].count() > b.count()
    with pytest.raises(ValueError, match="register_model"):
        pipeline.Pipeline("m").add("TATRDetection").run({"pages": b, "areas": b})
    modules.register_model("TATRDetection", lambda: lambda batch: batch.head(1).assign(confidence=0.9)[["page_id", "area_id", "x1", "y1", "x2", "y2", "confidence"]], f"{BOX}, confidence double")
    try:
        assert pipeline.Pipeline("m").add("TATRDetection").run({"pages": b, "areas": b})["tables"].count() >= 1
    finally:
        del modules.MODELS["TATRDetection"]
    files = spark.createDataFrame([("T", "Table", "x"), ("c", "TableCell", "x")], "area_id string, category string, doc_id string").withColumns({c: F.lit(1.0) for c in ("x1", "y1", "x2", "y2")})
    assert readers.synthetic_page(files)["refs"].first().child_id == "c"
    labelled = pipeline.Pipeline("s").add("FunctionalRecognizer").add("ExportTableStructureModule", output_dir=str(tmp_path))
    labelled.run({"table_cells": grid(spark, sf).where("table_id < 20")})
    assert spark.read.text(str(tmp_path / "structure")).count() > 0


def test_native_documents_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([("d", "p", 0, 2.0, 2.0)], "doc_id string, page_id string, number int, factor_width double, factor_height double")
    areas_ = spark.createDataFrame([("d", "a", "String", 1.0, 2.0, 3.0, 4.0, "x", 0.5), ("d", "b", "Line", 0.0, 0.0, 9.0, 9.0, None, 0.0)], "doc_id string, area_id string, category string, x1 double, y1 double, x2 double, y2 double, content string, confidence double")
    refs = spark.createDataFrame([("d", "p", "a", 0), ("d", "p", "b", 1)], "doc_id string, parent_id string, child_id string, pos int")
    readers.native_json(pages, areas_, refs).select("json").write.text(str(tmp_path / "n"))
    back = readers.read_native(spark, str(tmp_path / "n"))
    got = {r.area_id: (r.page_id, r.category, r.x1, r.y2, r.content, r.confidence) for r in back["areas"].collect()}
    assert got == {"a": ("p", "String", 1.0, 4.0, "x", 0.5), "b": ("p", "Line", 0.0, 9.0, None, None)}
    assert back["refs"].count() == 2


def test_pipeline_logs_revisions(spark, sf):
    out = pipeline.Pipeline("p").add("FunctionalRecognizer").add("GlassExtractorISC").process_full({"table_cells": grid(spark, sf).where("table_id < 50")})
    assert [(r.rev, r.module) for r in out["revisions"].orderBy("rev").collect()] == [(0, "FunctionalRecognizer"), (1, "GlassExtractorISC")]


def test_document_numbers_of_numbered_rows(spark):
    """A key of six digits is no document number unless ids are names."""
    from docloom.operators import titlepage

    lines = spark.createDataFrame([(123456, 1, "US 7000001 B2"), (123457, 1, "no number")], "doc_id long, line_no int, line string")
    assert [r.number for r in titlepage.document_numbers(lines, by_id=False).collect()] == ["US7000001B2"]
    assert {r.number for r in titlepage.document_numbers(lines).collect()} == {"123456", "123457"}


def test_judged_boxes_take_turns(spark):
    """Many detections that want the same few true boxes, against taking turns one by one; five labels a page and crowds."""
    import random

    from docloom.operators import evaluation

    rng = random.Random(3)
    box = lambda: (x := rng.randint(0, 6), y := rng.randint(0, 6), x + rng.randint(20, 45), y + rng.randint(20, 45))
    cols = "page_id long, label string, area_id long, score double, x1 double, y1 double, x2 double, y2 double"
    det = [(p, "abc"[i % 3], i, rng.randint(0, 4) / 4, *map(float, box())) for p in range(3) for i in range(45)]
    true = [(p, "abc"[i % 3], i, *map(float, box()), i % 7 == 0) for p in range(3) for i in range(30)]
    got = evaluation.judged_boxes(spark.createDataFrame(det, cols), spark.createDataFrame(true, "page_id long, label string, area_id long, x1 double, y1 double, x2 double, y2 double, crowd boolean"), most=12).collect()
    want = set()
    area = lambda b: (b[2] - b[0]) * (b[3] - b[1])
    for p in range(3):
        for label in "abc":
            turn = sorted((d for d in det if d[:2] == (p, label)), key=lambda d: (-d[3], d[2]))[:12]
            for name, (low, high) in evaluation.SIZES.items():
                for o in evaluation.OVERLAPS:
                    taken = set()
                    for place, d in enumerate(turn, 1):
                        asked = []
                        for t in (t for t in true if t[:2] == (p, label)):
                            inter = max(0, min(d[6], t[5]) - max(d[4], t[3])) * max(0, min(d[7], t[6]) - max(d[5], t[4]))
                            iou = inter / area(d[4:]) if t[7] else inter / (area(d[4:]) + area(t[3:7]) - inter)
                            if iou >= o and t[2] not in taken:
                                asked.append((t[7] or not low <= area(t[3:7]) <= high, -iou, -t[2], t[7]))
                        best = min(asked, default=None)
                        if best and not best[3]:
                            taken.add(-best[2])
                        want.add((p, label, d[2], d[3], place, name, o, best is not None, best[0] if best else not low <= area(d[4:]) <= high))
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_rows_in_orders_by_the_plain_rule():
    """Rows of boxes as the plain rule makes them, box by box, with lines that stop some."""
    rng = np.random.default_rng(5)
    for _ in range(40):
        n = int(rng.integers(1, 30))
        x, y = rng.integers(0, 120, n), rng.integers(-5, 40, n) + rng.integers(0, 2, n) / 2
        b, flat = np.c_[x, y, x + rng.integers(1, 30, n), y + rng.integers(4, 12, n)].astype(float), np.sort(rng.integers(0, 40, 3)).astype(float)
        orders = (np.arange(n), rng.permutation(n))

        def plain(order):
            rows = []
            for i in order:
                for row in rows:
                    level = [j for j in row if abs(b[j, 1] - b[i, 1]) <= 5 or abs(b[j, 3] - b[i, 3]) <= 5]
                    if level and not any(b[j, 0] <= b[i, 2] and b[j, 2] >= b[i, 0] for j in row):
                        if not any(int(min(b[i, 1], b[level[0], 1])) <= f < int(max(b[i, 3], b[level[0], 3])) for f in flat):
                            row.append(int(i))
                            break
                else:
                    rows.append([int(i)])
            return sorted(rows, key=lambda g: b[g, 1].min())

        assert layout._rows_in_orders(b, orders, flat, 5.0) == [plain(o) for o in orders]


def test_placed_cells_need_no_join(spark, sf):
    from docloom import catalogue

    plan = catalogue.queries()["placed_cells"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "InPandas" not in plan


def test_recall_precision_over_ranges(spark):
    """Detections of equal scores fall into several ranges: the steps are those of one list."""
    rng = np.random.default_rng(11)
    judged = [(int(p), "a", i, round(float(s), 1), int(k), [int(x) for x in f]) for i, (p, s, k, f) in enumerate(zip(rng.integers(0, 9, 600), rng.random(600), rng.integers(1, 15, 600), rng.choice([0, 1, 2], (600, 4), p=[0.4, 0.5, 0.1])))]
    wide = spark.createDataFrame(judged, "page_id long, label string, area_id long, score double, place int, found array<byte>")
    truth = spark.createDataFrame([(0, "a", i, 0.0, 0.0, 10.0, 10.0) for i in range(700)], "page_id long, label string, area_id long, x1 double, y1 double, x2 double, y2 double")
    got = {(r.boxes, r.most): (r.ap, r.recall) for r in evaluation.recall_precision(wide, truth, (0.5,), (1, 10)).collect()}
    assert set(got) == {(k, m) for k in ("all", "small") for m in (1, 10)}
    for (boxes, most), (ap, recall) in got.items():
        at, tp, steps = list(evaluation.SIZES).index(boxes), 0, []
        listed = [r[5][at] for r in sorted(judged, key=lambda r: (-r[3], r[0], r[2])) if r[4] <= most and r[5][at] < 2]
        for seen, hit in enumerate(listed, 1):
            tp += hit
            steps.append((tp * 100 // 700, tp / seen))
        want = sum(max((p for k, p in steps if k >= i), default=0) for i in range(101)) / 101
        assert abs(ap - want) < 1e-9 and recall == tp / 700


@pytest.mark.parametrize("name", ["detection_sizes", "detection_precision"])
def test_pages_are_matched_once(spark, sf, name):
    from docloom import catalogue

    plan = catalogue.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1 and "InPandas" not in plan
