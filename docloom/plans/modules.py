"""The remaining stages of pipelines: imports, detection, layout, recognition, extraction and exports.

Stages take named tables: ``areas`` (page_id, area_id, category, box, content, confidence), ``refs``, ``pages``, ``images``
(see ``sources.images``), ``table_cells`` (see ``plans.fixtures.grid``), ``lines`` (doc_id, line_no, line). Stages around a
model look it up among the plug-ins (``register_model``) and fail with its name when there is none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import knowledge
from ..operators import captions, cluster, density, dictionary, layout, raster, references, revisions, structure, tables, titlepage
from ..sources import images as pictures
from ..operators.graph import cut
from ..sources import pdf, readers, spans, writers
from .pipeline import Tables, stage

MODELS: dict[str, tuple[Callable, str]] = {}


def register_model(name: str, load: Callable[[], Callable], schema: str) -> None:
    """A plug-in for a stage: ``load`` runs once per task and gives a function from a batch of rows to rows of the schema."""
    MODELS[name] = (load, schema)


def _model(name: str, rows: DataFrame) -> DataFrame:
    if name not in MODELS:
        raise ValueError(f"{name} needs a model: register_model({name!r}, load, schema)")
    return structure.apply_model(rows, *MODELS[name])


def _of(frames: Tables, *categories: str) -> DataFrame:
    return frames["areas"].where(F.col("category").isin(*categories))


def _with(frames: Tables, more: DataFrame, category: str) -> Tables:
    """The areas with more boxes of a category, numbered on."""
    new = more.select("page_id", *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]).withColumn("category", F.lit(category))
    placed = revisions.area_ids(new, frames["areas"])
    return {"areas": frames["areas"].unionByName(placed, allowMissingColumns=True)}


# ---- imports ----


@stage("ImportSwitch")
def import_files(frames: Tables, dpi=300) -> Tables:
    """Uploads by their format; table annotations and native documents from their texts."""
    files = frames["uploads"]
    return {f"{kind}_files": files.where(F.col("format") == kind) for kind in ("native", "table", "xml", "image", "pdf")}


@stage("JSONImport")
def import_json(frames: Tables, path="") -> Tables:
    return readers.read_native(frames["session"].sparkSession, path)


@stage("DIWTableImport")
def import_tables(frames: Tables, path="") -> Tables:
    areas = readers.read_table_json(frames["session"].sparkSession, path)
    return {"areas": areas, **readers.synthetic_page(areas)}


@stage("PageXMLImport")
def import_xml(frames: Tables, path="", dpi=300) -> Tables:
    return {"xml_lines": readers.read_page_xml(frames["session"].sparkSession, path)}


@stage("ImageImport")
def import_images(frames: Tables, path="") -> Tables:
    return {"pages": readers.read_images(frames["session"].sparkSession, path)}


@stage("PDFConverter")
def convert(frames: Tables, keep_chars=False, extract_drawn_figures=False, dpi=300) -> Tables:
    """Words of spans, and strokes and figures of drawings: of the PDF files in ``pdf_files`` (doc_id, content), or as an extractor plug-in hands them over in ``spans`` and ``drawings``."""
    if "pdf_files" in frames and "spans" not in frames:
        found = pdf.pdf_tables(frames["pdf_files"])
        # written once, so that a page keeps its number
        pages = cut(found["pages"].withColumn("number", F.col("page_id")).withColumn("page_no", F.monotonically_increasing_id()), "pdf-pages")
        own = lambda name: found[name].join(pages.select("doc_id", "page_id", "page_no"), ["doc_id", "page_id"]).withColumn("page_id", F.col("page_no")).drop("page_no", "doc_id")
        told = {"pdf_pages": pages.withColumn("page_id", F.col("page_no")).drop("page_no"), "spans": own("words"), "drawings": own("items"), "pdf_images": own("images"), "pdf_errors": found["errors"]}
        return told | convert({**frames, **told}, keep_chars, extract_drawn_figures, dpi)
    words = spans.fold_spans(frames["spans"])
    out = {"words": words}
    if extract_drawn_figures and "drawings" in frames:
        drawn = spans.strokes(spans.drawn_items(frames["drawings"]))
        out |= {"strokes": drawn, "figures": spans.figures(drawn)}
    return out


# ---- models ----


@stage("TATRDetection")
def detect_tables(frames: Tables, adjust_to=(), only_captions=False, device="cpu", config=None, threshold=0.5, nms_threshold=0.5, iterations=1, model="", extend_to_lines=False) -> Tables:
    """Tables of a detector over the threshold, suppressed by score, stretched to drawn lines, with their captions."""
    found = _model("TATRDetection", frames["pages"]).where(F.col("confidence") >= float(threshold))
    kept = cluster.nms(found, float(nms_threshold), "score", "iou").select("page_id", F.col("group_id").alias("area_id"), "x1", "y1", "x2", "y2", F.col("score").alias("confidence"))
    return {"tables": kept, **_with(frames, kept, "Table")}


@stage("TATRRecognition")
def recognise_tables(frames: Tables, threshold=0.5) -> Tables:
    """Rows, columns and spanning cells of a recogniser as a grid of cells with their texts and confidence."""
    from ..operators import recognition

    found = _model("TATRRecognition", frames["tables"]).where(F.col("score") >= float(threshold))
    kind = lambda c: found.where(F.col("label") == c)
    tokens = frames["tokens"]
    rows = recognition.ordered(recognition.holding(kind("row"), tokens), "y", "r")
    heads = structure.header_rows(rows, kind("header")).select("page_id", "r", F.lit(True).alias("header"))
    rows = rows.join(heads, ["page_id", "r"], "left").fillna({"header": False})
    columns = recognition.ordered(recognition.holding(kind("column"), tokens), "x", "c")
    found_spans = recognition.header_tree(recognition.disjoint_spans(recognition.aligned_spans(kind("span"), rows, columns)))
    cells = recognition.grid_cells(rows, columns, found_spans)
    return {"grid": recognition.cell_texts(cells, recognition.slotted(cells, tokens), tokens), "confidences": recognition.table_confidence(cells, tokens)}


@stage("GuppyOCRModule")
def read_lines(frames: Tables, model_path="", apply_to=("OCRLine",), add_new_area=None, split_words=False, batch_size=16, padding=(0, 0), device="cpu") -> Tables:
    """Texts of line snippets; with ``split_words`` also their words."""
    kinds = [apply_to] if isinstance(apply_to, str) else list(apply_to)
    read = _model("GuppyOCRModule", pictures.snippets(frames["images"], _of(frames, *kinds), int(padding[0])))
    lines = frames["areas"].drop("content").join(read.select("page_id", "area_id", "content"), ["page_id", "area_id"], "left")
    out = {"areas": lines}
    if split_words:
        out["words"] = structure.split_words(lines.where("content IS NOT NULL").withColumnRenamed("area_id", "id"))
    return out


def _page_reader(name: str):
    def read(frames: Tables, mode="Page", lang="eng", add_new_area=("OCRLine", "OCRString")) -> Tables:
        return {"ocr_lines": pictures.ocr_lines(_model(name, frames["images"]))}

    stage(name)(read)


for _name in ("TesseractOCRModule", "PaddleOCRModule"):
    _page_reader(_name)


@stage("BaselineDetector")
def detect_baselines(frames: Tables, model_path=(), whitespace_size=15, max_width=1000, max_height=25, device="cpu") -> Tables:
    """Baselines of a segmenter: small ones merged to the right; too large ones are left out."""
    found = _model("BaselineDetector", frames["images"])
    small = found.where((F.col("x2") - F.col("x1") <= float(max_width)) & (F.col("y2") - F.col("y1") <= float(max_height)))
    return _with(frames, layout.merge_baselines(small, float(whitespace_size)), "OCRLine")


@stage("ConnectedComponentOCRModule")
def detect_components(frames: Tables, mode="Page", lang="", add_new_area=("OCRLine", "OCRString", "OCRChar"), split_words=False, character_distance=16, ignore_overlap_merge_char=3, word_distance=24, ignore_overlap_merge_word=3, reference_mode="page") -> Tables:
    """Characters, words and lines from the dark components of page images."""
    found = pictures.components(frames["images"])
    chars = found.where("category = 'Character'")
    return {"ocr_chars": chars, "ocr_drawn": found.where("category = 'DrawnLine'"), **{f"ocr_{k}": v for k, v in pictures.text_lines(chars, float(character_distance), float(word_distance)).items()}}


# ---- layout ----


@stage("LineDetectorCanny")
def detect_lines(frames: Tables, max_line_gap=10, min_line_length=200, minimum_number_of_votes=10) -> Tables:
    """Ruled and slanted lines of page images; segments whose pixels cluster count as one line."""
    points = raster.outline_points(raster.ink_runs(frames["images"]))
    found = raster.straight_lines(points, 180, int(minimum_number_of_votes), float(min_line_length), float(max_line_gap)).withColumnRenamed("line_id", "area_id")
    flat = found.withColumn("low", F.least("y1", "y2")).withColumn("y2", F.greatest("y1", "y2")).withColumn("y1", F.col("low")).drop("low")
    return {"straight_lines": found, "line_clusters": density.line_clusters(flat), **_with(frames, flat, "DrawnLine")}


@stage("ParagraphDetector")
def detect_paragraphs(frames: Tables, lines="Line", strings="String", gap_x=10.0, gap_y=10.0) -> Tables:
    """Paragraphs of the page images' ink, without images as text lines near each other; and the columns of each page."""
    own = _of(frames, lines)
    found = cluster.merge_boxes(own, float(gap_x), float(gap_y))
    if "images" in frames:
        ink = raster.paragraph_boxes(raster.ink_runs(frames["images"])).select("page_id", F.col("group_id").alias("area_id"), *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])
        found = cluster.merge_boxes(ink, 0.0, 0.0, rounds=1000)
    out = _with(frames, found, "Paragraph")
    if "pages" in frames:
        out["layouts"] = layout.page_columns(own, frames["pages"].select("page_id", "img_width", "img_height"))
    return out


@stage("HeuristicDetector")
def heuristic_tables(frames: Tables, whitespace_pixel_size=10, threshold_height_diff=5, threshold_vertical_translation=5, irregular_row_skips=1, distance_between_rows=100, alignment_tolerance=5, apply_to="Line") -> Tables:
    found = layout.candidate_tables(_of(frames, apply_to), 1000, float(threshold_height_diff), float(threshold_vertical_translation), int(irregular_row_skips), float(distance_between_rows), float(alignment_tolerance))
    return {"tables": found, **_with(frames, found, "Table")}


@stage("HeuristicRecognizer")
def heuristic_rows(frames: Tables, threshold_vertical_translation=5, apply_to=("TableCell",), table_grid=("DrawnLine", "LogicalLine", "DrawnRectangle"), lines="Line", strings="String") -> Tables:
    cells = _of(frames, *([apply_to] if isinstance(apply_to, str) else apply_to))
    rows = layout.recognised_rows(cells, _of(frames, *table_grid), float(threshold_vertical_translation))
    return {"rows": rows, "grid": layout.place_cells(rows, cells)}


# ---- texts ----


@stage("CaptionDetector")
def detect_captions(frames: Tables, keywords=captions.KEYWORDS, delimiters=captions.DELIMITERS, removal=captions.CONTINUED, lines="Line", strings="String", expansion_threshold=5, keep_most_common=False) -> Tables:
    """Caption lines with their numbers; with areas, also grown by their neighbours."""
    text = lambda v: tuple(v.split(";")) if isinstance(v, str) else tuple(v)
    found = captions.captions(frames["lines"], text(keywords), text(delimiters), text(removal), bool(keep_most_common))
    out = {"captions": found}
    if "areas" in frames and "caption_areas" in frames:
        out["caption_areas"] = captions.grown(frames["caption_areas"], _of(frames, lines, strings), _of(frames, "DrawnLine"), float(expansion_threshold))
    return out


@stage("CaptionTableLocalizer")
def locate_tables(frames: Tables, table_direction="below", minimum_distance_line_caption=10, caption="Caption", strings="String") -> Tables:
    """Tables as the hulls of the texts below each caption, down to the next one."""
    found = captions.limited(_of(frames, strings), _of(frames, caption))
    boxes = found.join(frames["areas"].select("page_id", "area_id", "x1", "y1", "x2", "y2"), ["page_id", "area_id"])
    hulls = boxes.groupBy("page_id", F.col("caption").alias("caption_id")).agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    return {"tables": hulls, "longest_lines": captions.longest_lines(_of(frames, "DrawnLine")), **_with(frames, hulls, "Table")}


@stage("MergeOCRModule")
def merge_ocr(frames: Tables, mode="Page", existing_text="String", merging_text="OCRString", existing_lines="Line", merging_lines="OCRLine", prev_revisions_to_merge=2) -> Tables:
    return {"merged": structure.merge_ocr(_of(frames, existing_text), _of(frames, merging_text))}


@stage("DictionaryCorrectorModule")
def correct(frames: Tables, dict_path="", distance=1, distance_type="levenshtein", apply_to="String") -> Tables:
    """Close dictionary words of texts that are no numbers and no prefixes of known words."""
    words = frames["words"] if "words" in frames else readers.read_words(frames["areas"].sparkSession, dict_path)
    return {"corrections": dictionary.corrections(_of(frames, apply_to).select(F.col("content").alias("token")), words, int(distance))}


@stage("MetadataExtractor")
def extract_metadata(frames: Tables, lines="Line", strings="String", string="String") -> Tables:
    """Document numbers; with ``bibliography`` rows (patent_no, pos, inid, criterion, content) also their records, with ``title_areas`` and
    ``title_pages`` what title pages say where there is no such record."""
    numbers = titlepage.document_numbers(frames["lines"])
    out = {"document_numbers": numbers}
    if "bibliography" in frames:
        records = titlepage.bibliography(frames["bibliography"])
        out["metadata"] = titlepage.documents_metadata(numbers, records, frames["title_areas"], frames["title_pages"]) if "title_areas" in frames else titlepage.metadata(numbers, records)
    elif "title_areas" in frames:
        out["metadata"] = titlepage.from_title_page(frames["title_areas"], frames["title_pages"])
    return out


@stage("GlassExtractor")
def extract_plain(frames: Tables, lines="Line", strings="String", knowledge="knowledge.json") -> Tables:
    """Setpoints without the fallback dictionary."""
    points = tables.setpoints(frames["table_cells"], _known(frames, knowledge))
    return {"setpoints": points, "steps": tables.extraction(points)}


def _known(frames: Tables, path: str) -> dict:
    return knowledge.load(frames["table_cells"].sparkSession, path if "/" in path else None)


@stage("PageModifierUtilityModule")
def split_pages(frames: Tables) -> Tables:
    return {"images": pictures.halves(frames["images"])}


# ---- exports ----


@stage("ExportPageXMLModule")
def export_xml(frames: Tables, output_dir="output", mode="text", text_category="String", line_category="Line", drawn_line_category="DrawnLine", confidence_threshold=-1, optimize_baseline=False, bb_pad=0, prefix="", format="xml", write_to_file=True) -> Tables:
    rows = writers.page_lines(frames["words"], float(bb_pad)) if mode == "text" else writers.drawn_line_rows(frames["areas"], drawn_line_category)
    if write_to_file:
        writers.write_page_xml(rows, f"{output_dir}/{prefix}{mode}")
    return {"xml_rows": rows}


@stage("ExportJSONModule")
def export_json(frames: Tables, output_dir="output", include_pictures=False, prefix="") -> Tables:
    writers.document_json(frames["documents"], include_pictures).select("json").write.text(f"{output_dir}/{prefix}documents")
    return {}


@stage("ExportTableStructureModule")
def export_structure(frames: Tables, output_dir="output", table_category_name="Table", elementwise_export=False, prefix="") -> Tables:
    labelled = frames["labels"] if "labels" in frames else tables.label_flags(tables.upright(frames["table_cells"]))
    writers.table_structure(labelled).select("json").write.text(f"{output_dir}/{prefix}structure")
    return {}


@stage("ExportTextModule")
def export_text(frames: Tables, output_dir="output", lines="Line", strings="String", prefix="") -> Tables:
    writers.page_texts(_of(frames, lines)).select(F.col("text").alias("value"), "page_id").write.partitionBy("page_id").text(f"{output_dir}/{prefix}text")
    return {}


@stage("ExportWordsModule")
def export_words(frames: Tables, output_dir="output", export_bbs=False, bbs_format="image", lines="Line", strings="String", prefix="") -> Tables:
    writers.write_lines(writers.word_lines(_of(frames, strings), bool(export_bbs)), f"{output_dir}/{prefix}words", "page_id")
    return {}


@stage("ExportImageModule")
def export_images(frames: Tables, output_dir="output", category="Page", prefix="") -> Tables:
    """Pages, or snippets of a category, as portable grey images in a Parquet table."""
    rows = frames["images"] if category == "Page" else pictures.snippets(frames["images"], _of(frames, category))
    pictures.portable(rows).write.parquet(f"{output_dir}/{prefix}images")
    return {}


@stage("ExportMaskedImageModule")
def export_masked(frames: Tables, output_dir="output", type=("String",), color=("red",), thickness=2, annotate_confidence=False, annotate_bb=False, annotate_id=False, prefix="") -> Tables:
    pictures.portable(pictures.masked(frames["images"], _of(frames, *type), int(thickness))).write.parquet(f"{output_dir}/{prefix}masked")
    return {}


@stage("ExportMaskedSVGModule")
def export_svg(frames: Tables, output_dir="output", type=("String",), color=("red",), thickness=2, annotate_confidence=False, annotate_bb=False, prefix="") -> Tables:
    shapes = _of(frames, *type).withColumn("shape", F.lit("rect"))
    writers.svg_shapes(shapes, color[0], int(thickness), bool(annotate_confidence)).select(F.col("svg").alias("value"), "page_id").write.partitionBy("page_id").text(f"{output_dir}/{prefix}svg")
    return {}


@stage("ExportDrawnFiguresModule")
def export_figures(frames: Tables, output_dir="output", apply_to="DrawnFigure", export_references=True, export_img=True, export_overlapping_text=True, filter_smaller_areas=150, flat_export=False, prefix="") -> Tables:
    rows = writers.figure_records(frames["figures"], _of(frames, "String"), _of(frames, "Caption"), float(filter_smaller_areas))
    rows.write.json(f"{output_dir}/{prefix}figures")
    return {"figure_records": rows}


@stage("RevisionModule")
def revise(frames: Tables, rev=1) -> Tables:
    """The areas with the number of the revision that added them."""
    return {"areas": frames["areas"].withColumn("rev", F.lit(int(rev)))}


@stage("ReferenceCleanup")
def clean_references(frames: Tables) -> Tables:
    return {"refs": references.cleanup(frames["refs"], frames["areas"])}
