"""Stages by name and pipelines from JSON: each stage turns named tables into named tables.

A configuration is a list of ``{"name": ..., "modules": [{"name": ..., "parameter": {...}}]}``. Unknown stages
are errors when the pipeline is built, not when it runs; so are unknown parameters, except in configuration
files, whose parameters that a stage doesn't have are left out with a warning.
"""

from __future__ import annotations

import inspect
import json
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.knowledge import load as load_knowledge
from ..operators import chains, cluster, layout, spatial, tables

Tables = dict[str, DataFrame]
STAGES: dict[str, Callable] = {}


def stage(name: str):
    """Register a stage: a function (tables, **parameters) -> tables to replace or add."""

    def keep(f):
        STAGES[name] = f
        return f

    return keep


def parameters(name: str) -> dict:
    """A stage's parameters with their defaults."""
    return {k: p.default for k, p in list(inspect.signature(STAGES[name]).parameters.items())[1:]}


@dataclass
class Pipeline:
    """An ordered list of (stage name, parameters)."""

    name: str
    steps: list[tuple[str, dict]] = field(default_factory=list)

    def add(self, module: str, **parameter) -> Pipeline:
        if module not in STAGES:
            raise ValueError(f"unknown stage {module}")
        if odd := set(parameter) - set(parameters(module)):
            raise ValueError(f"{module} has no parameter {', '.join(sorted(odd))}")
        self.steps.append((module, parameter))
        return self

    def __len__(self) -> int:
        return len(self.steps)

    def run(self, frames: Tables, only: list[int] | None = None) -> Tables:
        """All steps, or those at the given places."""
        for i, (module, parameter) in enumerate(self.steps):
            if only is None or i in only:
                frames = {**frames, **STAGES[module](frames, **parameter)}
        return frames

    def process_full(self, frames: Tables) -> Tables:
        """All steps, with a table ``revisions`` (rev, module, tables changed): one revision for each step."""
        spark, log = next(iter(frames.values())).sparkSession, []
        for rev, (module, parameter) in enumerate(self.steps):
            changed = STAGES[module](frames, **parameter)
            frames = {**frames, **changed}
            log.append((rev, module, sorted(changed)))
        return {**frames, "revisions": spark.createDataFrame(log, "rev int, module string, tables array<string>")}

    def process(self, frames: Tables):
        """Step by step: yields (tables, stage name, state)."""
        for module, parameter in self.steps:
            frames = {**frames, **STAGES[module](frames, **parameter)}
            yield frames, module, "done"


def load(spark: SparkSession, path: str) -> dict[str, Pipeline]:
    """Named pipelines from a JSON file."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return {p["name"]: build(p) for p in json.loads(text)}


def build(config: dict) -> Pipeline:
    out = Pipeline(config["name"])
    for m in config["modules"]:
        given, known = m.get("parameter") or m.get("parameters") or {}, parameters(m["name"]) if m["name"] in STAGES else None
        if known is not None and (odd := sorted(set(given) - set(known))):
            warnings.warn(f"{m['name']} leaves out {', '.join(odd)}", stacklevel=2)
            given = {k: v for k, v in given.items() if k in known}
        out.add(m["name"], **given)
    return out


@stage("DeleteUtilityModule")
def delete(frames: Tables, delete=("String",), last=None) -> Tables:
    """Areas of the categories, or those of them that the ``last`` so many revisions added, and references to them go."""
    if last is not None:
        from ..operators.revisions import delete_recent

        kept = delete_recent(frames["areas"], list(delete), int(last), "page_id")
        return {"areas": kept}
    gone = frames["areas"].where(F.col("category").isin(*delete)).select("area_id")
    out = {"areas": frames["areas"].join(gone, "area_id", "left_anti")}
    if "refs" in frames:
        from ..operators.references import delete as drop

        out["refs"] = drop(frames["areas"], frames["refs"], gone)[1]
    return out


@stage("CellDetector")
def cells(frames: Tables, apply_to="String", lines="Line", strings="String", drawn_elements=("DrawnLine", "LogicalLine"), space_between_words=35.0, space_between_lines=0.0, size_difference_tolerance=2.0) -> Tables:
    a = frames["areas"]
    kinds = [apply_to] if isinstance(apply_to, str) else list(apply_to)
    found = cluster.first_fit_cells(a.where(F.col("category").isin(*kinds)), a.where(F.col("category").isin(*drawn_elements)), float(space_between_words), float(size_difference_tolerance))
    return {"cells": found}


@stage("MarkovChainRecognizer")
def rows(frames: Tables, threshold_vertical_translation=3.0, lines="Line", strings="String", apply_to=("TableCell",), table_grid=("DrawnLine", "LogicalLine"), max_iterations=10, convergence_threshold=0.1) -> Tables:
    """Rows of cells that no flat line of ``table_grid`` parts, by walks until two groupings agree; and the probable number of columns."""
    grid = frames["areas"].where(F.col("category").isin(*table_grid) & (F.col("y2") - F.col("y1") <= F.col("x2") - F.col("x1")))
    found = chains.row_chains(frames["cells"].withColumn("area_id", F.col("group_id")), grid, float(threshold_vertical_translation), int(max_iterations), float(convergence_threshold))
    return {"rows": found, "widths": chains.probable_width(found)}


@stage("FunctionalRecognizer")
def functional(frames: Tables, no_predefined_column_labels=1, no_predefined_row_labels=1, common_prefixes="No\\.;Ex\\.;Number;Example", enforce_ordererd_numbering=False) -> Tables:
    grid = frames["table_cells"]
    return {"labels": tables.label_flags(tables.upright(grid), no_predefined_column_labels, no_predefined_row_labels), "orientation": tables.orientation(tables.numbering_runs(grid))}


@stage("GlassExtractorISC")
def extract(frames: Tables, knowledge_path=None, lines="Line", strings="String", string="String", knowledge=None, knowledge_fallback=None) -> Tables:
    """Setpoints by the dictionary at ``knowledge_path``, else at ``knowledge`` or ``knowledge_fallback`` if those are paths of folders, else the default."""
    path = next((p for p in (knowledge_path, knowledge, knowledge_fallback) if p and "/" in p), None)
    points = tables.setpoints(frames["table_cells"], load_knowledge(frames["table_cells"].sparkSession, path))
    return {"setpoints": points, "steps": tables.extraction(points), "claims": tables.claims(frames["table_cells"])}


@stage("TableLocalizer")
def captions(frames: Tables, table="Table", caption="Caption") -> Tables:
    a = frames["areas"]
    return {"captions": spatial.nearest_once(a.where(F.col("category") == table), a.where(F.col("category") == caption), lambda x, y: x.meets_x(y), lambda x, y: x.gap_y(y))}


@stage("LogicalLineGuesser")
def logical_lines(frames: Tables, apply_to=("Table",), subelement="TableCell", gap_between_rows=3.0, gap_between_columns=3.0, h_split=1, v_split=2, merge_radius_vertical=20.0, merge_radius_horizontal=20.0) -> Tables:
    """Vertical and horizontal lines in the white gaps of the boxes, merged over the parts of a page."""
    a = frames["areas"].where(F.col("category") == subelement) if "category" in frames["areas"].columns else frames["areas"]
    upright = layout.merge_lines(layout.logical_lines(a, float(gap_between_columns), int(v_split), "x"), float(merge_radius_vertical), True)
    flat = layout.merge_lines(layout.logical_lines(a, float(gap_between_rows), int(h_split), "y"), float(merge_radius_horizontal), False)
    return {"logical_lines": upright.withColumn("vertical", F.lit(True)).unionByName(flat.withColumn("vertical", F.lit(False))), "parts": tables.split_parts(a, int(v_split))}


@stage("NonMaximumSuppression")
def suppress(frames: Tables, threshold=0.1, mode="merge", measure="own") -> Tables:
    return {"merged": cluster.nms(frames["areas"], float(threshold), mode, measure)}


@stage("ExportTableContentModule")
def export_tables(frames: Tables, output_dir="output", format="csv") -> Tables:
    from ..sources import writers

    grid = tables.upright(frames["table_cells"])
    lines = writers.markdown_lines(grid) if format == "md" else writers.table_lines(grid, writers.DELIMITER[format])
    writers.write_lines(lines, output_dir)
    return {}


@stage("ExportCOCOModule")
def export_coco(frames: Tables, output_dir="output", type=("Table",)) -> Tables:
    from ..sources import writers

    chosen = frames["areas"].where(F.col("category").isin(*type))
    writers.coco_annotations(chosen).write.json(f"{output_dir}/annotations")
    writers.coco_categories(chosen).write.json(f"{output_dir}/categories")
    return {}


from . import modules  # noqa: E402, F401  registers the other stages
