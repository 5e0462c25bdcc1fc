"""Table-structure post-processing, OCR merging and detection metrics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import Box


def apply_model(pages: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str, batch_size: int = 8) -> DataFrame:
    """Detections or recognised text from a model: ``load`` runs once per task, its result once for so many rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load()
        for batch in batches:
            for k in range(0, len(batch), batch_size):
                yield predict(batch.iloc[k : k + batch_size])

    return pages.mapInPandas(run, schema)


def softmax_top(logits: Column) -> Column:
    """Index and probability of the largest logit."""
    e = F.transform(logits, lambda x: x.cast("double"))
    top = F.array_max(e)
    return F.struct((F.array_position(e, top) - 1).cast("int").alias("label"), (1 / F.aggregate(F.transform(e, lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)).alias("score"))


def above_thresholds(objects: DataFrame, thresholds: dict, default: float = 0.5) -> DataFrame:
    """Detections whose score reaches their label's threshold."""
    t = F.lit(default)
    for label, value in thresholds.items():
        t = F.when(F.col("label") == label, value).otherwise(t)
    return objects.where(F.col("score") >= t)


def header_rows(rows: DataFrame, headers: DataFrame, share: float = 0.5) -> DataFrame:
    """Rows (page_id, r, y1, y2) whose height a header covers by the share, as far as they run on from row 0."""
    cover = F.greatest(F.least(F.col("a.y2"), F.col("h.y2")) - F.greatest(F.col("a.y1"), F.col("h.y1")), F.lit(0.0))
    on = (F.col("a.page_id") == F.col("h.page_id")) & (cover >= share * (F.col("a.y2") - F.col("a.y1")))
    met = rows.alias("a").join(headers.alias("h"), on, "left_semi")
    w = Window.partitionBy("page_id").orderBy("r")
    return met.withColumn("k", F.row_number().over(w) - 1).where("k = r").drop("k")


def span_lines(spans: DataFrame, lines: DataFrame, axis: str = "y", share: float = 0.5) -> DataFrame:
    """First and last row (axis y) or column (axis x) that a spanning cell covers by the share."""
    lo, hi = f"{axis}1", f"{axis}2"
    cover = F.greatest(F.least(F.col(f"a.{hi}"), F.col(f"l.{hi}")) - F.greatest(F.col(f"a.{lo}"), F.col(f"l.{lo}")), F.lit(0.0))
    on = (F.col("a.page_id") == F.col("l.page_id")) & (cover >= share * (F.col(f"l.{hi}") - F.col(f"l.{lo}")))
    met = spans.alias("a").join(lines.alias("l"), on)
    return met.groupBy(F.col("a.page_id").alias("page_id"), F.col("a.area_id").alias("area_id")).agg(F.min("l.r").alias("first"), F.max("l.r").alias("last"), F.count("*").alias("n"))


def confidence(scores: DataFrame, key: str) -> DataFrame:
    """Mean of average and least slot score; 0 without scores."""
    return scores.groupBy(key).agg(F.coalesce((F.avg("share") + F.min("share")) / 2, F.lit(0.0)).alias("confidence"))


def merge_data(a: Column, b: Column) -> Column:
    """Two string maps: values under one key are joined, others kept."""
    return F.map_zip_with(a, b, lambda k, x, y: F.when(x.isNull(), y).when(y.isNull(), x).otherwise(F.concat(x, y)))


def merge_areas(pairs: DataFrame) -> DataFrame:
    """Pairs of areas (aliases a and b) as one: the hull, joined string data, the larger confidence, and the first's id."""
    a, b = Box.of("a"), Box.of("b")
    return pairs.select(F.col("a.page_id").alias("page_id"), F.col("a.area_id").alias("area_id"), *a.union(b).columns(), merge_data(F.col("a.data"), F.col("b.data")).alias("data"), F.greatest("a.confidence", "b.confidence").alias("confidence"))


def split_words(lines: DataFrame) -> DataFrame:
    """Word boxes of a text line (id, content, x1, x2) by the share of its characters."""
    word = lines.select("*", F.posexplode(F.split("content", " ", -1)).alias("word_no", "word"))
    w = Window.partitionBy("id").orderBy("word_no").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("word") + 1).over(w), F.lit(0))
    size = (F.col("x2") - F.col("x1")) / F.greatest(F.length("content"), F.lit(1))
    return word.withColumn("at", at).where("word <> ''").select("id", "word_no", "word", (F.col("x1") + size * F.col("at")).alias("x1"), (F.col("x1") + size * (F.col("at") + F.length("word"))).alias("x2"))


def merge_ocr(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old strings with the overlapping new ones: equal cleaned texts confirm, ``blanks + 1`` new pieces replace, else keep."""
    from ..functions.text import clean_ocr
    from .spatial import overlapping

    met = overlapping(old, new).groupBy(F.col("a.page_id").alias("page_id"), F.col("a.area_id").alias("area_id"), F.col("a.content").alias("content"))
    met = met.agg(F.count("*").alias("pieces"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("b.x1", "b.area_id", "b.content"))), lambda x: x["content"]), " ").alias("other"))
    blanks = F.length("content") - F.length(F.replace("content", F.lit(" "), F.lit("")))
    action = F.when(clean_ocr(F.col("content")) == clean_ocr(F.col("other")), "confirm").when(F.col("pieces") == blanks + 1, "replace").otherwise("keep")
    return met.select("page_id", "area_id", "content", "other", action.alias("action"))


def f1(precision: Column, recall: Column) -> Column:
    return 2 * precision * recall / (precision + recall + 1e-8)
