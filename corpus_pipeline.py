"""The corpus pipeline: quality classifier, near-duplicates, decontamination, personal data, packing.

Every stage takes (spark, docs, sf_dir), works on all rows the stage before it kept, and returns a
DataFrame that is written as Parquet and read again as the next stage's docs. All but the last return
the columns of ``documents``; other columns of docs, whatever their names, are left out.

For all stages: rows are told apart by a number of their own, so null and repeated doc_ids are rows like
any other; a null text counts as empty; an empty table gives an empty table. Repeated rows are judged
each, and of equal or near-equal texts the near-duplicate stage keeps one. Each stage says what ties do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import decontamination, packing, pii, quality_classifier, set_similarity, simhash
from docloom.llm.common import materialize, release, remove, scratch_cleared, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _rows(docs: DataFrame) -> DataFrame:
    """The documents with a unique ``row``, written once so that it stays: doc_id may be null or repeated."""
    release(docs.sparkSession)
    return materialize(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "rows")


def _by_row(rows: DataFrame) -> DataFrame:
    """The documents as operators take them, told apart by row instead of doc_id."""
    return rows.select(F.col("row").alias("doc_id"), "text", "lang", "source", "n_chars")


def _only(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The documents whose row is among the chosen doc_ids: those of the others are found first, by ids alone, so that texts stay where they are."""
    gone = materialize(rows.select("row").join(chosen.select(F.col("doc_id").alias("row")), "row", "left_anti"), "gone")
    return rows.join(set_similarity.sent(gone), "row", "left_anti").select(*COLUMNS)


def _least(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """One document of each class: the one with the least doc_id, null last, then the least row."""
    own = rows.select("row", "doc_id").join(classes.select(F.col("doc_id").alias("row"), "class"), "row")
    first = own.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("f"))
    return _only(rows, first.select(F.col("f.row").alias("doc_id")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps; a score at the threshold is kept, and so are all documents where the
    labels don't hold both classes. Empty texts are judged by their metadata and shape like any other."""
    return quality_classifier.keep_good(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate class."""
    rows = _rows(docs)
    return _least(rows, simhash.near_duplicates(_by_row(rows)).withColumnRenamed("component_id", "class"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7's classes first; of the documents they leave, the one with the least id of each class
    connected at Jaccard 0.8 or more of five-word shingles. Among equal ids the first row stays, documents with
    an id before those without; all texts without a word are one class."""
    rows = _rows(docs)
    classes = simhash.near_duplicates(_by_row(rows)).withColumnRenamed("component_id", "class")
    left = _rows(_least(rows, classes))
    remove(spark, rows._docloom_path)
    release(spark)
    return _least(left, set_similarity.similar_classes(_by_row(left)))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window; texts without words stay."""
    rows = _rows(docs)
    return _only(rows, decontamination.contamination(_by_row(rows), table(spark, sf_dir, "benchmark")).where("n_hit = 0"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text where it changed. Of overlapping spans the
    one that begins first names the kind, the shorter one among equal begins. Null texts stay null."""
    rows = _rows(docs)
    spans = pii.find_pii(_by_row(rows)).where(F.size("spans") > 0).select(F.col("doc_id").alias("row"), "spans")
    met = rows.join(spans, "row", "left")
    met = pii.redact(met)
    changed = F.size(F.coalesce("spans", F.array().cast(met.schema["spans"].dataType))) > 0
    return met.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences; an empty text is a piece of the end id alone. Pieces of equal length
    take their places in any order."""
    return packing.pack(docs)


STAGES = [("quality_classifier", quality), ("simhash_near_dedup", near_copies), ("benchmark_decontamination", decontaminate), ("pii", private_data), ("best_fit_packing", pack)]

#: SQL can express neither the classifier nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again, and what else it wrote is deleted."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch_cleared(spark) as kept:
            docs = materialize(stage(spark, docs, sf_dir), name)
            kept.append(docs._docloom_path)
    return STAGES[-1][1](spark, docs, sf_dir)
