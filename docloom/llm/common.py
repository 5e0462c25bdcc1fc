"""Shared plumbing: tables, the shared scratch folder and clean column hand-over.

Intermediate tables go to the folder named by ``spark.checkpoint.dir``, the one place that
the driver and all executors see; a lost executor therefore never loses a finished step.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Scratch paths given out by this driver.
_given: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``; a local one only where none is set and one machine runs all (tests)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = getattr(spark, "_docloom_scratch", None)
        if base is None:
            base = "file://" + tempfile.mkdtemp(prefix="docloom-")
            spark._docloom_scratch = base
    _given.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _given[-1]


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    schema = df.schema
    df.write.options(**options).parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._docloom_path = path
    return out


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch paths through Hadoop's file system API."""
    jvm = spark._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_cleared(spark: SparkSession):
    """Scratch written inside is deleted at the end, except the paths put into the list that it gives."""
    begin, kept = len(_given), []
    yield kept
    remove(spark, *[p for p in _given[begin:] if p not in kept])
    del _given[begin:]


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files of finished steps now instead of at some later collection."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


def doc_text(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id and text (null: empty) and the named extra columns; clashing extra columns of the input don't matter."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *extra)


def ascii_lower(text):
    """A-Z in lower case, all other characters as they are; a chain of byte replacements where the text isn't plain ASCII."""
    other = text
    for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        other = F.replace(other, F.lit(c), F.lit(c.lower()))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(other)


def word_array(text, separators: str):
    """The maximal runs of characters outside the class ``separators`` (Java regex class body), in order."""
    return F.array_remove(F.split(text, f"[{separators}]+", -1), "")


#: Separators of the plain word rule: ASCII white space.
SPACE = " \\t-\\r"
#: Separators of the alphanumeric word rule: ASCII other than digits and lower-case letters.
NOT_ALNUM = "\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F"
