"""Arriving files as Structured Streaming: results and job states in tables, exactly once per file."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files of a batch.
BATCH_FILES = 1000


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder of ``spark.checkpoint.dir``; a local one where none is set and one machine runs all (tests)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="docloom-stream-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def run_available(frame: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process all data there now and stop."""
    q = frame.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    q.awaitTermination()


def count_events(spark: SparkSession, path: str) -> DataFrame:
    """Events read as a stream, written through the file sink, then counted by type."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name if spark.read.parquet(path).inputFiles()[0].endswith(name) else "*.parquet")
    source = stream.parquet(folder if spark.read.parquet(path).inputFiles()[0].endswith(name) else path)
    out = scratch(spark, "events")
    run_available(source.select("event_id", "event_type"), out, scratch(spark, "events-checkpoint"))
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


def ingest_files(spark: SparkSession, folder: str, process: Callable[[DataFrame], DataFrame], results: str, jobs: str, checkpoint: str) -> None:
    """Process new files of a folder: results and one job row (path, state, reason) per file and batch.

    A batch (``BATCH_FILES`` files at most) that fails is done again file by file, so only the files that
    cannot be processed are recorded as failed; rewriting a batch replaces its folder.
    """

    def batch(frame: DataFrame, number: int) -> None:
        out, bad = f"{results}/batch={number}", {}
        try:
            process(frame).write.mode("overwrite").parquet(out)
        except Exception:  # some file cannot be processed: find out which
            mode = "overwrite"
            for path in [r.path for r in frame.select("path").collect()]:
                try:
                    process(frame.where(F.col("path") == path)).write.mode(mode).parquet(out)
                    mode = "append"
                except Exception as e:  # recorded, so that later files still run
                    bad[path] = str(e)[:500]
        reason = F.lit(None).cast("string")
        for path, text in bad.items():
            reason = F.when(F.col("path") == path, F.lit(text)).otherwise(reason)
        rows = frame.select("path", "modificationTime", reason.alias("reason"))
        rows.select("path", "modificationTime", F.when(F.col("reason").isNull(), "done").otherwise("failed").alias("state"), "reason").write.mode("overwrite").parquet(f"{jobs}/batch={number}")

    source = spark.readStream.format("binaryFile").option("maxFilesPerTrigger", BATCH_FILES).schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Tumbling event-time counts with a watermark for late rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n")).select("window.start", "event_type", "n")
