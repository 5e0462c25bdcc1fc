"""Extraction as a service over tables: uploads, jobs with states, results, dictionary and pipelines below one folder.

Everything lives in files below ``root`` (a path that all executors see), so any number of drivers can serve it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import knowledge
from ..operators import tables
from .ingest import ingest_files


class Service:
    """``process`` turns uploaded files (path, content) into rows; it is the pipeline of the kind of files served."""

    def __init__(self, spark: SparkSession, root: str, process: Callable[[DataFrame], DataFrame]):
        self.spark, self.root, self.process = spark, root.rstrip("/"), process

    def _at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._at(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _save(self, name: str, data: bytes) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._at(name))
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(data))
        out.close()

    def single(self, paths: list[str]) -> DataFrame:
        """Rows of some files at once, without a job."""
        return self.process(self.spark.read.format("binaryFile").load(paths).select("path", "content"))

    def submit(self, name: str, content: bytes) -> str:
        """Store an upload; its job's id."""
        job = f"{uuid.uuid4().hex}-{name}"
        self._save(f"uploads/{job}", content)
        return job

    def work(self) -> None:
        """Process all uploads that are new."""
        ingest_files(self.spark, self._at("uploads"), self.process, self._at("results"), self._at("jobs"), self._at("state"))

    def status(self, job: str) -> str:
        """queued, done, failed, or unknown for ids that were never given."""
        if self._exists("jobs"):
            found = self.spark.read.parquet(self._at("jobs")).where(F.endswith("path", F.lit(job))).select("state").first()
            if found:
                return found.state
        return "queued" if self._exists(f"uploads/{job}") else "unknown"

    def wait(self, job: str, every: float = 5.0, most: float = 600.0) -> str:
        """The job's state once it isn't queued any more, asked for every so many seconds; queued after ``most`` of them."""
        until = time.monotonic() + most
        while (state := self.status(job)) == "queued" and time.monotonic() < until:
            time.sleep(every)
        return state

    def result(self, job: str) -> DataFrame:
        """A finished job's rows (they need a ``path`` column)."""
        return self.spark.read.parquet(self._at("results")).where(F.endswith("path", F.lit(job)))

    def update_knowledge(self, dictionary: dict[str, list[str]]) -> None:
        self._save("knowledge.json", json.dumps(dictionary, ensure_ascii=False).encode())

    def knowledge(self) -> dict[str, list[str]]:
        """The stored dictionary, else the default one."""
        return knowledge.load(self.spark, self._at("knowledge.json")) if self._exists("knowledge.json") else knowledge.DEFAULT

    def update_pipeline(self, config: list[dict]) -> None:
        """Store pipelines; a configuration that cannot be built is refused."""
        from ..plans.pipeline import build

        for p in config:
            build(p)
        self._save("pipeline.json", json.dumps(config).encode())

    def pipelines(self) -> dict:
        from ..plans.pipeline import load

        return load(self.spark, self._at("pipeline.json")) if self._exists("pipeline.json") else {}

    def show(self, cells: DataFrame, metadata: DataFrame) -> None:
        """Views of what the pages show: ``v_metadata``, ``v_steps_wide`` (by identifier) and ``v_claims``."""
        known = self.knowledge()
        metadata.createOrReplaceTempView("v_metadata")
        tables.wide_table(tables.setpoints(cells, known), list(known)).orderBy("doc_id", "glass_id").createOrReplaceTempView("v_steps_wide")
        tables.claims(cells).createOrReplaceTempView("v_claims")
