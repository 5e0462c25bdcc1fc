"""A sliding metric over arriving events: each event's window of its user's last values, with state and event-time timers.

Events may come late, out of order and twice. They wait in the user's state until the watermark has passed them; then a timer takes
them out in the order of their time and id, so the windows are those of a sorted table, whatever the arrival.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .ingest import scratch

#: Events of a window.
WIDTH = 20
OUT = "user_id long, event_id long, mean double, top double, mid double, overall double, n long"


def measures(window: list[float | None]) -> tuple[float | None, float | None, float | None]:
    """Mean, greatest and median of the values that are there."""
    there = sorted(v for v in window if v is not None)
    if not there:
        return None, None, None
    half = len(there) // 2
    return sum(there) / len(there), there[-1], there[half] if len(there) % 2 else (there[half - 1] + there[half]) / 2


class Sliding(StatefulProcessor):
    """Per user: values that wait (by time and id), the last ``width`` - 1 values, and count and sum of all."""

    def __init__(self, width: int = WIDTH):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", StructType([StructField("us", LongType()), StructField("event_id", LongType()), StructField("value", DoubleType())]))
        self.past = handle.getValueState("past", StructType([StructField("last", ArrayType(DoubleType())), StructField("n", LongType()), StructField("total", DoubleType())]))
        self.timer = handle.getValueState("timer", StructType([StructField("ms", LongType())]))

    def _wake(self, ms: int) -> None:
        """One timer for each user, at its earliest waiting event."""
        set_to = self.timer.get()[0] if self.timer.exists() else None
        if set_to is None or ms < set_to:
            if set_to is not None:
                self.handle.deleteTimer(set_to)
            self.handle.registerTimer(ms)
            self.timer.update((ms,))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [(r.us, r.event_id, r.value) for r in rows]
        if new:
            self.waiting.appendList(new)  # all events of a batch in one call
            self._wake(min(r[0] for r in new) // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        found = {(us, event_id): value for us, event_id, value in self.waiting.get()}  # the same event again changes nothing
        last, n, total = self.past.get() if self.past.exists() else ([], 0, 0.0)
        last, rest = list(last), []
        for (us, event_id), value in sorted(found.items(), key=lambda x: x[0]):
            if us // 1000 + 1 > until:
                rest.append((us, event_id, value))
                continue
            last = [*last, value][-self.width :]
            if value is not None:
                n, total = n + 1, total + value
            mean, top, mid = measures(last)
            yield Row(user_id=key[0], event_id=event_id, mean=mean, top=top, mid=mid, overall=total / n if n else None, n=len(last))
        self.past.update((last[-(self.width - 1) :], n, total))
        if rest:
            self.waiting.put(rest)
            self._wake(rest[0][0] // 1000 + 1)
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass


@contextmanager
def keyed_state(spark: SparkSession):
    """State in the store that timers and maps need, while a query starts."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def sliding_metric(events: DataFrame, late: str = "1 hour", width: int = WIDTH) -> DataFrame:
    """(user_id, event_id, mean, top, mid, overall, n) of streamed events (event_id, ts, user_id, value).

    Events later than ``late`` are left out, as are repeats of an event that waits; a repeat that comes after its event was told is
    late itself, unless it comes within ``late``: those are taken out by their id. Events without a time are left out.
    """
    own = events.where("ts IS NOT NULL").select("event_id", "ts", "user_id", "value").withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    keyed = own.withColumn("us", F.unix_micros("ts"))
    return keyed.groupBy("user_id").transformWithState(statefulProcessor=Sliding(width), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


def run_sliding(spark: SparkSession, source: str, out: str, checkpoint: str, late: str = "1 hour", files: int = 1) -> None:
    """Takes all event files that are there, ``files`` at a time, and stops; the next run goes on where this one ended."""
    schema = "event_id long, ts timestamp, user_id long, value double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    with keyed_state(spark):
        q = sliding_metric(stream, late).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()


def close_events(spark: SparkSession, source: str, day: str = "2999-01-01") -> None:
    """A last event, far on and of no user that counts, so that the watermark passes all others."""
    spark.sql(f"SELECT -1L AS event_id, timestamp '{day}' AS ts, -1L AS user_id, CAST(NULL AS DOUBLE) AS value").coalesce(1).write.mode("append").parquet(source)


def streamed(spark: SparkSession, events: DataFrame, parts: int = 3) -> DataFrame:
    """The metric of a whole table, let in as ``parts`` files by time, one for each micro-batch."""
    source, out, checkpoint = (scratch(spark, name) for name in ("sliding-in", "sliding-out", "sliding-checkpoint"))
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    bounds = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    if bounds.a is None:
        return spark.createDataFrame([], OUT)
    span = max(1, int((bounds.b - bounds.a).total_seconds()) // parts + 1)
    part = F.floor((F.unix_seconds("ts") - F.unix_seconds(F.lit(bounds.a))) / span)
    dealt = events.where("ts IS NOT NULL").select("event_id", "ts", "user_id", "value").withColumn("part", part)
    for k in range(parts + 1):
        some = dealt.where(F.col("part") == k).drop("part")
        some.coalesce(1).write.mode("append").parquet(source)
    close_events(spark, source)
    run_sliding(spark, source, out, checkpoint)
    return spark.read.schema(OUT).parquet(out).where("event_id <> -1")
