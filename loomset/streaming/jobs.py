"""Structured Streaming jobs over file sources.

A job ends when the files present at its start are read (availableNow); leave
``trigger`` out to keep it running. Checkpoints and sinks belong in the shared
folder of the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from loomset.operators.checks import clean_valid
from loomset.session import scratch_path

from .upserts import UpsertLog

AVAILABLE_NOW = {"availableNow": True}


def file_stream(spark: SparkSession, folder: str, name: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet files of a folder whose name matches, or those below a folder of that name, as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # read as a pattern: a path without one has to be a folder
    return reader.parquet(f"{folder}/{{{name}}}")


#: keeps state on the executors' disks, with changes written to the checkpoint; timers and lists need it
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def drain(stream: DataFrame, name: str, mode: str = "append", settings: dict[str, str] | None = None, progress: list | None = None) -> DataFrame:
    """Run the stream to the end of its input into parquet files and read them back.

    ``settings`` hold for this query only; the reports of its micro-batches are added to ``progress``.
    """
    spark = stream.sparkSession
    out, marks = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    before = {k: spark.conf.get(k, None) for k in settings or {}}
    for k, v in (settings or {}).items():
        spark.conf.set(k, v)
    try:
        query = (
            stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", marks)
            .trigger(**AVAILABLE_NOW).start(out)
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if progress is not None:
        progress.extend(query.recentProgress)
    return spark.read.schema(stream.schema).parquet(out)


def late_rows(progress: list) -> int:
    """Rows that came after the watermark had passed them and were dropped, from the reports of a query."""
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])


def clean_stream(docs: DataFrame, text: str = "text") -> DataFrame:
    """Cleaned and valid texts; the same column functions as in batch, so no state."""
    return clean_valid(docs, text).drop("digest")


def first_arrivals(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """The first row per key within the watermark; state of a key is dropped after the delay.

    A key that returns later than ``delay`` after its row is new again, and a row older than the watermark is
    dropped (:func:`late_rows`). Keys of the delay are the state; run it by :func:`drain` with ROCKSDB.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def rate(stream: DataFrame, ts: str, delay: str, length: str, slide: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows per window, emitted once the watermark has passed the window's end; later rows are dropped."""
    span = F.window(ts, length, slide) if slide else F.window(ts, length)
    counted = stream.withWatermark(ts, delay).groupBy(span, *by).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")


BREAKER_OUT = "key long, event_id long, ts timestamp, failures long, open boolean"


class Breaker(StatefulProcessor):
    """Follows the severe events of one key in the order of their time, whatever batches they come in.

    Events wait in a list until the watermark has passed them; a timer wakes the key for the next one, and for
    the moment at which an open breaker closes, if no event does it before.
    """

    def __init__(self, threshold: int, pause_us: int):
        self.threshold, self.pause = threshold, pause_us

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("breaker", "failures long, open boolean, reset long")
        self.waiting = handle.getListState("waiting", "event_id long, us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = []
        for part in rows:
            moments = part["ts"].astype("datetime64[us]").astype("int64")
            fresh += [(int(us), int(e)) for us, e in zip(moments, part["event_id"])]
        yield from self._advance(key, timerValues, fresh)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, timerValues)

    def _advance(self, key, timerValues, fresh=()) -> Iterator[pd.DataFrame]:
        # each read and write of state asks the JVM, which costs more than the events of a key: only what may be there is
        # read, and only what changed is written
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        before, known = [(int(us), int(e)) for e, us in self.waiting.get()], self.state.get()
        events = [*before, *fresh]
        due, rest = sorted(x for x in events if x[0] <= mark), [x for x in events if x[0] > mark]
        failures, is_open, reset = known or (0, False, 0)
        out = []
        for us, event in due:
            if is_open and us > reset:
                out.append((None, reset, 0, False))
                failures, is_open = 0, False
            failures += 1
            if failures >= self.threshold:
                is_open, reset = True, us + self.pause
            out.append((event, us, failures, is_open))
        if is_open and reset < mark:
            out.append((None, reset, 0, False))
            failures, is_open = 0, False
        kept = [x for x in before if x[0] > mark]
        if len(kept) < len(before):
            self.waiting.put([(e, us) for us, e in rest]) if rest else self.waiting.clear()
        elif len(rest) > len(kept):
            self.waiting.appendList([(e, us) for us, e in rest[len(kept):]])
        after = (int(failures), bool(is_open), int(reset))
        if after != (tuple(known) if known else (0, False, 0)):
            self.state.update(after)
        if before or known:  # a key without either has set no timer
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        # milliseconds, rounded up: a timer must not fire before its moment is past
        wake = [us for us, _ in rest] + ([reset + 1] if is_open else [])
        if wake:
            self.handle.registerTimer(-(-min(wake) // 1000))
        if out:
            yield pd.DataFrame({
                "key": key[0], "event_id": pd.array([r[0] for r in out], "Int64"), "ts": pd.to_datetime([r[1] for r in out], unit="us"),
                "failures": [r[2] for r in out], "open": [r[3] for r in out],
            })

    def close(self) -> None:
        pass


def circuit_breaker(stream: DataFrame, key: str, threshold: int = 5, open_minutes: int = 5, delay: str = "10 minutes") -> DataFrame:
    """State of a breaker per key after each severe event (key, event_id, ts), and a row without event_id when it closes.

    ``threshold`` events open it; it closes ``open_minutes`` after the last event that kept it open, and starts
    from zero. Events are taken in the order of (ts, event_id) once the watermark, ``delay`` behind the newest
    event, has passed them, so the result does not depend on how they are cut into batches; later ones are
    dropped. A key holds the events of the delay and of one micro-batch. Run it by :func:`drain` with ROCKSDB.
    """
    severe = stream.select(F.col(key).alias("key"), "event_id", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", delay)
    return severe.groupBy("key").transformWithStateInPandas(
        Breaker(threshold, open_minutes * 60 * 1_000_000), BREAKER_OUT, "Append", "EventTime")


def upsert_latest(stream: DataFrame, path: str, marks: str, keys: list[str], order: list[str], compact_every: int = 8) -> None:
    """Keep the latest row per key below ``path``; see :class:`loomset.streaming.upserts.UpsertLog`."""
    log = UpsertLog(stream.sparkSession, path, keys, order, compact_every)
    query = stream.writeStream.foreachBatch(log.append).option("checkpointLocation", marks).trigger(**AVAILABLE_NOW).start()
    query.awaitTermination()


def read_latest(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    return UpsertLog(spark, path, keys, order).read()
