"""Requests for frames as state: what is asked for, in work, done or to be tried again after a while."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from gridscale.operators.materialise import fill_pending
from gridscale.operators.store import GridStore

#: What the stream reads: frames somebody asks for (``asked``) and what became of attempts (``done``, ``failed``).
EVENTS = "run_id STRING, frame INT, event STRING"
#: What it answers: frames to compute now (``work``) and frames that failed too often (``given up``).
ORDERS = "run_id STRING, frame INT, attempt INT, action STRING"

#: Frames of a run that share one state, so that a run of any length is many small states on many tasks.
FRAMES_PER_STATE = 1024
#: Outcomes in a file that ``fill_orders`` writes.
OUTCOMES_PER_FILE = 1 << 18
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RequestBook(StatefulProcessor):
    """The state of up to ``FRAMES_PER_STATE`` frames of one run: per frame its stage, its attempts and when it may be tried again.

    A frame asked for again while it is known adds nothing. A frame in work whose outcome does not come, because a driver died, is
    due after the same time as one that failed."""

    def __init__(self, retry_ms: int, max_attempts: int):
        self.retry_ms, self.max_attempts = retry_ms, max_attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.frames = handle.getMapState("frames", "frame INT", "stage STRING, attempt INT, due BIGINT")

    def _ordered(self, key, orders: list[tuple]) -> Iterator[pd.DataFrame]:
        if orders:
            yield pd.DataFrame([(key[0], *o) for o in orders], columns=["run_id", "frame", "attempt", "action"])

    def _order(self, frame: int, attempt: int, now: int) -> tuple:
        self.frames.updateValue((frame,), ("in work", attempt, now + self.retry_ms))
        self.handle.registerTimer(now + self.retry_ms)
        return frame, attempt, "work"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now, orders = timerValues.getCurrentProcessingTimeInMs(), []
        for batch in rows:
            for frame, event in zip(batch["frame"].tolist(), batch["event"].tolist()):
                known = self.frames.getValue((frame,)) if self.frames.containsKey((frame,)) else None
                if event == "done":
                    self.frames.updateValue((frame,), ("done", known[1] if known else 0, 0))
                elif event == "asked" and known is None:
                    orders.append(self._order(frame, 1, now))
                elif event == "failed" and known is not None and known[0] == "in work":
                    if known[1] >= self.max_attempts:
                        self.frames.updateValue((frame,), ("given up", known[1], 0))
                        orders.append((frame, known[1], "given up"))
                    else:
                        self.frames.updateValue((frame,), ("failed", known[1], now + self.retry_ms))
                        self.handle.registerTimer(now + self.retry_ms)
        yield from self._ordered(key, orders)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        due = [(f[0], s[1]) for f, s in self.frames.iterator() if s[0] in ("in work", "failed") and s[2] <= now]
        orders = []
        for frame, attempt in due:
            if attempt >= self.max_attempts:
                self.frames.updateValue((frame,), ("given up", attempt, 0))
                orders.append((frame, attempt, "given up"))
            else:
                orders.append(self._order(frame, attempt + 1, now))
        yield from self._ordered(key, orders)

    def close(self) -> None:
        pass


def frame_orders(events: DataFrame, retry_s: float = 60.0, max_attempts: int = 5) -> DataFrame:
    """Orders to compute frames, from a stream of ``EVENTS``: each frame once, and again after ``retry_s`` while it is not done.

    Rows without run or frame, and events of other names, are left out."""
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    clean = events.filter("run_id IS NOT NULL AND frame IS NOT NULL AND event IN ('asked', 'done', 'failed')").select(
        "run_id", F.expr(f"int(frame div {FRAMES_PER_STATE})").alias("part"), "frame", "event")
    return clean.groupBy("run_id", "part").transformWithStateInPandas(
        statefulProcessor=RequestBook(int(retry_s * 1000), max_attempts), outputStructType=ORDERS, outputMode="Append", timeMode="ProcessingTime")


def frame_events(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of events from Parquet files dropped into a folder, by those who ask and by ``fill_orders``."""
    reader = spark.readStream.schema(EVENTS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def fill_orders(orders: DataFrame, store: GridStore, views: DataFrame, folder: str, checkpoint: str, available_now: bool = True,
                fill=fill_pending) -> StreamingQuery:
    """Compute ordered frames, and tell the events' ``folder`` what became of them. ``views`` has a column ``run_id``.

    What is in the store decides between ``done`` and ``failed``, so a batch that is replayed after a crash tells the same and computes
    nothing twice. If the frames of a run fail together, halves of their range are tried apart, down to single frames, so that
    one bad frame holds up no other. A frame without a view fails. With ``available_now`` the query ends when it has seen all events; timers
    that ran out before are looked at in its batches. Otherwise they are looked at every second, with or without events."""
    def answer(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        here = GridStore(spark, store.root)
        work = batch.filter("action = 'work'").select("run_id", "frame").distinct().persist()
        for run in work.groupBy("run_id").agg(F.min("frame").alias("first"), F.max("frame").alias("last"), F.count("*").alias("n")).collect():
            wanted = work.filter(F.col("run_id") == run["run_id"]).select("frame")
            own = views.filter(F.col("run_id") == run["run_id"]).drop("run_id").join(wanted, "frame", "left_semi")
            if here.exists(run["run_id"]):
                attempt(here, run["run_id"], own, run["first"], run["last"], f"requests, batch {batch_id}")
                live = here.live_frames(run["run_id"]).select("frame", F.lit("done").alias("event"))
            else:
                live = spark.createDataFrame([], "frame INT, event STRING")
            told = wanted.join(live, "frame", "left").select(F.lit(run["run_id"]).alias("run_id"), "frame", F.coalesce("event", F.lit("failed")).alias("event"))
            # Few files by an exchange: with coalesce, one task would run the whole join, partition after partition.
            told.repartition(-(-run["n"] // OUTCOMES_PER_FILE), "frame").write.mode("append").parquet(folder)
        work.unpersist()

    def attempt(here, run_id, own, first, last, message) -> None:
        try:
            fill(here, run_id, own.filter(F.col("frame").between(first, last)), message=message)
        except Exception:
            if first < last:
                middle = (first + last) // 2
                attempt(here, run_id, own, first, middle, message)
                attempt(here, run_id, own, middle + 1, last, message)

    writer = orders.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(answer)
    if not available_now:
        return writer.trigger(processingTime="1 second").start()
    # With timers Spark runs batches without data for ever, which a query that shall end cannot have.
    conf, empty = orders.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(empty)
    conf.set(empty, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        conf.set(empty, before)
