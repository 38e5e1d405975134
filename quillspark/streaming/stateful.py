"""Streams with timers and state that expires: retries after a delay, job states that are kept for a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quillspark.operators.reports import TERMINAL
from quillspark.sources.keyed import KeyedTable
from quillspark.sources.store import stage

#: Seconds that a failed message waits before its next attempts; after these it is dead.
DELAYS = (1, 2, 4, 8)
#: Rows of a frame that a processor gives.
_OUT_ROWS = 10_000
#: State in RocksDB, which timers and expiring values need.
_ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """The session with these settings; its own come back afterwards."""
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], path: str, mode: str, *, event_time: bool) -> None:
    """Process what is there and stop; state and progress go on from the checkpoint below the path.

    Without event time a query that may fire timers asks for ever more empty
    batches, so it runs none: timers and expiry are looked at with new rows.
    """
    with _settings(stream.sparkSession, _ROCKS | {"spark.sql.streaming.noDataMicroBatches.enabled": str(event_time).lower()}):
        writer = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", f"{path}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()


class Retries(StatefulProcessor):
    """Holds the failed messages of a bucket until they are due; those that have no attempt left go at once.

    A bucket has one timer, for the earliest of its messages, and its state is
    read and written once when that fires, not once for each message.
    """

    def __init__(self, event_time: bool):
        self.event_time = event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "message_id string, value string, retry_count int, due long")
        self.next = handle.getValueState("next", "due long")

    def _out(self, rows: list[tuple], route: str) -> Iterator[pd.DataFrame]:
        for start in range(0, len(rows), _OUT_ROWS):
            ids, values, counts, due = zip(*rows[start : start + _OUT_ROWS], strict=True)
            texts = lambda x: pd.Series(x, dtype=object)
            yield pd.DataFrame({
                "message_id": texts(ids), "value": texts(values), "retry_count": pd.Series(counts, dtype="int32"),
                "due": pd.to_datetime(pd.Series(due, dtype="int64"), unit="ms"), "route": texts([route] * len(ids)),
            })

    def _wake(self, due: int) -> None:
        """Have one timer, at the earliest time at which a message is due."""
        at = self.next.get()[0] if self.next.exists() else None
        if at is None or due < at:
            if at is not None:
                self.handle.deleteTimer(at)
            self.handle.registerTimer(due)
            self.next.update((due,))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now, first = None if self.event_time else timerValues.getCurrentProcessingTimeInMs(), None
        for batch in rows:
            at = batch.failed_ms.astype("int64") if self.event_time else pd.Series(now, batch.index, dtype="int64")
            count = batch.count_.astype("int64")
            over = count >= len(DELAYS)
            due = at.where(over, at + 1000 * count.clip(upper=len(DELAYS) - 1).map(dict(enumerate(DELAYS))).astype("int64"))
            every = list(zip(batch.message_id.tolist(), batch.value.tolist(), (count + ~over).tolist(), due.tolist(), strict=True))
            gone = over.tolist()
            yield from self._out([x for x, y in zip(every, gone, strict=True) if y], "dead")
            wait = [x for x, y in zip(every, gone, strict=True) if not y]
            if wait:
                self.held.appendList(wait)
                first = min(x[3] for x in wait) if first is None else min(first, *(x[3] for x in wait))
        if first is not None:
            self._wake(first)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        clock = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        at, held = max(clock, expiredTimerInfo.getExpiryTimeInMs()), [tuple(x) for x in self.held.get()]
        self.next.clear()
        wait = [x for x in held if x[3] > at]
        if wait:
            self.held.put(wait)
            self._wake(min(x[3] for x in wait))
        else:
            self.held.clear()
        yield from self._out([x for x in held if x[3] <= at], "retry")

    def close(self) -> None:
        pass


def stream_retries(failures: DataFrame, path: str, *, clock: str | None = None, lateness: str = "0 seconds", buckets: int = 1024) -> DataFrame:
    """Route a stream of failed messages (message_id, value, retry_count): back after a delay, or to the dead letters.

    A count that is missing, no number or negative is 0. A message with fewer
    than four attempts behind it waits 1, 2, 4 or 8 seconds, on the timer of its
    hash bucket, and comes back with the next count; others are dead at once. While it
    waits it is state, so a stream that is stopped and started on the same path
    forgets none.

    Time is the machine's, and what is due comes back with the next new rows. With ``clock``, a timestamp column, it is the time in
    the messages: then a message is due once messages of a later time have
    arrived, and one that is older than the latest by more than ``lateness`` is
    dropped by the watermark. Processes what is there and stops; each batch is
    written under its number, so a batch that is delivered again replaces what
    it wrote. A bucket's waiting messages are in one task together: choose
    ``buckets`` by how many wait at a time; a stream keeps its number. Returns all rows so far: message_id, value, retry_count, due and
    route (retry or dead).
    """
    count = F.greatest(F.lit(0), F.coalesce(F.expr("try_cast(retry_count as int)"), F.lit(0))).alias("count_")
    rows = failures.withWatermark(clock, lateness) if clock else failures
    failed = F.unix_millis(F.col(clock).cast("timestamp")) if clock else F.lit(0).cast("long")
    ident = F.coalesce("message_id", F.lit(""))
    # Value and time deal the messages of one id out, too: each waits for itself.
    bucket = F.pmod(F.xxhash64(ident, "value", failed), F.lit(buckets)).cast("int").alias("bucket")
    names = [bucket, ident.alias("message_id"), F.col("value").cast("string").alias("value"), count, failed.alias("failed_ms")]
    rows = rows.select(*names, *([clock] if clock else []))
    routed = rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=Retries(clock is not None), outputMode="append", timeMode="eventTime" if clock else "processingTime",
        outputStructType="message_id string, value string, retry_count int, due timestamp, route string",
    )

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/routed/batch={number}")

    _run(routed, each, path, "append", event_time=clock is not None)
    return failures.sparkSession.read.parquet(f"{path}/routed").drop("batch")


class JobStates(StatefulProcessor):
    """The state of one job: running without limit, frozen for a time once it has ended."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.running = handle.getValueState("running", "status string, processed long, events long")
        self.ended = handle.getValueState("ended", "status string", self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        every = pd.concat([x[["ts", "event_id", "status", "processed_pages"]] for x in rows])
        if self.ended.exists() or every.empty:
            return iter(())
        known = self.running.exists()
        _, processed, events = self.running.get() if known else ("STARTED", 0, 0)
        every = every.sort_values(["ts", "event_id"], kind="stable")
        over = every.status.isin(TERMINAL).to_numpy()
        count = int(over.argmax()) + 1 if over.any() else len(every)
        last = every.iloc[count - 1]
        status, processed, events = str(last.status), max(0, int(last.processed_pages)), int(events) + count
        if over.any():
            self.ended.update((status,))
            self.running.clear()
        else:
            self.running.update((status, processed, events))
        text = lambda x: pd.Series([x], dtype=object)
        return iter([pd.DataFrame({"job_id": text(key[0]), "status": text(status), "processed_pages": [processed], "events": [events]})])

    def close(self) -> None:
        pass


JOBS = "job_id string, status string, processed_pages long, events long"


def stream_job_table(progress: DataFrame, jobs: KeyedTable, path: str, *, keep_ms: int = 86_400_000) -> DataFrame:
    """Keep ``jobs`` (schema ``JOBS``, keyed by job_id) by a stream of progress (job_id, ts, event_id, status, processed_pages).

    Within a batch progress counts in order of (ts, event_id). Once a job has
    ended it is frozen: for ``keep_ms`` its state says so and further progress
    counts for nothing; then the state goes, so that state grows with the jobs
    at work. Progress that comes later yet opens a state anew, but the table
    still knows the end: it stays as it is, and the progress is reported.
    Returns the reports so far, rows of ``JOBS``. A batch that is delivered
    again changes nothing.
    """
    spark = progress.sparkSession
    states = progress.groupBy("job_id").transformWithStateInPandas(
        statefulProcessor=JobStates(keep_ms), outputStructType=JOBS, outputMode="update", timeMode="processingTime",
    )

    def each(batch: DataFrame, number: int) -> None:
        found = stage(batch, "states")
        known = jobs.near(found.select("job_id").distinct()).select(F.col("job_id").alias("_job"), F.struct("status", "processed_pages", "events").alias("_was"))
        both = found.join(known, F.col("job_id") == F.col("_job"), "left")
        ended = F.coalesce(F.col("_was.status").isin(*TERMINAL), F.lit(False))
        same = F.struct("status", "processed_pages", "events") == F.col("_was")
        late = stage(both.withColumn("_late", ended & ~F.coalesce(same, F.lit(False))), "judged")
        late.where("_late").select(*found.columns).write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        jobs.upsert(late.where("not _late").select(*found.columns))

    _run(states, each, path, "update", event_time=False)
    return spark.read.schema(f"{JOBS}, batch int").parquet(f"{path}/late").drop("batch")
