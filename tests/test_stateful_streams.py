"""Streams with timers and expiring state: retries by a fixed clock, and jobs that end."""

import time
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quillspark.sources.keyed import KeyedTable
from quillspark.sources.store import shared_path
from quillspark.streaming.stateful import JOBS, stream_job_table, stream_retries

START = datetime(2024, 1, 1)


def feed(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/feed")
    return spark.readStream.schema(schema).parquet(f"{path}/feed")


def test_messages_come_back_on_time_and_then_die(spark):
    """All attempts of m1 fail, each half a second after it came back; m2 works at its third. The clock is that of the messages."""
    path, schema = shared_path(spark, "retries"), "message_id string, value string, retry_count string, ts timestamp"
    at = lambda s: START + timedelta(seconds=s)
    seen, failing = [], [("m1", "a", None, at(0)), ("m2", "b", "-2", at(0)), ("m3", "c", "x", at(0)), ("m4", "d", "4", at(0)), ("m5", "e", "9", at(0)), (None, None, "3", at(0))]
    for now in (0, 1, 3.5, 8, 16.5):  # when all waiting messages are due
        rows = [*failing, ("tick", None, "9", at(now))]  # a dead letter that moves the clock
        routed = stream_retries(feed(spark, path, rows, schema), path, clock="ts")
        every = {tuple(r) for r in routed.where("message_id <> 'tick'").collect()}
        fresh = every - set(seen)
        seen = list(every)
        assert all(r[3] <= at(now) for r in fresh)
        failing = [(m, v, str(n), due + timedelta(seconds=0.5)) for m, v, n, due, route in fresh if route == "retry" and not (m == "m2" and n == 3)]
    rows = [*failing, ("tick", None, "9", at(60))]
    routed = stream_retries(feed(spark, path, rows, schema), path, clock="ts").where("message_id <> 'tick'").collect()
    count = Counter((r.message_id, r.route) for r in routed)
    assert count == {("m1", "retry"): 4, ("m1", "dead"): 1, ("m3", "retry"): 4, ("m3", "dead"): 1, ("m2", "retry"): 3, ("m4", "dead"): 1, ("m5", "dead"): 1, ("", "retry"): 1, ("", "dead"): 1}
    due = sorted((r.retry_count, (r.due - START).total_seconds()) for r in routed if r.message_id == "m1" and r.route == "retry")
    assert due == [(1, 1), (2, 3.5), (3, 8), (4, 16.5)]
    assert {r.due for r in routed if r.message_id == "" and r.route == "retry"} == {at(8)} and all(r.value is None for r in routed if r.message_id == "")


def test_waiting_on_the_clock_of_the_machine(spark):
    path, schema = shared_path(spark, "retries"), "message_id string, value string, retry_count string"
    assert stream_retries(feed(spark, path, [("m", "x", "0")], schema), path).where("route = 'retry'").count() == 0
    time.sleep(1.2)
    got = stream_retries(feed(spark, path, [("other", "y", "4")], schema), path)
    assert sorted(tuple(r) for r in got.select("message_id", "value", "retry_count", "route").collect()) == [("m", "x", 1, "retry"), ("other", "y", 4, "dead")]


def test_jobs_freeze_and_late_progress_is_reported(spark):
    path, schema = shared_path(spark, "jobs"), "job_id string, ts long, event_id long, status string, processed_pages long"
    jobs = KeyedTable(spark, f"{path}/table", JOBS, ["job_id"], buckets=4)
    held = lambda: sorted(tuple(r) for r in jobs.read().collect())
    step = lambda rows, keep: sorted(tuple(r) for r in stream_job_table(feed(spark, path, rows, schema), jobs, path, keep_ms=keep).collect())
    assert step([("a", 1, 1, "IN_PROGRESS", 3), ("b", 2, 2, "COMPLETED", 9), ("b", 3, 3, "IN_PROGRESS", 4), ("a", 1, 0, "IN_PROGRESS", -5)], 600_000) == []
    assert held() == [("a", "IN_PROGRESS", 3, 2), ("b", "COMPLETED", 9, 1)]
    assert step([("b", 4, 4, "IN_PROGRESS", 5), ("a", 5, 5, "IN_PROGRESS", 7)], 600_000) == []  # frozen
    assert held() == [("a", "IN_PROGRESS", 7, 3), ("b", "COMPLETED", 9, 1)]


def test_state_of_ended_jobs_goes(spark):
    path, schema = shared_path(spark, "jobs"), "job_id string, ts long, event_id long, status string, processed_pages long"
    jobs = KeyedTable(spark, f"{path}/table", JOBS, ["job_id"], buckets=4)
    run = lambda rows: sorted(tuple(r) for r in stream_job_table(feed(spark, path, rows, schema), jobs, path, keep_ms=500).collect())
    assert run([("a", 1, 1, "FAILED", 3), ("c", 1, 2, "IN_PROGRESS", 1)]) == []
    time.sleep(1)
    assert run([("a", 2, 3, "IN_PROGRESS", 8), ("c", 2, 4, "IN_PROGRESS", 2)]) == [("a", "IN_PROGRESS", 8, 1)]
    assert sorted(tuple(r) for r in jobs.read().collect()) == [("a", "FAILED", 3, 1), ("c", "IN_PROGRESS", 2, 2)]
    state = spark.read.format("statestore").option("path", f"{path}/checkpoint").option("stateVarName", "ended").load()
    assert state.where(F.col("key.job_id") == "c").count() == 0
