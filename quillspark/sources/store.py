"""Keyed tables on plain Parquet: staging, upserts, versions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, the folder that all executors and the driver share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-quill-")  # one process: the folder is shared
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/jobs-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(frame: DataFrame, name: str) -> DataFrame:
    """A result written to the shared folder and read back, which cuts its lineage."""
    path = shared_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Repeated keys that are broadcast; with more of them all rows are shuffled.
_FEW_KEYS = 100_000


def apart(frame: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose key occurs once, the others; None without any). With very many repeated keys no row is in the first.

    Only keys are shuffled, to count them; null keys are equal. The frame is
    read twice, so it should be a table or staged.
    """
    again = stage(frame.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select([F.col(c).alias(f"_{k}") for k, c in enumerate(keys)]), "again")
    count = again.count()
    if not count:
        return frame, None
    if count > _FEW_KEYS:
        return frame.where("false"), frame
    same = [F.col(c).eqNullSafe(F.col(f"_{k}")) for k, c in enumerate(keys)]
    return tuple(frame.join(F.broadcast(again), same, how) for how in ("left_anti", "left_semi"))


def one_per_key(frame: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key; rows whose key occurs once are not shuffled."""
    alone, others = apart(frame, keys)
    return alone if others is None else alone.unionByName(others.dropDuplicates(keys))


def latest_version(frame: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The newest row of each key; the order must be total for a defined result."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    return frame.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def upsert_latest(existing: DataFrame, incoming: DataFrame, keys: list[str], order_by: list[str], *, distinct: bool = False) -> DataFrame:
    """Existing rows without a successor, and the last of the incoming rows of each key (of which ``distinct`` ones have one each)."""
    fresh = incoming if distinct else latest_version(incoming, keys, order_by)
    return existing.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh, allowMissingColumns=True)


def append_records(frame: DataFrame, path: str) -> None:
    """Append to a log; an empty batch writes nothing."""
    if not frame.isEmpty():
        frame.write.mode("append").parquet(path)


def write_points(points: DataFrame, path: str) -> None:
    """Points by pool, into a new folder: a path that is being read is never overwritten."""
    points.write.partitionBy("pool").parquet(path)


def upsert_sync_logs(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Sync logs keyed by job or sync id and mode; the last record replaces the one before.

    Records need an id and a status; times are UTC, counters are not negative.
    ``_seq`` orders the incoming records and is dropped.
    """
    filled = lambda name: F.when(F.trim(F.col(name)) != "", F.col(name))
    key = F.coalesce(F.concat(F.lit("jobId:"), filled("jobId")), F.concat(F.lit("syncId:"), filled("syncId")))
    good = incoming.withColumn("key", key).where(F.col("key").isNotNull() & filled("status").isNotNull())
    now = F.current_timestamp()
    for name in ("startedAt", "completedAt"):
        good = good.withColumn(name, F.try_to_timestamp(F.col(name).cast("string")))
    good = good.withColumn("createdAt", F.coalesce("startedAt", "completedAt", now)).withColumn("updatedAt", F.coalesce("completedAt", now))
    for name in ("updatedPages", "deletedPages", "failedPages", "duration"):
        good = good.withColumn(name, F.greatest(F.lit(0), F.expr(f"try_cast({name} as int)")))
    good = good.withColumn("mode", F.coalesce("mode", F.lit("")))
    fresh = latest_version(good, ["key", "mode"], ["_seq"]).drop("_seq")
    return existing.join(fresh.select("key", "mode"), ["key", "mode"], "left_anti").unionByName(fresh, allowMissingColumns=True)
