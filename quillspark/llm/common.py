"""Plumbing shared by the operators: the shared folder, checked broadcasts, runs of rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a broadcast side may have; narrow rows, so some tens of MB at most.
BROADCAST_ROWS = 500_000


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors and the driver share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-quill-")  # one process: the folder is shared
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/quillspark-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stash(frame: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared folder and read it back: lineage ends there.

    A lost executor takes none of it away, and each later use reads only the
    columns it needs. The folder goes with the application's other
    checkpoints; nothing is kept on an executor's own disk.
    """
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def unused(frame: DataFrame, *names: str) -> list[str]:
    """The names, made longer until no column of the frame has them (Spark ignores their case)."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def is_small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has at most ``rows`` rows; counts no further than that."""
    return frame.limit(rows + 1).count() <= rows


def semi_join(frame: DataFrame, keys: DataFrame, on: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose key is in ``keys`` (distinct): by broadcast behind a row count, else by shuffle."""
    return frame.join(F.broadcast(keys) if is_small(keys, rows) else keys, on, "left_semi")


def lookup(frame: DataFrame, table: DataFrame, on: list[str], rows: int = 50_000) -> DataFrame:
    """Left join to a table with one row per key: by broadcast behind a row count, else by sort and merge.

    Each row meets one row at most, so where a key holds very many rows
    adaptive execution can split its partition and read the one row again.
    """
    return frame.join(F.broadcast(table) if is_small(table, rows) else table, on, "left")


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of a partition that is sorted by ``keys``; a group may span batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        held.append(batch)
        last, first = batch[keys].iloc[-1].tolist(), held[0][keys].iloc[0].tolist()
        if last == first:
            continue
        whole = pd.concat(held, ignore_index=True) if len(held) > 1 else batch.reset_index(drop=True)
        changed = (whole[keys] != whole[keys].shift()).any(axis=1).to_numpy().nonzero()[0].tolist()
        for start, end in zip(changed, changed[1:], strict=False):
            yield whole.iloc[start:end]
        held = [whole.iloc[changed[-1] :]]
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]


def by_key(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Deal rows out by key and sort each partition, as ``runs`` needs them."""
    return frame.repartition(*keys).sortWithinPartitions(*keys)
