"""Corpus preparation: five stages, each an operator of ``quillspark.llm``.

``run`` applies them in order to the documents of a folder. In between, each
stage's result is written as Parquet to the shared folder and read back, so
that a stage never computes an earlier one again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import is_small, stash, unused
from quillspark.llm.decontamination import decontaminate
from quillspark.llm.mixing import mix_sources
from quillspark.llm.near_dup import near_duplicates
from quillspark.llm.sharding import assign_shards, layout
from quillspark.llm.toxicity import drop_toxic

SHARDS = 40


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the toxicity classifier rejects go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each group of near-duplicates (five-word shingles, 0.8) the smallest id stays."""
    found, name = near_duplicates(docs, width=5, percent=80), unused(docs, "gone")[0]
    gone = stash(found.where("not kept").select(F.col("doc_id").alias(name)).distinct(), "gone")
    gone = F.broadcast(gone) if is_small(gone) else gone
    return docs.join(gone, docs["doc_id"].cast("long") == gone[name], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents repeat so that sources meet the square roots of their sizes, in shuffled order.

    Sizes are counted from the texts; a source without any text keeps a copy of each document on average. Columns of
    the input keep their values, whatever their names.
    """
    copy, key = unused(docs, "copy", "shuffle_key")
    size = F.coalesce(F.length("text"), F.lit(0))
    return mix_sources(docs, size=size, temperature=0.5, bare=1.0, copy_col=copy, order_col=key).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: each copy gets the shard of its id in a tree of 40 shards."""
    return assign_shards(docs, layout(SHARDS))


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL cannot express the label model and the classifier of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the documents' columns and ``shard``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
