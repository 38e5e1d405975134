"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import stash


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 65536)).first())


def components(edges: DataFrame) -> DataFrame:
    """Smallest id reachable from each id of an undirected link table.

    ``edges`` has long columns ``a`` and ``b``; rows with a null or with
    ``a = b`` count for nothing. Returns ``id`` and ``component``, one row for
    each id that has a link; an empty table gives an empty result.

    Large-star and small-star steps alternate until the links no longer
    change. Each is a grouped minimum, combined before the shuffle, and a join
    to one row per id, so that an id with very many links never gathers them
    in one task.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stash(links, "links")
    seen = _print_of(links)
    while seen[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lows = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(lows, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        lows = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lows, "a").select(
            F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b")
        )
        links = stash(small.where("a <> b").distinct(), "links")
        now = _print_of(links)
        if now == seen:
            break
        seen = now
    ends = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ends.unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
