"""Operator 1: MinHash near-duplicates with sequential Bayesian verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import by_key, lookup, runs, semi_join, stash
from quillspark.llm.graph import components
from quillspark.llm.shingles import MinHasher, WordHashes, shingle_set

#: Hashes of a signature that pairs are compared on, and how many before each look at the posterior.
HASHES, BATCH = 1024, 64
#: Pairs whose signatures are compared at once in a task (memory only).
CHUNK = 1 << 16


@lru_cache
def least_matches(percent: int, miss: float, size: int, batch: int = BATCH) -> list[tuple[int, int]]:
    """(hashes seen, fewest matches with which a pair goes on) after each batch.

    Signatures keep 8 bits of each minimum, so a hash of a pair with
    similarity J matches with probability J + (1 - J) / 256. Under a uniform
    prior the posterior after m matches of n is Beta(m + 1, n - m + 1), and the
    chance that it lies above a bound p equals that of at most m successes in
    n + 1 draws with probability p. A pair goes while that chance is below
    ``miss``.
    """
    p = percent / 100 + (1 - percent / 100) / 256
    bounds = []
    for n in [*range(batch, size, batch), size]:
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += math.exp(
                math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
                + m * math.log(p) + (n + 1 - m) * math.log1p(-p)
            )
        bounds.append((n, m))
    return bounds


def may_be_similar(left: np.ndarray, right: np.ndarray, percent: int, miss: float) -> np.ndarray:
    """Which rows of two signature tables stay after all batches (indices)."""
    alive, matches, seen = np.arange(len(left)), np.zeros(len(left), dtype=np.int32), 0
    for n, least in least_matches(percent, miss, left.shape[1]):
        matches = matches + (left[alive, seen:n] == right[alive, seen:n]).sum(axis=1, dtype=np.int32)
        stays = matches >= least
        alive, matches, seen = alive[stays], matches[stays], n
    return alive


def _table(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(len(column), -1)


def _features(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, hasher = WordHashes(), MinHasher(bands, rows)
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), width, hashes)
                sizes.append(len(shingles))
                if len(shingles):
                    digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                    keys.append(hasher.band_keys(hasher.signature(shingles)))
                else:
                    digests.append(None)
                    keys.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["id", "n_shingles", "digest", "bands"],
            )

    return docs.mapInArrow(each, "id long, n_shingles long, digest binary, bands array<long>")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """Whole shingle sets of documents, and signatures that are independent of the bands."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, hasher = WordHashes(), MinHasher(HASHES, 1, seed=11)
        for batch in batches:
            sets = [shingle_set(text.as_py(), width, hashes) for text in batch.column("text")]
            signatures = [hasher.signature(x).astype(np.uint8).tobytes() for x in sets]
            sets = [x.tobytes() for x in sets]
            digests = [xxhash.xxh3_128_digest(x) for x in sets]
            columns = [pa.array(x, pa.binary()) for x in (sets, signatures, digests)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "shingles", "signature", "digest"])

    sets = docs.mapInArrow(each, "id long, shingles binary, signature binary, digest binary")
    return sets.dropDuplicates(["id", "digest"]).select("id", "shingles", "signature")


def _both_ends(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    left = table.select(F.col("id").alias("a"), F.col(column).alias("left"))
    right = table.select(F.col("id").alias("b"), F.col(column).alias("right"))
    return pairs.join(left, "a").join(right, "b")


def _pruned(pairs: DataFrame, nodes: DataFrame, percent: int, miss: float) -> DataFrame:
    """Pairs that the posterior does not rule out."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                alive = may_be_similar(_table(batch.left), _table(batch.right), percent, miss)
                yield batch[["a", "b"]].iloc[alive]

    return _both_ends(pairs, nodes, "signature").mapInPandas(each, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole shingle sets are similar enough."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = (np.frombuffer(side.as_buffer(), dtype=np.uint64) for side in (left, right))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _both_ends(pairs, sets, "shingles").mapInArrow(each, "a long, b long")


def _cells(shared: DataFrame, block: int) -> DataFrame:
    """Members of the buckets that hold several components, dealt into cells of two blocks each.

    Members of a bucket's largest component are linked already, so only the
    others ("strays") meet: each block of strays meets each block of the largest
    component and each block of strays. Blocks of the largest component have
    negative numbers, so that a cell's two blocks tell its kind.
    """
    parts = shared.groupBy("key", "component").agg(F.count("*").alias("n"))
    top = parts.groupBy("key").agg(F.max(F.struct("n", (-F.col("component")).alias("minus"))).alias("top"), F.sum("n").alias("all"))
    top = top.where(F.col("all") > F.col("top.n"))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(block))).cast("int")
    top = top.select("key", (-F.col("top.minus")).alias("largest"), blocks(F.col("top.n")).alias("long"), blocks(F.col("all") - F.col("top.n")).alias("wide"))
    held, inner = F.col("component") == F.col("largest"), F.xxhash64("id")
    number = F.when(held, -1 - F.pmod(inner, "long")).otherwise(F.pmod(inner, "wide")).cast("int")
    strays = F.sequence(F.lit(0), F.col("wide") - 1)
    of_held = F.transform(strays, lambda other: F.struct(other.alias("low"), F.col("block").alias("high")))
    of_strays = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("long") - 1), lambda other: F.struct(F.col("block").alias("low"), (-1 - other).alias("high"))),
        F.transform(strays, lambda other: F.struct(F.least("block", other).alias("low"), F.greatest("block", other).alias("high"))),
    )
    dealt = shared.join(top, "key").withColumn("block", number).withColumn("cell", F.explode(F.when(held, of_held).otherwise(of_strays)))
    return dealt.select("key", "cell.low", "cell.high", "block", "id", "component")


def _cross_pairs(members: DataFrame, percent: int, miss: float) -> DataFrame:
    """Possible pairs across components within each cell.

    No pair of a bucket ever becomes a row before its signatures were
    compared, and a pair that shares several bands is looked at in the first
    of them only.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, ["key", "low", "high"]):
            low, high = group.low.iat[0], group.high.iat[0]
            ids, owner, part = group.id.to_numpy(), group.component.to_numpy(), group.block.to_numpy()
            size, signature, bands = group.n_shingles.to_numpy(), _table(group.signature), np.stack(group.bands)
            if low == high:
                i, j = np.triu_indices(len(ids), 1)
            else:
                x, y = np.flatnonzero(part == low), np.flatnonzero(part == high)
                i, j = np.repeat(x, len(y)), np.tile(y, len(x))
            fits = (owner[i] != owner[j]) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
            i, j = i[fits], j[fits]
            for start in range(0, len(i), CHUNK):
                x, y = i[start : start + CHUNK], j[start : start + CHUNK]
                alive = may_be_similar(signature[x], signature[y], percent, miss)
                x, y = x[alive], y[alive]
                same = bands[x] == bands[y]
                here = bands[x, same.argmax(axis=1)] == group.key.iat[0]
                x, y = ids[x[here]], ids[y[here]]
                yield pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    return by_key(members, ["key", "low", "high"]).mapInPandas(each, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = 40,
    rows: int = 6,
    miss: float = 1e-5,
    block: int = 512,
) -> DataFrame:
    """Components of documents whose word-shingle sets overlap by ``percent`` of their union.

    Returns one row per input row: the id column (long), ``n_shingles``,
    ``component_id`` (smallest id reachable by links, its own included) and
    ``kept`` (whether the row is that one).

    * Candidates share one of ``bands`` MinHash bands of ``rows`` rows; at
      similarity 0.8 the default misses a pair with a chance of 5e-6.
    * Each band's members meet its most central member first (whose bands hold
      the most documents), then, block by block, the members outside the band's
      largest component meet all that are in other components. Signatures of 1,024 further hashes are compared in
      batches; a pair goes once its posterior chance of being similar is below
      ``miss``.
    * What stays is confirmed on whole shingle sets (64-bit shingle hashes).

    Defined cases: a text with fewer words than ``width`` is one shingle; a
    null, empty or blank text has none and links with nothing. Texts with
    equal sets link. Repeated rows, or several texts under one id, are one
    document. A row with a null id links with nothing, has a null
    component and is kept. Other columns of the input are ignored; an empty
    table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    seen = stash(_features(texts, width, bands, rows), "features")
    real = F.col("id").isNotNull() & F.col("digest").isNotNull()
    classes = seen.where(real).groupBy("digest").agg(F.min("id").alias("rep"))
    firsts = seen.where(real).join(classes, "digest").where("id = rep").dropDuplicates(["digest"])
    firsts = stash(firsts.select("id", "n_shingles", "bands"), "firsts")

    keyed = firsts.select(F.explode("bands").alias("key"), "id")
    crowded = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = stash(keyed.join(crowded, "key"), "shared")
    busy = stash(shared.groupBy("id").agg(F.sum("members").alias("mass")), "busy")
    nodes = stash(semi_join(firsts, busy.select("id"), "id"), "nodes")
    sets = stash(_sets(semi_join(texts, busy.select("id"), "id"), width), "sets")
    marks = sets.select("id", "signature")

    centre = shared.join(busy, "id").groupBy("key").agg(F.max(F.struct("mass", (-F.col("id")).alias("minus"))).alias("c"))
    centre = centre.select("key", (-F.col("c.minus")).alias("pivot"))
    star = shared.join(centre, "key").where("id <> pivot")
    star = star.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
    links = stash(_confirmed(_pruned(star, marks, percent, miss), sets, percent), "links")

    owners = stash(components(links), "owners").withColumnRenamed("id", "node")
    shared = stash(
        shared.join(owners, F.col("id") == F.col("node"), "left").select(
            "key", "id", "members", F.coalesce("component", "id").alias("component")
        ),
        "owned",
    )
    rest = _cells(shared, block).join(nodes.join(marks, "id"), "id")
    late = _confirmed(_cross_pairs(rest, percent, miss).distinct(), sets, percent)
    owners = components(links.unionByName(late)).withColumnRenamed("id", "rep")

    owned = classes.join(owners, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    placed = lookup(seen.where(real).select("id", "n_shingles", "digest"), stash(owned, "classes"), ["digest"])
    alone = seen.where(~real).select("id", "n_shingles", F.col("id").alias("component_id"))
    out = placed.select("id", "n_shingles", "component_id").unionByName(alone)
    return out.select(
        F.col("id").alias(id_col), "n_shingles", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
