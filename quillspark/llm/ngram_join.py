"""Operator 13: Jaccard join of word n-grams over size-banded tiles with bitmap bounds."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import by_key, lookup, runs, semi_join, stash
from quillspark.llm.graph import components
from quillspark.llm.near_dup import _both_ends, _cells, _confirmed
from quillspark.llm.shingles import WordHashes, mix, shingle_set

#: Sizes of sets in one band are within this ratio.
RATIO = 1.25
#: Pairs whose bitmaps are compared at once in a task (memory only).
CHUNK = 1 << 14
_SALT, _LOW = np.uint64(0xD6E8FEB86659FD93), np.uint64((1 << 26) - 1)


class Bands:
    """Bands of set sizes, and the tiles of a set in its own band and in those of smaller partners.

    Two similar sets, the smaller of size s, differ in at most
    s * (100 - percent) / percent elements. A tile's band is the smaller's, so
    a set also goes into lower bands if a partner of it may be there.

    A band deals elements into two parts more than that difference. A similar
    pair agrees in two parts at least. Either one of these holds elements: then
    both sets have the tile of that part's contents. Or both are empty: then
    both sets have the tile of those two empty parts.
    """

    def __init__(self, percent: int):
        self.percent, self.starts = percent, [1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(max(self.starts[-1] + 1, int(self.starts[-1] * RATIO)))

    def of(self, size: int) -> range:
        """The bands of all smaller sets that a set of this size may be similar to."""
        least = -(-size * self.percent // 100)
        return range(bisect_right(self.starts, least) - 1, bisect_right(self.starts, size))

    def parts(self, band: int) -> int:
        return (self.starts[band + 1] - 1) * (100 - self.percent) // self.percent + 2

    def tiles(self, shingles: np.ndarray, band: int) -> np.ndarray:
        """Keys of the set's tiles in a band; none where only equal sets are similar."""
        count = self.parts(band)
        if count == 2:
            return np.zeros(0, dtype=np.int64)
        salt = mix(np.array([band + 1], dtype=np.uint64) * _SALT)
        spread = mix(shingles ^ salt)
        part = ((spread >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
        # Sums of 26 bits at a time are exact in doubles, which bincount adds up.
        low, high = (np.bincount(part, (spread >> np.uint64(shift) & _LOW).astype(np.float64), count).astype(np.uint64) for shift in (0, 26))
        sizes = np.bincount(part, minlength=count)
        held, void = np.flatnonzero(sizes), np.flatnonzero(sizes == 0)
        keys = mix((mix(low + salt) * _SALT + high)[held] * _SALT + held.astype(np.uint64))
        pairs = [(x * count + y) * 2 + 1 for x, y in combinations(void.tolist(), 2)]
        keys = np.concatenate([keys, mix(mix(np.array(pairs, dtype=np.uint64) + salt) + salt)]) if pairs else keys
        return keys.view(np.int64)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """A bit for each element's hash, in at least twice as many bits as there are elements (a power of two)."""
    bits = max(64, 1 << int(2 * len(shingles) - 1).bit_length())
    at = mix(shingles + _SALT) & np.uint64(bits - 1)
    out = np.zeros(bits, dtype=bool)
    out[at.astype(np.int64)] = True
    return np.packbits(out, bitorder="little").view(np.uint64)


def folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of equal length: longer ones are folded, so that each element keeps its bit."""
    tables = [np.frombuffer(x, dtype=np.uint64) for x in maps]
    width = min(map(len, tables))
    return np.stack([np.bitwise_or.reduce(x.reshape(-1, width)) for x in tables])


def may_overlap(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which rows may be similar; ``sizes`` are the sums of both sets' sizes.

    Every bit in which two bitmaps differ comes from an element that only one
    of the sets has, so the sets share at most half of what remains.
    """
    differ = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
    common = (sizes - differ) // 2
    return 100 * common >= percent * (sizes - common)


def _features(docs: DataFrame, width: int, percent: int) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bands = WordHashes(), Bands(percent)
        for batch in batches:
            sizes, digests, maps, tiles = [], [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), width, hashes)
                some = len(shingles) > 0
                sizes.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if some else None)
                maps.append(bitmap(shingles).tobytes() if some else None)
                tiles.append([bands.tiles(shingles, b) for b in bands.of(len(shingles))] if some else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(maps, pa.binary()),
                    pa.array(tiles, pa.list_(pa.list_(pa.int64()))),
                ],
                ["id", "n_shingles", "digest", "bitmap", "tiles"],
            )

    return docs.mapInArrow(each, "id long, n_shingles long, digest binary, bitmap binary, tiles array<array<long>>")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """Whole sorted shingle sets of documents."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(text.as_py(), width, hashes).tobytes() for text in batch.column("text")]
            columns = [pa.array(sets, pa.binary()), pa.array([xxhash.xxh3_128_digest(x) for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "shingles", "digest"])

    return docs.mapInArrow(each, "id long, shingles binary, digest binary").dropDuplicates(["id", "digest"]).select("id", "shingles")


def _bounded(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Pairs that their bitmaps do not rule out."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            sizes = (batch.left_size + batch.right_size).to_numpy()
            width = np.minimum(batch.left.str.len(), batch.right.str.len()).to_numpy()
            for w in np.unique(width):
                rows = np.flatnonzero(width == w)
                both = folded([*batch.left.iloc[rows], *batch.right.iloc[rows]])
                keep[rows] = may_overlap(both[: len(rows)], both[len(rows) :], sizes[rows], percent)
            yield batch.loc[keep, ["a", "b"]]

    left, right = (
        maps.select(F.col("id").alias(end), F.col("bitmap").alias(side), F.col("n_shingles").alias(f"{side}_size")) for end, side in (("a", "left"), ("b", "right"))
    )
    return pairs.join(left, "a").join(right, "b").mapInPandas(each, "a long, b long")


def _tile_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs across components within each cell of a tile that their bitmaps do not rule out."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, ["key", "low", "high"]):
            low, high = group.low.iat[0], group.high.iat[0]
            ids, owner, part, size = (group[c].to_numpy() for c in ("id", "component", "block", "n_shingles"))
            maps = folded(group.bitmap.tolist())
            for x in np.flatnonzero(part == low):
                y = np.flatnonzero(part == high)
                y = y[y > x] if low == high else y
                y = y[(owner[y] != owner[x]) & (100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x]))]
                for start in range(0, len(y), CHUNK):
                    some = y[start : start + CHUNK]
                    some = some[may_overlap(maps[x][None, :], maps[some], size[some] + size[x], percent)]
                    if len(some):
                        yield pd.DataFrame({"a": np.minimum(ids[x], ids[some]), "b": np.maximum(ids[x], ids[some])})

    return by_key(members, ["key", "low", "high"]).mapInPandas(each, "a long, b long")


def _once(shared: DataFrame) -> DataFrame:
    """Only one of the tiles that have the same members (by count and two sums of 64-bit hashes)."""
    marks = [F.sum(F.xxhash64("id", F.lit(k)).cast("decimal(20,0)")).alias(f"mark{k}") for k in (0, 1)]
    tiles = shared.groupBy("key").agg(F.count("*").alias("members"), *marks)
    return shared.join(tiles.groupBy("members", "mark0", "mark1").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")


def ngram_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90, block: int = 512) -> DataFrame:
    """Components of documents whose sets of word n-grams overlap by ``percent`` of their union, exactly.

    Returns one row per input row: the id column (long), ``n_shingles`` and
    ``component_id`` (smallest id reachable by links, its own included).

    * Equal sets are one class. Tiles (``Bands``) find every pair of classes
      that may be similar: none is lost, and texts that share no part of their
      contents do not meet. Of tiles with the same members one is looked at.
    * In each tile the members first meet the one whose tiles hold the most
      sets; then, block by block, those outside the tile's largest component
      meet all that are in other components. Bitmaps of hashed elements bound
      the overlap from above; pairs within the bound become rows, and whole
      sorted sets (64-bit hashes of n-grams) decide.

    Two members of one component are not compared unless one of them links the
    other, so a group of very many near copies costs its size, not its square.

    Defined cases: a text with fewer words than ``width`` is one n-gram; a
    null, empty or blank text has none and links with nothing. Repeated rows,
    or several texts under one id, are one document. A row with a null id links
    with nothing and has a null component. Other columns of the input are
    ignored; an empty table gives an empty result.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must be between 1 and 100")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    seen = stash(_features(texts, width, percent), "features")
    real = F.col("id").isNotNull() & F.col("digest").isNotNull()
    classes = seen.where(real).groupBy("digest").agg(F.min("id").alias("rep"))
    firsts = seen.where(real).join(classes, "digest").where("id = rep").dropDuplicates(["digest"])
    firsts = stash(firsts.select("id", "n_shingles", "bitmap", "tiles"), "firsts")

    keyed = firsts.select("id", F.explode(F.flatten("tiles")).alias("key"))
    crowded = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = stash(_once(stash(keyed.join(crowded, "key"), "crowded")), "shared")
    busy = stash(shared.groupBy("id").agg(F.sum("members").alias("mass")), "busy")
    nodes = stash(semi_join(firsts.select("id", "n_shingles", "bitmap"), busy.select("id"), "id"), "nodes")
    sets = stash(_sets(semi_join(texts, busy.select("id"), "id"), width), "sets")

    centre = shared.join(busy, "id").groupBy("key").agg(F.max(F.struct("mass", (-F.col("id")).alias("minus"))).alias("c"))
    star = shared.join(centre.select("key", (-F.col("c.minus")).alias("pivot")), "key").where("id <> pivot")
    star = star.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
    links = stash(_confirmed(_bounded(star, nodes, percent), sets, percent), "links")

    owners = stash(components(links), "owners").withColumnRenamed("id", "node")
    owned = shared.join(owners, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    cells = _cells(stash(owned, "owned"), block).join(nodes, "id")
    late = _confirmed(_tile_pairs(cells, percent).distinct(), sets, percent)
    owners = components(links.unionByName(late)).withColumnRenamed("id", "rep")

    owned = classes.join(owners, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    placed = lookup(seen.where(real).select("id", "n_shingles", "digest"), stash(owned, "classes"), ["digest"])
    alone = seen.where(~real).select("id", "n_shingles", F.col("id").alias("component_id"))
    out = placed.select("id", "n_shingles", "component_id").unionByName(alone)
    return out.withColumnRenamed("id", id_col)
