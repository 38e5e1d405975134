"""Operator 6: nearest neighbours by stable projections, kd-trees and a chi-square stopping test."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import is_small, stash, unused


def chi_square_below(x: np.ndarray, freedom: int) -> np.ndarray:
    """Distribution function of chi-square with an even number of degrees of freedom."""
    half = x / 2
    term = np.exp(-half)
    total = term.copy()
    for k in range(1, freedom // 2):
        term = term * half / k
        total += term
    return 1 - total


def chi_square_reach(chance: float, freedom: int) -> float:
    """The value below which such a variable lies with the given chance (bisection)."""
    low, high = 0.0, freedom + 40 * math.sqrt(2 * freedom)
    for _ in range(80):
        middle = (low + high) / 2
        if chi_square_below(np.array([middle]), freedom)[0] < chance:
            low = middle
        else:
            high = middle
    return high


def split(points: np.ndarray, least: int, most: int | None = None) -> tuple[list[np.ndarray], list[tuple[int, float, int, int]]]:
    """Leaves of a kd-tree (row numbers), and its inner nodes as (dimension, bound, below, above).

    The largest leaf is halved next, at the median of its widest dimension,
    while it has more than ``least`` rows and there are fewer than ``most``
    leaves. A node number is that of an inner node, or ``-1 - leaf``.
    """
    leaves, nodes = [np.arange(len(points))], []
    todo, holders = [(-len(points), 0)], {0: None}
    while todo and (most is None or len(leaves) < most):
        size, leaf = heapq.heappop(todo)
        if -size <= least:
            break
        rows = leaves[leaf]
        box = points[rows]
        wide = box.max(axis=0) - box.min(axis=0)
        axis = int(wide.argmax())
        if not wide[axis] > 0:
            continue
        bound = float(np.partition(box[:, axis], len(rows) // 2)[len(rows) // 2])
        below = box[:, axis] < bound
        if not below.any():  # half of the rows or more have the smallest value
            bound = float(box[box[:, axis] > bound, axis].min())
            below = box[:, axis] < bound
        leaves[leaf], other = rows[below], len(leaves)
        leaves.append(rows[~below])
        if (at := holders[leaf]) is not None:
            nodes[at[0]][at[1]] = len(nodes)
        holders[leaf], holders[other] = (len(nodes), 2), (len(nodes), 3)
        nodes.append([axis, bound, -1 - leaf, -1 - other])
        for k in (leaf, other):
            heapq.heappush(todo, (-len(leaves[k]), k))
    return leaves, [tuple(x) for x in nodes]


def cell_of(points: np.ndarray, nodes: list[tuple[int, float, int, int]]) -> np.ndarray:
    """The leaf of each point, from a tree's inner nodes."""
    out = np.zeros(len(points), dtype=np.int64)
    todo = [(0, np.arange(len(points)))] if nodes else []
    while todo:
        node, rows = todo.pop()
        axis, bound, *sides = nodes[node]
        below = points[rows, axis] < bound
        for side, part in zip(sides, (rows[below], rows[~below]), strict=True):
            if side < 0:
                out[part] = -1 - side
            elif len(part):
                todo.append((side, part))
    return out


def box_gaps(low: np.ndarray, high: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distance from a point to each box."""
    gap = np.maximum(np.maximum(low - point, point - high), 0)
    return (gap * gap).sum(axis=1)


class Space:
    """Projections of vectors: one more component first lifts each candidate to the largest length found."""

    def __init__(self, width: int, dimensions: int, norm: float, scale: float, seed: int):
        # One more row of directions serves the added component.
        self.directions = np.random.default_rng(seed).standard_normal((width + 1, dimensions))
        self.norm, self.scale = norm, scale

    def query(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.directions[:-1]

    def candidate(self, vectors: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.norm - (vectors * vectors).sum(axis=1), 0))
        return self.query(vectors) + lift[:, None] * self.directions[-1]


class Block:
    """Vectors of a block in the order of the leaves of a kd-tree over their projections.

    Distances of projections and first scores are in single precision; scores
    that count are summed in double precision.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, space: Space, leaf: int):
        points = space.candidate(vectors)
        leaves, _ = split(points, leaf)
        order = np.concatenate(leaves)
        self.ids, self.vectors, self.space = ids[order], vectors[order], space
        self.points, self.rough = points[order].astype(np.float32), self.vectors.astype(np.float32)
        self.squares = (self.points * self.points).sum(axis=1)
        self.sizes = np.array([len(x) for x in leaves])
        self.low, self.high = (np.array([f(points[x], axis=0) for x in leaves]) for f in (np.min, np.max))
        #: Vectors scored so far.
        self.verified = 0

    def search(self, ids: np.ndarray, vectors: np.ndarray, floors: np.ndarray, k: int, reach: float, tile: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the ``k`` nearest found for each query, nearest first; see ``_one``."""
        for first in range(0, len(ids), tile):
            some = vectors[first : first + tile]
            projected = self.space.query(some)
            near = projected.astype(np.float32)
            gaps = None
            for at, query_id in enumerate(ids[first : first + tile].tolist()):
                far = box_gaps(self.low, self.high, projected[at])

                def distances(rows: np.ndarray | None, at: int = at) -> np.ndarray:
                    """Squared distances of projections: of all rows, for the whole tile at once, or of some."""
                    nonlocal gaps
                    if rows is not None:
                        return self.squares[rows] - 2 * (self.points[rows] @ near[at]) + near[at] @ near[at]
                    if gaps is None:
                        gaps = near @ self.points.T
                        gaps *= -2
                        gaps += self.squares
                        gaps += (near * near).sum(axis=1)[:, None]
                    return gaps[at]

                yield self._one(query_id, some[at], far, distances, k, reach, float(floors[first + at]))

    def _one(self, query_id: int, vector: np.ndarray, far: np.ndarray, distances: Callable, k: int, reach: float, floor: float, step: int = 512) -> tuple:
        """The nearest of one query that may belong to its ``k`` best; ``floor``: a k-th best known already.

        A neighbour at squared distance r lies at a projected squared distance
        of r times a chi-square variable, below ``reach`` with the chance asked
        for. Without a floor the nearest leaves give a first k-th best. Then
        points come in order of projected distance, a step at a time, until the
        next one is beyond ``reach`` times the k-th best squared distance.
        """
        ids, scores = np.zeros(0, dtype=np.int64), np.zeros(0)
        lifted, single = float(vector @ vector) + self.space.norm, vector.astype(np.float32)
        slack = 1e-5 * lifted

        def least() -> float:
            return max(floor, scores[-1]) if len(scores) >= k else floor

        def limit() -> float:
            """How far a projection may lie."""
            return reach * (max(lifted - 2 * least(), 0.0) + slack) if least() > -math.inf else math.inf

        def verify(rows: np.ndarray) -> None:
            nonlocal ids, scores
            self.verified += len(rows)
            rough, bound = self.rough[rows] @ single, least()
            if len(rough) > k:  # the query itself may be among them
                bound = max(bound, np.partition(rough, len(rough) - k - 1)[len(rough) - k - 1])
            rows = rows[rough >= bound - slack]
            rows = rows[self.ids[rows] != query_id]
            # Sums in one order for every row: equal vectors get equal scores wherever they are stored.
            ids = np.concatenate([ids, self.ids[rows]])
            scores = np.concatenate([scores, (self.vectors[rows] * vector).sum(axis=1)])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]

        done = np.zeros(len(far), dtype=bool)
        if floor == -math.inf:
            by_distance = np.argsort(far, kind="stable")
            done[by_distance[: 1 + int(np.searchsorted(np.cumsum(self.sizes[by_distance]), 4 * k))]] = True
            verify(np.flatnonzero(np.repeat(done, self.sizes)))
        open_ = far <= limit()
        if 4 * int(self.sizes[open_].sum()) < len(self.ids):
            rows = np.flatnonzero(np.repeat(open_ & ~done, self.sizes))
            gaps = distances(rows)
        else:
            gaps = distances(None)
            rows = np.flatnonzero((gaps <= limit()) & ~np.repeat(done, self.sizes)) if done.any() else np.flatnonzero(gaps <= limit())
            gaps = gaps[rows]
        while len(rows) > step:
            order = np.argpartition(gaps, step)
            verify(rows[order[:step]])
            left = order[step:]
            left = left[gaps[left] <= limit()]
            rows, gaps, step = rows[left], gaps[left], 2 * step
        verify(rows[gaps <= limit()])
        return ids, scores


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    dimensions: int = 32,
    chance: float = 0.9,
    block_rows: int = 8_192,
    query_rows: int = 16_384,
    sample_rows: int = 32_768,
    leaf: int = 64,
    seed: int = 5,
) -> DataFrame:
    """The ``k`` rows with the largest inner product for each row where ``queries`` holds.

    Inner products become distances by one more component, which lifts all
    candidates to the largest length found. Vectors are projected on
    ``dimensions`` (even) Gaussian directions. The upper levels of a kd-tree
    over the projections, fitted on a sample of about ``sample_rows`` rows,
    deal all rows into cells of about ``block_rows``; a cell with more rows
    (many equal vectors, or a table with more than ``sample_rows / 16`` cells)
    is dealt into blocks by a hash of the id. Each block has the lower levels.

    A query first searches a block of its own cell. The k-th best found there
    is its bound: it goes on only to cells whose bounding box passes the
    chi-square test, and in each block it takes vectors in order of projected
    distance, scores them exactly, and stops once a neighbour better than its
    k-th best would have come before with chance ``chance``.

    Every row is indexed. Queries meet a block in groups of at most about
    ``query_rows``; a block is copied only for the groups that it really has.
    Returns ``query_id``, ``rank`` (from 1), the id column and ``score`` (inner
    product in double precision), ties to the smaller id.

    Defined cases: rows with a null id, and vectors that are null, empty, all
    zero, hold null or non-finite components, or have another length than most
    (the most frequent, then the longest, counts), take no part. Of repeated
    rows with one id, one is kept (the greatest vector). A query is never its
    own neighbour; with fewer than k candidates all are returned. Components
    beyond 1e100 are scaled for the search (components that are smaller by 300
    orders of magnitude then count as zero); a score beyond the range of doubles
    is infinite. Other columns are ignored; an empty table gives an empty result.
    """
    if dimensions % 2:
        raise ValueError("the number of projections must be even")
    spark = vectors.sparkSession
    asks = unused(vectors, "asks")[0]
    real = vectors.withColumn(asks, queries).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    real = real.where(F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    real = real.groupBy("id").agg(F.max(F.struct("vector", "asks")).alias("row")).select("id", "row.vector", "row.asks")
    real = stash(real, "vectors")
    shape = real.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if shape is None:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    width = shape["width"]
    real = real.where(F.size("vector") == width)
    total, largest = real.agg(F.count("*"), F.max(F.array_max(F.transform("vector", F.abs)))).first()
    # A power of two changes no digits.
    scale = 1.0 if largest < 1e100 else 2.0 ** -math.frexp(largest)[1]
    squares = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * F.lit(scale) * x * F.lit(scale))
    norm = real.agg(F.max(squares)).first()[0]
    space, reach = Space(width, dimensions, norm, scale, seed), chi_square_reach(chance, dimensions)

    def table(column: pa.Array) -> np.ndarray:
        return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width) * scale

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = space.candidate(table(batch.column("vector")))
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(points.ravel(), dimensions).cast(pa.list_(pa.float64()))], ["point"])

    # A sample of about the given size, whatever the table's; only its projections come to the driver.
    chosen = real.where(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(total)) < sample_rows).select("vector")
    sample = chosen.mapInArrow(project, "point array<double>").toArrow().column("point")
    sample = np.asarray(sample.combine_chunks().flatten(), dtype=np.float64).reshape(-1, dimensions)
    _, nodes = split(sample, 16, max(1, min(round(total / block_rows), sample_rows // 16)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = cell_of(space.candidate(table(batch.column("vector"))), nodes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64())], [*batch.schema.names, "cell"])

    placed = stash(real.mapInArrow(place, "id long, vector array<double>, asks boolean, cell long"), "cells")

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, cells = space.candidate(table(batch.column("vector"))), np.asarray(batch.column("cell"))
            for cell in np.unique(cells).tolist():
                part = points[cells == cell]
                out = {"cell": cell, "axis": np.arange(dimensions), "low": part.min(axis=0), "high": part.max(axis=0)}
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out), preserve_index=False)

    # One row per cell and axis, sample_rows / 16 cells at most.
    boxes = placed.mapInArrow(edges, "cell long, axis long, low double, high double").groupBy("cell", "axis")
    boxes = boxes.agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas().sort_values(["cell", "axis"])
    low, high = (boxes[c].to_numpy().reshape(-1, dimensions) for c in ("low", "high"))
    sizes = placed.groupBy("cell").count().toPandas().set_index("cell")["count"]
    cells = sorted(sizes.index.tolist())
    blocks = [max(1, round(sizes[c] / block_rows)) for c in cells]
    dealt = F.broadcast(spark.createDataFrame(list(zip(cells, blocks, strict=True)), "cell long, blocks long"))
    points = placed.join(dealt, "cell").select("id", "vector", "cell", F.pmod(F.xxhash64("id"), "blocks").alias("block"))
    asked = placed.where("asks").join(dealt, "cell").select("id", "vector", "cell", F.pmod(F.xxhash64("id", F.lit(1)), "blocks").alias("block"))
    keys = ["cell", "block", "part"]

    def search(key: tuple, points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))]
        if len(points) and len(asked):
            block = Block(points.id.to_numpy(), np.stack(points.vector.to_numpy()).astype(np.float64) * scale, space, leaf)
            queries = np.stack(asked.vector.to_numpy()).astype(np.float64) * scale
            for query_id, (ids, scores) in zip(asked.id.tolist(), block.search(asked.id.to_numpy(), queries, asked.floor.to_numpy(), k, reach), strict=True):
                found.append((np.full(len(ids), query_id), ids, scores))
        return pd.DataFrame(dict(zip(("query_id", "id", "score"), (np.concatenate(x) for x in zip(*found, strict=True)), strict=True)))

    def meet(asked: DataFrame, load: DataFrame) -> DataFrame:
        """The nearest found in the blocks that the queries are sent to; ``load`` counts those of each block."""
        load = stash(load.withColumn("parts", F.ceil(F.col("n") / query_rows)).drop("n"), "load")
        units = load.agg(F.sum("parts")).first()[0] or 0
        load = F.broadcast(load) if is_small(load) else load
        left = points.join(load, keys[:2]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
        right = asked.join(load, keys[:2]).withColumn("part", F.pmod(F.xxhash64("id", F.lit(3)), "parts")).drop("parts")
        # Few rows, much work: a task for every block and group, not for so many bytes.
        tasks = max(1, min(units, 20_000))
        left, right = (x.select([F.col(c).alias(c) for c in x.columns]).repartition(tasks, *keys) for x in (left, right))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query_id long, id long, score double")

    load = asked.groupBy("cell", "block").agg(F.count("*").alias("n"))
    first = stash(meet(asked.withColumn("floor", F.lit(-math.inf)), load), "own-cells")
    bound = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(-math.inf)).alias("floor"))
    bound = asked.join(bound, "id", "left").select("id", "vector", "cell", "block", F.coalesce("floor", F.lit(-math.inf)).alias("floor"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts = np.array(cells), np.array(blocks)
        for batch in batches:
            table_, out = table(batch.column("vector")), []
            projected, squares = space.query(table_), (table_ * table_).sum(axis=1)
            rows = zip(*(batch.column(c).to_pylist() for c in ("id", "cell", "block", "floor")), strict=True)
            for at, (query_id, cell, block, floor) in enumerate(rows):
                limit = reach * max(squares[at] + norm - 2 * floor, 0.0) if floor > -math.inf else math.inf
                passed = box_gaps(low, high, projected[at]) <= limit + 1e-9 * (squares[at] + norm)
                to = np.repeat(names[passed], counts[passed])
                part = np.concatenate([np.zeros(0, dtype=np.int64), *(np.arange(n) for n in counts[passed].tolist())])
                other = (to != cell) | (part != block)
                out.append((np.full(int(other.sum()), query_id), to[other], part[other]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out, strict=True)], ["id", "cell", "block"])

    sent = stash(bound.mapInArrow(route, "id long, cell long, block long"), "sent")
    load = sent.groupBy("cell", "block").agg(F.count("*").alias("n"))
    others = meet(sent.join(bound.select("id", "vector", "floor"), "id"), load)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = first.unionByName(others).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), (F.col("score") / scale / scale).alias("score"))
