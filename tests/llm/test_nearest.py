"""Operator 6: the tree, the bounds, and searches against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from quillspark.llm.nearest import Block, Space, box_gaps, cell_of, chi_square_reach, nearest_neighbours, split


def test_tree_covers_every_point_once():
    draw = np.random.default_rng(1)
    for points in (draw.standard_normal((3000, 6)), np.repeat(draw.standard_normal((5, 6)), 200, axis=0), np.zeros((100, 6)), np.zeros((0, 6))):
        leaves, nodes = split(points, 16, 40)
        assert sorted(np.concatenate(leaves).tolist()) == list(range(len(points))) and len(nodes) == len(leaves) - 1 <= 39
        where = cell_of(points, nodes)
        assert all((where[rows] == k).all() for k, rows in enumerate(leaves))
    leaves, _ = split(np.append(np.zeros(500), 1.0)[:, None], 16)  # nearly all equal
    assert sorted(map(len, leaves)) == [1, 500]
    low, high = np.array([[0.0, 0.0]]), np.array([[1.0, 1.0]])
    assert box_gaps(low, high, np.array([0.5, 0.5]))[0] == 0 and box_gaps(low, high, np.array([2.0, -1.0]))[0] == 2


def clustered(draw, n, width=64, groups=40):
    centres = draw.standard_normal((groups, width))
    return centres[draw.integers(0, groups, n)] + 0.2 * draw.standard_normal((n, width))


def test_search_prunes_where_neighbours_are_near():
    vectors = clustered(np.random.default_rng(2), 8000)
    ids, space, reach = np.arange(8000), Space(64, 32, float((vectors**2).sum(axis=1).max()), 1.0, 5), chi_square_reach(0.9, 32)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    space.norm = 1.0 + 1e-9
    block = Block(ids, vectors, space, 64)
    asked = np.arange(0, 8000, 80)
    exact = vectors[asked] @ vectors.T
    exact[np.arange(len(asked)), asked] = -9
    hits = 0
    for k, (found, scores) in enumerate(block.search(asked, vectors[asked], np.full(len(asked), -np.inf), 20, reach)):
        best = np.lexsort((ids, -exact[k]))[:20]
        hits += len(set(found.tolist()) & set(best.tolist()))
        assert np.allclose(scores, exact[k][found]) and (np.diff(scores) <= 0).all()
    assert hits >= 0.95 * 20 * len(asked) and block.verified <= 0.2 * 8000 * len(asked)


def brute(rows, asks, k):
    out = {}
    for q, v in rows:
        if asks(q):
            ranked = sorted((-float((np.array(v) * np.array(w)).sum()), i) for i, w in rows if i != q)[:k]
            out[q] = [i for _, i in ranked]
    return out


def recall(frame, rows, asks, condition, k=10, **options):
    got = {}
    for r in nearest_neighbours(frame, condition, k=k, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r.rank == len(got[r.query_id])
    want = brute(rows, asks, k)
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) == len(set(got[q])) for q in want)
    return np.mean([len(set(got[q]) & set(want[q])) / k for q in want])


def test_hot_vector_many_cells_and_lengths(spark):
    """A third of the rows equal, lengths from 0.1 to 3, cells split by hash, groups of queries."""
    draw = np.random.default_rng(3)
    vectors = clustered(draw, 1200, 16, 12) * draw.uniform(0.1, 3, (1200, 1))
    vectors[::3] = vectors[0]
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit("x")).withColumn("asks", F.lit(1))
    asks = lambda i: i % 20 == 0
    for options in ({}, {"block_rows": 60, "query_rows": 5}, {"block_rows": 40, "sample_rows": 64}):
        assert recall(frame, rows, asks, F.col("vec_id") % 20 == 0, **options) >= 0.9  # the default chance
    # Equal vectors tie: the smaller ids win.
    hot = nearest_neighbours(frame, F.col("vec_id") == 0, k=5, block_rows=60).where("score >= 0").orderBy("rank").collect()
    same = [r.vec_id for r in hot if abs(r.score - float(vectors[0] @ vectors[0])) < 1e-9]
    assert same == [3 * k for k in range(1, len(same) + 1)]


def test_extreme_components(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e200, 1e199]), (2, [-1e200, 0.0]), (3, [3e200, 1.0]), (4, [0.0, 1e200]), (5, [1e-300, 1e-300])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest_neighbours(frame, F.col("vec_id") == 0, k=5).orderBy("rank").collect()
    assert len(got) == 5 and {r.vec_id for r in got} == {1, 2, 3, 4, 5} and got[-1].vec_id == 2
    assert got[0].score == math.inf and got[-1].score == -math.inf
