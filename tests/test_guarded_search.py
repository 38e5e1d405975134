"""Filters of each query's own, and sparse search by bounds, against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.operators import search, visibility
from quillspark.operators.search import TextBlocks

POINT = "id long, allowed_groups array<string>, allowed_users array<string>, kind string, tags array<string>"
QUERY = "query_id long, groups array<string>, user string, filters map<string,array<string>>"


def people(seed, points=240, queries=30):
    draw = random.Random(seed)
    some = lambda tag, n, most: draw.choice([None, [f"{tag}{draw.randrange(n)}" for _ in range(draw.randint(0, most))]])
    shown = [
        (k, draw.choice([["*"], some("g", 150, 3)]) if k % 3 == 0 else some("g", 9, 3), some("u", 5, 2), draw.choice(["a", "b", None]), some("t", 4, 2)) for k in range(points)
    ]
    asked = []
    for k in range(queries):
        wanted = {f: v for f, v in (("kind", draw.choice([[], ["a"], ["a", "b"]])), ("tags", ["t1", "t2"])) if draw.random() < 0.4}
        asked.append((k, some("g", 9, 3), draw.choice([None, "u1", "u2", "g1"]), draw.choice([wanted, wanted, None])))
    return shown, asked


def may(point, query):
    _, groups, users, kind, tags = point
    _, mine, user, filters = query
    seen = set(groups or []) & {*(mine or []), "*"} or user in (users or [])
    fields = {"kind": {kind} - {None}, "tags": set(tags or [])}
    return bool(seen) and all(fields[f] & set(v) for f, v in (filters or {}).items())


def marked(spark, shown, asked):
    points = spark.createDataFrame(shown, POINT).withColumn("marks", visibility.point_marks(["kind", "tags"], arrays=["tags"]))
    return points, spark.createDataFrame(asked, QUERY).withColumn("marks", visibility.query_marks(["kind", "tags"]))


def test_marks_are_the_filters(spark, monkeypatch):
    monkeypatch.setattr(visibility, "AT_ONCE", 7)
    shown, asked = people(3)
    points, queries = (x.orderBy(x.columns[0]).toPandas().marks.tolist() for x in marked(spark, shown, asked))
    got = visibility.visible(points, queries)
    assert got.tolist() == [[may(p, q) for p in shown] for q in asked]
    assert 0.02 < got.mean() < 0.9 and visibility.visible([], queries).shape == (30, 0) and visibility.visible(points, []).shape == (0, 240)


@pytest.mark.parametrize("blocks", [8192, 8])
def test_dense_search_ranks_what_a_user_may_see(spark, monkeypatch, blocks):
    monkeypatch.setattr(search, "QUERY_BLOCK", blocks)
    monkeypatch.setattr(search, "POINT_BLOCK", 50)
    shown, asked = people(5)
    draw = np.random.default_rng(1)
    table, wanted = draw.standard_normal((240, 6)), draw.standard_normal((30, 6))
    points, queries = marked(spark, shown, asked)
    vectors = lambda x, name: spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], f"{name} long, dense array<double>")
    found = search.dense_search(points.join(vectors(table, "id"), "id"), queries.join(vectors(wanted, "query_id"), "query_id"), k=5, where=F.col("id") != 11)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id))
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    scores = unit(wanted) @ unit(table).T
    for q in asked:
        seen = sorted((-scores[q[0], p[0]], p[0]) for p in shown if may(p, q) and p[0] != 11)[:5]
        assert [i for _, i in sorted(got.get(q[0], []))] == [i for _, i in seen]


def texts_and_questions(seed, texts=300, questions=12):
    draw = random.Random(seed)
    words = lambda n: {draw.choices(range(60), range(60, 0, -1))[0]: draw.randint(1, 4) for _ in range(n)}
    return {k: words(draw.randint(1, 30)) for k in range(texts)}, {k: words(draw.randint(0, 6)) for k in range(questions)}


def brute(held, asked, k, sees=lambda text, question: True):
    out = {}
    df = {i: sum(i in t for t in held.values()) for t in held.values() for i in t}
    for q, terms in asked.items():
        rows = []
        for name, t in held.items():
            if sees(name, q) and set(t) & set(terms):
                rows.append((-round(sum(v * t[i] * np.log1p((len(held) - df[i] + 0.5) / (df[i] + 0.5)) for i, v in terms.items() if i in t), 9), name))
        out[q] = sorted(rows)[:k]
    return {q: [n for _, n in rows] for q, rows in out.items() if rows}


@pytest.mark.parametrize("blocks", [8192, 5])
def test_sparse_search_by_bounds(spark, monkeypatch, blocks):
    monkeypatch.setattr(search, "QUERY_BLOCK", blocks)
    monkeypatch.setattr(search, "POINT_BLOCK", 60)
    monkeypatch.setattr(search, "TEXT_BLOCK", 4)
    held, questions = texts_and_questions(7)
    flat = lambda x, name: spark.createDataFrame([(k, i, tf) for k, t in x.items() for i, tf in t.items()], f"{name} long, idx int, tf int")
    terms, asked = flat(held, "id"), flat(questions, "query_id")
    shown, users = people(9, 300, 12)
    points, queries = marked(spark, shown, users)
    gone = {k for k in held if k % 9 == 4}

    def run(**options):
        got = {}
        for r in search.sparse_search(terms, asked, k=6, **options).collect():
            got.setdefault(r.query_id, []).append((r.rank, r.id))
        return {q: [i for _, i in sorted(rows)] for q, rows in got.items()}

    assert run() == brute(held, questions, 6)
    assert run(about=points.where("id % 9 <> 4").select("id")) == brute(held, questions, 6, lambda t, q: t not in gone)
    seen = brute(held, questions, 6, lambda t, q: t not in gone and may(shown[t], users[q]))
    assert run(about=points.where("id % 9 <> 4"), asking=queries) == seen
    assert search.sparse_search(terms, asked.limit(0)).count() == 0 and search.sparse_search(terms.limit(0), asked).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 9), st.integers(1, 12))
def test_bounds_lose_no_text(seed, texts, size, k):
    draw = np.random.default_rng(seed)
    lists = [np.sort(draw.choice(30, draw.integers(0, 12), replace=False)) for _ in range(texts)]
    weights = [draw.integers(1, 5, len(x)).astype(float) for x in lists]
    wanted = np.sort(draw.choice(40, draw.integers(0, 8), replace=False))
    value, allowed, ids = draw.random(len(wanted)) + 0.1, draw.random(texts) < 0.7, draw.permutation(texts)
    of = dict(zip(wanted.tolist(), value, strict=True))
    full = np.array([sum(of.get(i, 0) * w for i, w in zip(x.tolist(), y, strict=True)) for x, y in zip(lists, weights, strict=True)])
    best = [r for r in np.lexsort((ids, -np.round(full, 9))) if full[r] > 0 and allowed[r]][:k]
    rows, scores, _ = TextBlocks(lists, weights, size).search(wanted, value, allowed, k, 0.0, ids)
    assert rows.tolist() == best and np.allclose(scores, full[best])
    least = scores[-1] if len(rows) == k else 0.0
    assert TextBlocks(lists, weights, size).search(wanted, value, allowed, k, least, ids)[0].tolist() == best


def test_blocks_below_the_score_to_beat_are_not_scored():
    """64 of 20,000 texts hold a rare word: their blocks alone are scored, and fewer yet once a score to beat is known."""
    draw = np.random.default_rng(2)
    lists = [np.unique(np.r_[draw.integers(0, 50, 10), [99] if k % 311 == 0 else []]).astype(int) for k in range(20_000)]
    blocks, ids = TextBlocks(lists, [np.ones(len(x)) for x in lists], 32), np.arange(20_000)
    wanted, value = np.array([3, 7, 99]), np.array([0.1, 0.1, 5.0])
    rows, scores, scored = blocks.search(wanted, value, None, 10, 0.0, ids)
    assert len(rows) == 10 and blocks.blocks == 625 and scored <= 66 and all(99 in lists[r] for r in rows)
    _, _, again = blocks.search(wanted, value, None, 10, scores[-1], ids)
    assert again <= scored
    assert blocks.search(wanted, value, None, 10, 6.0, ids)[2] == 0
