"""The dense search when there are more queries than one broadcast takes, and access lists over deep and circular trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.functions.text import top_share
from quillspark.operators import access, search


def test_blocks_of_queries_and_points(spark, monkeypatch):
    draw = np.random.default_rng(8)
    table = draw.standard_normal((300, 5))
    table[7] = 0
    table[20] = table[21]
    points = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(table)], "id long, dense array<double>")
    asked = points.where("id < 90").select(F.col("id").alias("query_id"), "dense")
    names = ["query_id", "rank", "id"]
    whole = sorted(tuple(r) for r in search.dense_search(points, asked, k=6).select(*names).collect())
    monkeypatch.setattr(search, "QUERY_BLOCK", 20)
    monkeypatch.setattr(search, "POINT_BLOCK", 64)
    assert sorted(tuple(r) for r in search.dense_search(points, asked, k=6).select(*names).collect()) == whole and len(whole) == 540
    unit = table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-300)
    for q in (0, 7, 20, 89):
        scores = np.round(unit @ unit[q], 12)
        assert [i for a, _, i in whole if a == q] == np.lexsort((np.arange(300), -scores))[:6].tolist()
    assert search.dense_search(points, asked.limit(0), k=6).count() == 0 and search.dense_search(points.limit(0), asked, k=6).count() == 0


@pytest.mark.parametrize("policy", ["mark_missing", "allow_authenticated"])
def test_access_lists_by_doubling(spark, policy):
    edges = [(f"c{k}", f"c{k - 1}") for k in range(1, 70)] + [("l1", "l2"), ("l2", "l3"), ("l3", "l1"), ("s", "s"), ("o", "outside"), ("t", None), ("u", "")]
    pages = sorted({a for a, _ in edges} | {"c0"})
    rules = [("c0", ["top"], []), ("c60", [], ["ann"]), ("c30", [], []), ("outside", ["far"], []), ("l3", ["loop"], ["bob"])]
    frame = spark.createDataFrame([(p,) for p in pages], "page_id string")
    tree = spark.createDataFrame(edges, "page_id string, parent_id string")
    some = spark.createDataFrame(rules, "page_id string, allowed_groups array<string>, allowed_users array<string>")
    names = ["page_id", "acl_depth", "allowed_groups", "allowed_users"]
    got = {r.page_id: tuple(r) for r in access.resolve_acl(frame, tree, some, policy).select(*names).collect()}
    chain = access.ancestor_chain(tree)
    want = {r.page_id: tuple(r) for r in access.effective_acl(frame, some, chain, policy).select(*names).collect()}
    assert got == want and got["c50"][1:] == (50, ["top"], []) and got["c51"][1] is None and got["c65"][1:] == (5, [], ["ann"])
    assert got["o"][2] == ["far"] and got["l1"][1:] == (2, ["loop"], ["bob"])
    with pytest.raises(ValueError):
        access.resolve_acl(frame, tree, some, "other")


def test_shares_of_code_points():
    for text in (None, "", "  \n\t　", "aab", "a b a", "日本日", "\U0001f600\U0001f600x", "x" * 100_000 + "y"):
        dense = "".join((text or "").split())
        assert abs(top_share(text) - (max((dense.count(c) for c in set(dense)), default=0) / len(dense) if dense else 0)) < 1e-12
