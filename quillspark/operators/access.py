"""Page hierarchy and effective access lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.sources.store import stage

POLICIES = ("mark_missing", "allow_authenticated")


def ancestor_chain(edges: DataFrame, max_depth: int = 50) -> DataFrame:
    """(page_id, depth, ancestor_id) from the nearest parent to the root.

    Each round extends the frontier by one parent, as an equi-join on the edge
    table; rounds stop when no path is left. A parent that is no page of the
    table ends the walk; an ancestor met before ends it too. Rounds are written
    to the shared folder now and then, so that plans stay short.
    """
    parents = edges.where("parent_id is not null and parent_id <> ''").select(F.col("page_id").alias("_child"), F.col("parent_id").alias("_next"))
    front = parents.select(
        F.col("_child").alias("page_id"), F.lit(1).alias("depth"), F.col("_next").alias("ancestor_id"), F.array("_child", "_next").alias("seen")
    ).where("page_id <> ancestor_id")
    found, depth = [], 1
    while True:
        front = stage(front, "ancestors")
        if front.isEmpty():
            break
        found.append(front.select("page_id", "depth", "ancestor_id"))
        if depth == max_depth:
            break
        front = front.join(parents, F.col("ancestor_id") == F.col("_child")).where(~F.array_contains("seen", F.col("_next")))
        depth += 1
        front = front.select("page_id", F.lit(depth).alias("depth"), F.col("_next").alias("ancestor_id"), F.concat("seen", F.array("_next")).alias("seen"))
    if not found:
        return front.select("page_id", "depth", "ancestor_id")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def effective_acl(pages: DataFrame, restrictions: DataFrame, chain: DataFrame, policy: str = "mark_missing", sentinel: str = "*") -> DataFrame:
    """Each page's own restriction, else that of its nearest restricted ancestor, else what the policy says.

    ``restrictions`` has page_id, allowed_groups and allowed_users; rows with
    two empty lists restrict nothing.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    if not sentinel.strip():
        raise ValueError("the group of everybody needs a name")
    some = restrictions.where((F.size("allowed_groups") > 0) | (F.size("allowed_users") > 0))
    some = some.select(F.col("page_id").alias("_from"), F.struct("allowed_groups", "allowed_users").alias("_acl"))
    steps = chain.unionByName(pages.select("page_id", F.lit(0).alias("depth"), F.col("page_id").alias("ancestor_id")))
    near = steps.join(some, F.col("ancestor_id") == F.col("_from")).groupBy("page_id").agg(F.min_by("_acl", "depth").alias("acl"), F.min("depth").alias("acl_depth"))
    none = F.array().cast("array<string>")
    groups = none if policy == "mark_missing" else F.array(F.lit(sentinel))
    joined = pages.drop("allowed_groups", "allowed_users").join(near, "page_id", "left")
    return joined.select(
        *[c for c in joined.columns if c != "acl"], F.coalesce("acl.allowed_groups", groups).alias("allowed_groups"),
        F.coalesce("acl.allowed_users", none).alias("allowed_users"),
    )


def resolve_acl(
    pages: DataFrame, edges: DataFrame, restrictions: DataFrame, policy: str = "mark_missing", sentinel: str = "*", max_depth: int = 50
) -> DataFrame:
    """``effective_acl`` without chains: (page_id, acl_depth, allowed_groups, allowed_users) in a few rounds of doubling.

    Each page without a restriction points at its parent. A round looks up what
    it points at: if that is resolved so is the page, else the page takes over
    its pointer, twice as far up. Only unresolved pages take part, and rounds
    stop when none is left or ``max_depth`` is reached; circles end there.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    if not sentinel.strip():
        raise ValueError("the group of everybody needs a name")
    some = restrictions.where((F.size("allowed_groups") > 0) | (F.size("allowed_users") > 0))
    some = some.select("page_id", F.struct("allowed_groups", "allowed_users").alias("acl")).dropDuplicates(["page_id"])
    ups = edges.where("parent_id is not null and parent_id <> '' and parent_id <> page_id").select("page_id", F.col("parent_id").alias("up"))
    every = pages.select("page_id").unionByName(ups.select(F.col("up").alias("page_id"))).distinct()
    state = every.join(some, "page_id", "left").join(ups.dropDuplicates(["page_id"]), "page_id", "left")
    state = stage(state.select("page_id", "acl", F.lit(0).alias("depth"), F.when(F.col("acl").isNull(), F.col("up")).alias("up"), F.lit(1).alias("step")), "acl")
    closed, open_ = state.where("up is null"), state.where("up is not null")
    reach = 1
    while reach <= max_depth and not open_.isEmpty():
        known = closed.unionByName(open_).select(
            F.col("page_id").alias("_id"), F.col("acl").alias("_acl"), F.col("depth").alias("_depth"), F.col("up").alias("_up"), F.col("step").alias("_step")
        )
        moved = open_.join(known, F.col("up") == F.col("_id")).select(
            "page_id", F.col("_acl").alias("acl"), (F.col("step") + F.col("_depth")).alias("depth"), F.col("_up").alias("up"), (F.col("step") + F.col("_step")).alias("step")
        )
        moved = stage(moved, "acl")
        closed, open_, reach = closed.unionByName(moved.where("up is null")), moved.where("up is not null"), 2 * reach
    near = closed.where(F.col("acl").isNotNull() & (F.col("depth") <= max_depth)).select("page_id", "acl", F.col("depth").alias("acl_depth"))
    none = F.array().cast("array<string>")
    groups = none if policy == "mark_missing" else F.array(F.lit(sentinel))
    return pages.select("page_id").join(near, "page_id", "left").select(
        "page_id", "acl_depth", F.coalesce("acl.allowed_groups", groups).alias("allowed_groups"), F.coalesce("acl.allowed_users", none).alias("allowed_users")
    )
