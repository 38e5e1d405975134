"""Operator 11: Merkle manifest of a dataset, with proofs by pointer jumping."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import is_small, lookup, stash
from quillspark.llm.quotes import numbered

#: Levels of a tree that one task builds from a block of its nodes (2 ** LEVELS of them).
LEVELS = 10
#: Bytes of a step of a proof: on which side the sibling stands (or that there is none), and its digest.
STEP, NONE, LEFT, RIGHT = 33, b"-", b"l", b"r"
#: Pointers that are broadcast; each has a few hundred bytes.
POINTERS = 50_000


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 in lower-case hex of the values: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts)), 256)


def _step(proof: Column, k: Column) -> tuple[Column, Column]:
    """(side, sibling in hex) of step ``k`` of a proof."""
    at = k.cast("int") * STEP + 1
    return F.substring(proof, at, F.lit(1)).cast("string"), F.lower(F.hex(F.substring(proof, at + 1, F.lit(STEP - 1))))


def _steps(proof: Column) -> Column:
    count = (F.octet_length(proof) / STEP).cast("int")
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of the siblings of a proof, from the leaf's to those below the root."""

    def sibling(k: Column) -> Column:
        side, digest = _step(proof, k)
        return F.when(side == NONE.decode(), F.lit("")).otherwise(digest)

    return F.sha2(F.array_join(F.transform(_steps(proof), sibling), ""), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def up(node: Column, k: Column) -> Column:
        side, digest = _step(proof, k)
        joined = F.when(side == LEFT.decode(), F.concat(digest, node)).when(side == RIGHT.decode(), F.concat(node, digest)).otherwise(node)
        return F.sha2(joined, 256)

    return F.aggregate(_steps(proof), leaf, up)


def _parents(digests: list[str]) -> list[str]:
    return [hashlib.sha256("".join(digests[k : k + 2]).encode()).hexdigest() for k in range(0, len(digests), 2)]


def _siblings(digests: list[str]) -> list[bytes]:
    out = []
    for k in range(len(digests)):
        if k ^ 1 >= len(digests):
            out.append(NONE + bytes(STEP - 1))
        else:
            out.append((LEFT if k & 1 else RIGHT) + bytes.fromhex(digests[k ^ 1]))
    return out


def _grow(base: int):
    """All nodes of the levels from ``base`` that a block of nodes of that level gives; the highest has no segment."""

    def each(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        depth, first, digests = int(rows.depth.iat[0]), int(rows.idx.iat[0]), rows.digest.tolist()
        out = {"level": [], "idx": [], "digest": [], "segment": []}
        for level in range(base, min(base + LEVELS, depth) + 1):
            top = level == min(base + LEVELS, depth)
            out["level"] += [level] * len(digests)
            out["idx"] += range(first, first + len(digests))
            out["digest"] += digests
            out["segment"] += [None] * len(digests) if top else _siblings(digests)
            digests, first = _parents(digests), first >> 1
        return pd.DataFrame({"tree": rows.tree.iat[0], "depth": depth, **out})

    return each


def _nodes(leaves: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(nodes below the roots with the segment to their parent, roots, depth of the deepest tree) of leaves (tree, idx, digest)."""
    sizes = leaves.groupBy("tree").agg(F.count("*").alias("n"))
    depths = stash(sizes.select("tree", F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0).cast("long").alias("depth")), "depths")
    deepest = depths.agg(F.max("depth")).first()[0] or 0
    todo, nodes, roots = lookup(leaves, depths, ["tree"]), None, None
    kinds = "tree string, depth long, level long, idx long, digest string, segment binary"
    for base in range(0, deepest + 1, LEVELS):
        block = F.shiftright("idx", LEVELS).alias("block")
        made = stash(todo.select("tree", "depth", "idx", "digest").groupBy("tree", block).applyInPandas(_grow(base), kinds), "nodes")
        below, ends = made.where("segment is not null"), made.where("segment is null")
        nodes = below if nodes is None else nodes.unionByName(below)
        top = ends.where("level = depth").select("tree", "digest")
        roots = top if roots is None else roots.unionByName(top)
        todo = ends.where("level < depth")
    return nodes, roots, deepest


def _proofs(nodes: DataFrame, leaves: DataFrame, deepest: int) -> DataFrame:
    """``leaves`` with ``proof``: the segments from each leaf to the root of its tree.

    Every node points at its parent and holds the segment up to it. In each round a node's pointer is followed by the
    pointer of the node that it leads to, which doubles the distance, and the two segments become one; nodes at levels
    that no later pointer can lead to drop out, so that a round has a quarter of the nodes of the round before.
    """
    edge = nodes.select("tree", "level", "idx", F.col("segment").alias("proof"))
    first = edge.where("level = 0").select("tree", "idx", "proof")
    leaves = leaves.join(first, ["tree", "idx"], "left").withColumn("proof", F.coalesce("proof", F.lit(b"")))
    edge, step = edge.where("level > 0"), 1
    while step < deepest:
        ends = edge.where(F.col("level") % (2 * step) == step)
        hop = ends.select("tree", (F.col("level") - step).alias("level"), F.col("idx").alias("up"), F.col("proof").alias("more"))
        hop = F.broadcast(hop) if is_small(hop, POINTERS) else hop
        up, longer = F.shiftright("idx", step).alias("up"), F.concat("proof", F.coalesce("more", F.lit(b""))).alias("proof")
        leaves = leaves.withColumn("up", up).join(hop.where("level = 0").drop("level"), ["tree", "up"], "left").withColumn("proof", longer).drop("up", "more")
        edge = edge.where(F.col("level") % (2 * step) == 0).withColumn("up", up)
        edge = stash(edge.join(hop, ["tree", "level", "up"], "left").select("tree", "level", "idx", longer), "pointers")
        step *= 2
    return leaves


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    *,
    id_col: str = "doc_id",
    group_col: str = "lang",
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """Digests of all rows as leaves of a tree, and for each the proof that it belongs to the root.

    Returns one row per input row: the id column, ``leaf``, ``subroot`` (of the
    row's group), ``root`` (of all groups), ``proof`` (binary; see ``fold`` and
    ``proof_digest``) and the columns of ``keep``, which are computed with the
    leaf in the one pass over the whole rows.

    Leaves of a group ascend by id (nulls first, equal ids by their digest);
    every two consecutive nodes become one, a last single one alone, while
    there is more than one. The groups' roots, null first and then by the bytes
    of the group's name, become the root in the same way. A lone leaf is its
    own subroot, a lone subroot the root; its proof has no step.

    A block of 1,024 nodes grows ten levels in one task, whatever group it
    belongs to, so that a group of any size is built in parallel. Proofs come
    from pointer jumping (``_proofs``): the number of joins is the logarithm of
    the depth. Only digests are shuffled, texts never.

    Defined cases: columns may be null; ids may repeat, and equal rows are
    leaves of their own with the same digest. Other columns of the input count
    for nothing, whatever their names. An empty table gives an empty result.
    """
    keep = keep or {}
    ident, *kept = (f"kept{k}" for k in range(len(keep) + 1))
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = docs.select(
        F.col(id_col).alias(ident), tree.alias("tree"), leaf_digest(*(F.col(c) for c in columns)).alias("digest"),
        *(c.alias(name) for name, c in zip(kept, keep.values(), strict=True)),
    )
    leaves = stash(numbered(leaves, ["tree"], [ident, "digest"], "idx"), "leaves")
    nodes, subroots, deepest = _nodes(leaves.select("tree", "idx", "digest"))
    leaves = _proofs(nodes, leaves, deepest)

    heads = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    heads = stash(numbered(heads, ["tree"], ["name"], "idx"), "heads")
    nodes, root, deepest = _nodes(heads.select("tree", "idx", "digest"))
    heads = _proofs(nodes, heads, deepest).select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.col("proof").alias("more"))
    top = root.first()  # one digest, none of an empty table
    out = lookup(leaves, stash(heads, "heads"), ["tree"])
    return out.select(
        F.col(ident).alias(id_col), F.col("digest").alias("leaf"), "subroot", F.lit(top.digest if top else None).cast("string").alias("root"),
        F.concat("proof", "more").alias("proof"),
        *(F.col(c).alias(name) for c, name in zip(kept, keep, strict=True)),
    )
