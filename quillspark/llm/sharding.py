"""Operator 7: sharding by a hierarchical weighted hash tree, on DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import is_small, stash, unused

#: Hex digits of a hash that make a draw: 52 bits, exact in a double.
_DIGITS = 13


@dataclass(frozen=True)
class Leaf:
    """A shard, its place in the tree and its weight."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(shards: int, *, racks: int = 2, shards_per_rack: int = 4) -> list[Leaf]:
    """A regular tree: regions of ``racks`` racks of ``shards_per_rack`` equal shards."""
    if shards < 1:
        raise ValueError("a tree needs a shard")
    per_region = racks * shards_per_rack
    return [Leaf(s // per_region, s % per_region // shards_per_rack, s) for s in range(shards)]


def grown(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a region of its own.

    No weight of an old region, rack or shard changes, so a row either stays
    where it is or moves into the new shard.
    """
    return [*tree, Leaf(max(x.region for x in tree) + 1, 0, max(x.shard for x in tree) + 1, weight)]


def _draw(key: Column, place: str) -> Column:
    """A number strictly between 0 and 1 that the key and the place decide."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"|{place}")).cast("binary")), 1, _DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**_DIGITS))


def _pick(key: Column, weights: dict[int, float], prefix: str) -> Column:
    """The child with the smallest weighted exponential draw; ties go to the smaller number."""
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    times = [
        F.struct((-F.log(_draw(key, f"{prefix}{child}")) / F.lit(float(weight))).alias("time"), F.lit(child).alias("child"))
        for child, weight in sorted(weights.items())
    ]
    return F.array_min(F.array(*times))["child"]


def _total(leaves: list[Leaf], level: str) -> dict[int, float]:
    sums: dict[int, float] = {}
    for x in leaves:
        sums[getattr(x, level)] = sums.get(getattr(x, level), 0.0) + x.weight
    return sums


def _switch(cases: list[tuple[Column, Column]]) -> Column:
    """The value beside the first condition that holds; the last one needs none."""
    out = cases[-1][1]
    for condition, value in reversed(cases[:-1]):
        out = F.when(condition, value).otherwise(out)
    return out


def assign_shards(docs: DataFrame, tree: list[Leaf], *, key: str = "doc_id", shard: str = "shard") -> DataFrame:
    """Add the shard of each row: a weighted draw among regions, then racks, then shards.

    A child's chance is its share of the weight beside it. A child's draw
    depends on the key and the child's place alone, so a changed weight moves
    rows only into or out of the subtree whose weight changed. Each level
    draws among one node's children only, and the whole is a projection: no
    row is moved or dropped.

    An existing column named ``shard`` is replaced; null keys count as the
    empty key and repeated rows go to one shard.
    """
    if not tree or any(x.weight <= 0 for x in tree) or len({x.shard for x in tree}) < len(tree):
        raise ValueError("shards must be distinct and have positive weights")
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    region_name, rack_name = unused(docs, "_region", "_rack")
    region, rack = F.col(region_name), F.col(rack_name)
    regions = _total(tree, "region")
    racks = {r: _total([x for x in tree if x.region == r], "rack") for r in regions}
    leaves = {(r, k): _total([x for x in tree if (x.region, x.rack) == (r, k)], "shard") for r in racks for k in racks[r]}
    of_rack = [(region == r, _pick(text, racks[r], f"k{r}.")) for r in racks]
    of_shard = [((region == r) & (rack == k), _pick(text, leaves[r, k], f"s{r}.{k}.")) for r, k in leaves]
    return (
        docs.withColumn(region_name, _pick(text, regions, "r"))
        .withColumn(rack_name, _switch(of_rack))
        .withColumn(shard, _switch(of_shard).cast("int"))
        .drop(region_name, rack_name)
    )


def number_rows(frame: DataFrame, group: str, key: str, ties: list[str], name: str, digits: int = 2) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in order of the MD5 of ``key``.

    A group's rows are dealt into ``16 ** digits`` buckets by the first digits
    of that hash. A bucket's first number is the count of rows in the buckets
    before it, so that only a bucket's rows are ever sorted in one task; more
    digits make smaller buckets. Rows with equal keys follow ``key, *ties``.
    """
    mixed = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    hashed = frame.withColumn("_hash", mixed).withColumn("_bucket", F.substring("_hash", 1, digits))
    counts = hashed.groupBy(group, "_bucket").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    if is_small(starts):  # a row for each group and bucket
        starts = F.broadcast(starts)
    inside = Window.partitionBy(group, "_bucket").orderBy("_hash", key, *ties)
    numbered = hashed.withColumn("_at", F.row_number().over(inside) - 1).join(starts, [group, "_bucket"])
    return numbered.withColumn(name, F.col("_start") + F.col("_at")).drop("_hash", "_bucket", "_at", "_start")


def shard_documents(
    docs: DataFrame, *, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", tree: list[Leaf] | None = None
) -> DataFrame:
    """Place all documents in shards by law ``key`` and number each shard's rows.

    Returns one row per input row: the id column, ``size`` (UTF-8 bytes of the
    text, null counting none, plus 16), ``text_crc32`` (of the UTF-8 bytes),
    ``law``, ``shard`` (0 to ``shards`` - 1), ``slot`` (0 upwards in a shard
    without gaps, in order of the id's MD5, then id, size and checksum) and
    ``grown_shard`` (the shard with one shard more).

    Id and shard count alone decide the shard, and with one more shard rows
    move only into that one. Defined cases: a null text is an empty one; a
    null id is placed as the empty key; repeated rows share a shard and get
    slots of their own; other columns are ignored; an empty table gives an
    empty result.
    """
    tree = tree or layout(shards)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    placed = docs.select(
        F.col(id_col), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = assign_shards(assign_shards(placed, tree, key=id_col), grown(tree), key=id_col, shard="grown_shard")
    placed = stash(placed, "placed")
    return number_rows(placed, "shard", id_col, ["size", "text_crc32"], "slot").select(
        id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
