"""Reports that are kept up: equal to a fresh computation, at a cost that goes with the change."""

import random

import pytest
from pyspark.sql import functions as F

from quillspark.operators import joins, upkeep
from quillspark.sources.keyed import KeyedTable
from quillspark.sources.store import shared_path

LISTING = "page_id string, version_number int, last_modified_at string"


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_listings_are_joined_where_they_differ(spark, monkeypatch):
    draw = random.Random(1)
    before = {f"p{k}": (1, "t") for k in range(600)}
    after = dict(before)
    for k in draw.sample(range(600), 9):
        after[f"p{k}"] = draw.choice([(2, "t"), (1, "u"), (1, None)])
    for k in (3, 77):
        after.pop(f"p{k}", None)
    after["new"] = (1, "t")
    was, now = (spark.createDataFrame([(i, *v) for i, v in x.items()], LISTING) for x in (before, after))
    met, diff = [], upkeep.diff_snapshots

    def counted(left, right):
        met.append(left.count() + right.count())
        return diff(left, right)

    monkeypatch.setattr(upkeep, "diff_snapshots", counted)
    want = rows(joins.diff_snapshots(was, now))
    assert rows(upkeep.diff_by_digest(was, now, buckets=200)) == want
    assert met[0] <= 12 * 2 * 10  # of 1,199 rows: twelve changes in buckets of three rows
    known = upkeep.listing_digests(was, 200)
    assert rows(upkeep.diff_by_digest(was, now, buckets=200, known=known)) == rows(upkeep.diff_by_digest(was, now, buckets=1)) == rows(upkeep.diff_by_digest(was, now)) == want
    assert rows(upkeep.diff_by_digest(was, was, buckets=50)) == [(i, "unchanged") for i in sorted(before, key=lambda x: repr((x, "")))] and met[-1] == 0
    none = was.where("false")
    assert {r[1] for r in rows(upkeep.diff_by_digest(none, now))} == {"new"} and {r[1] for r in rows(upkeep.diff_by_digest(was, none))} == {"deleted_candidate"}
    assert rows(upkeep.diff_by_digest(none, none)) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_frequencies_equal_a_recount(spark, monkeypatch, seed):
    draw, held = random.Random(seed), {}
    index = upkeep.Frequencies(spark, shared_path(spark, "frequencies"), buckets=8)
    schema = "id long, idx int, tf long"
    for batch in range(4):
        fresh = {draw.randrange(12): {draw.randrange(9): draw.randint(1, 3) for _ in range(draw.randint(1, 5))} for _ in range(5)}
        gone = [] if not held else draw.sample(sorted(held), min(3, len(held)))
        held = {k: v for k, v in held.items() if k not in gone} | fresh
        terms = spark.createDataFrame([(k, i, tf) for k, t in fresh.items() for i, tf in t.items()], schema)
        dead = spark.createDataFrame([(k,) for k in gone] + [(99,)], "id long")
        if batch == 2:  # breaks off once between the two tables
            replace = KeyedTable.replace
            monkeypatch.setattr(KeyedTable, "replace", lambda *a: (_ for _ in ()).throw(OSError("disk")))
            with pytest.raises(OSError):
                index.apply(batch, terms, dead)
            monkeypatch.setattr(KeyedTable, "replace", replace)
        index.apply(batch, terms, dead)
        if batch == 3:
            index.apply(batch, terms, dead)  # delivered again
        want = {}
        for t in held.values():
            for i in t:
                want[i] = want.get(i, 0) + 1
        assert dict(rows(index.read())) == want and index.total() == len(held)


def test_sketches_merge_over_days(spark):
    draw = random.Random(5)
    made = [(f"p{k}", "S", draw.choice(["faq", "adr"]), k % 4, draw.choice(["h", "untitled", "", None]), int(draw.lognormvariate(6, 1))) for k in range(20_000)]
    chunks = spark.createDataFrame(made, "page_id string, space_key string, doc_type string, day int, section_header string, token_count int")
    days = [upkeep.quality_sketch(chunks.where(f"day = {d}")) for d in range(4)]
    parts = days[0]
    for more in days[1:]:
        parts = parts.unionByName(more)
    assert parts.count() == 8
    got = {r.doc_type: r for r in upkeep.quality_from_sketches(parts).collect()}
    for kind in ("faq", "adr"):
        some = sorted(m[5] for m in made if m[2] == kind)
        r, n = got[kind], len(some)
        low, high = (sum(x < r.median_tokens for x in some) / n, sum(x <= r.median_tokens for x in some) / n)
        assert low - upkeep.rank_error() <= 0.5 <= high + upkeep.rank_error() and upkeep.rank_error() < 0.01
        assert r.chunks == n and abs(r.in_range - sum(200 <= x <= 800 for x in some) / n) < 1e-12
        assert abs(r.missing_metadata - sum(not m[4] for m in made if m[2] == kind) / n) < 1e-12
    one = upkeep.quality_from_sketches(upkeep.quality_sketch(chunks), "doc_type", "day")
    assert one.count() == 8 and one.agg(F.sum("chunks")).first()[0] == 20_000
