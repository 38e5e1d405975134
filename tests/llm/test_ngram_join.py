import random
import re
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm.ngram_join import Bands, bitmap, folded, may_overlap, ngram_components
from quillspark.llm.shingles import mix

SCHEMA = "doc_id long, text string, id string, component_id string, key int, tiles string"


def shingles(text, width):
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width, percent):
    sets, root = {}, {}
    for doc, text in rows:
        sets.setdefault(doc, []).append(shingles(text, width))
        root[doc] = doc

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            i, j = sorted((find(a), find(b)))
            root[j] = i
    return {doc: find(doc) for doc in sets}


def run(spark, rows, **options):
    frame = spark.createDataFrame([(d, t, "x", "y", 1, "z") for d, t in rows], SCHEMA)
    return ngram_components(frame, **options)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.sampled_from([60, 80, 90, 95]))
def test_similar_sets_share_a_tile_and_pass_the_bound(size, seed, percent):
    draw = random.Random(seed)
    pool = [int(x) for x in mix(np.arange(seed * 2000 + 1, seed * 2000 + 1201, dtype=np.uint64))]
    left = set(pool[:size])
    right = set(draw.sample(sorted(left), size - draw.randint(0, size // 8))) | set(pool[size : size + draw.randint(0, size // 8)])
    if not right or 100 * len(left & right) < percent * len(left | right):
        return
    bands, sets = Bands(percent), [np.array(sorted(x), dtype=np.uint64) for x in (left, right)]
    tiles = [{k for b in bands.of(len(x)) for k in bands.tiles(x, b).tolist()} for x in sets]
    assert left == right or tiles[0] & tiles[1]
    maps = folded([bitmap(x).tobytes() for x in sets])
    assert may_overlap(maps[:1], maps[1:], np.array([len(left) + len(right)]), percent).all()


def test_tiles_keep_unlike_sets_apart():
    bands, seen, pairs = Bands(90), {}, 0
    for k in range(2000):
        values = np.sort(mix(np.arange(k * 1000 + 1, k * 1000 + 101, dtype=np.uint64)))
        for band in bands.of(100):
            for tile in bands.tiles(values, band).tolist():
                pairs += seen.get(tile, 0)
                seen[tile] = seen.get(tile, 0) + 1
    assert pairs < 200  # of two million


def near_copies(seed, groups=14, copies=6):
    draw = random.Random(seed)
    words, rows, number = [f"w{k}" for k in range(500)], [], 0
    for _ in range(groups):
        text = draw.choices(words, k=draw.choice([5, 12, 20, 40, 90, 200]))
        for _ in range(copies):  # a chain: each differs a little from the one before
            rows.append((number, " ".join(text)))
            text = list(text)
            for _ in range(draw.randint(0, 2)):
                text[draw.randrange(len(text))] = draw.choice(words)
            if draw.random() < 0.3:
                text += draw.choices(words, k=draw.randint(1, 5))
            number += 1
    draw.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    for seed, percent, block in ((1, 90, 3), (2, 80, 512), (3, 50, 2)):
        rows = near_copies(seed)
        got = {r.doc_id: r.component_id for r in run(spark, rows, percent=percent, block=block).collect()}
        assert got == brute(rows, 3, percent)
        assert len(set(got.values())) < len(got) - 10


def test_defined_cases(spark):
    long = " ".join(f"v{k}" for k in range(30_000))
    rows = [
        (5, "Same TEXT here now"), (3, "same text\there\nnow"), (3, "same text\there\nnow"), (9, None), (8, ""), (7, " \n "), (20, "two words"), (21, "Two Words"),
        (22, "two"), (30, long), (31, long + " more"), (40, "Ä b c d"), (41, "ä b c d"), (None, "two words"), (50, "a b c d"), (50, "e f g h"), (51, "a b c d"), (52, "e f g h"),
    ]
    out = run(spark, rows)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    found = [tuple(r) for r in out.collect()]
    assert len(found) == len(rows)
    by_id = {r[0]: r[1:] for r in found}
    assert by_id[5] == by_id[3] == (2, 3) and by_id[21] == (1, 20) and by_id[22] == (1, 22)
    assert [by_id[k] for k in (7, 8, 9)] == [(0, 7), (0, 8), (0, 9)]
    assert by_id[31] == (29_999, 30) and by_id[41][1] == 41
    assert by_id[51][1] == by_id[52][1] == by_id[50][1] == 50  # both texts of an id count
    assert by_id[None] == (1, None)


def test_empty_table(spark):
    assert run(spark, []).collect() == []
