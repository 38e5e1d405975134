"""Operators 4 and 9."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.llm.decontamination import HammingIndex, benchmark_hits, decontaminate, fingerprint, window_marks
from quillspark.llm.line_dedup import Keys, drop_lines, duplicate_lines, lines_of, within_edits


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=14), st.text("abc", max_size=14), st.integers(0, 4))
def test_banded_distance(a, b, limit):
    assert within_edits(a, b, limit) == (distance(a, b) <= limit)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=6, max_size=24), st.data(), st.integers(1, 3))
def test_near_lines_share_a_key(a, data, limit):
    b = list(a)
    for _ in range(data.draw(st.integers(0, limit))):
        place = data.draw(st.integers(0, len(b)))
        kind = data.draw(st.sampled_from("+-*"))
        if kind == "+":
            b.insert(place, "c")
        elif place < len(b):
            b[place : place + 1] = ["c"] if kind == "*" else []
    b = "".join(b)
    keys = Keys(limit, least=4)
    if len(b) >= 4:
        low, high = sorted((a, b), key=len)
        index = {k for k, i in keys.of(low) if i}
        assert index & {k for k, i in keys.of(high) if not i}


def test_lines_against_brute_force(spark):
    draw = random.Random(2)
    pool = ["".join(draw.choices("abcdef ", k=draw.randint(10, 40))) for _ in range(25)]
    pool += [p[: len(p) // 2] + "x" + p[len(p) // 2 :] for p in pool[:12]]
    rows = [(k, "\n".join(draw.choices(pool + ["", "  "], k=8))) for k in range(30)]
    clean = lambda x: " ".join(x.split())
    places = sorted((d, n, clean(x)) for d, t in rows for n, x in enumerate(t.split("\n")) if clean(x))
    lines = sorted({p[2] for p in places})
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            if min(len(a), len(b)) >= 16 and distance(a, b) <= 1:
                root[find(a)] = find(b)
    first, gone = {}, {}
    for d, n, x in places:
        if first.setdefault(find(x), (d, n)) != (d, n):
            gone.setdefault(d, []).append(n)
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, _id int, _dropped int")
    found = duplicate_lines(docs)
    got = {r.doc_id: r.dropped for r in found.collect()}
    assert got == {d: gone.get(d, []) for d, _ in rows}
    texts = {r.doc_id: r.text for r in drop_lines(docs, found).collect()}
    assert texts[0] == "\n".join(x for n, x in enumerate(rows[0][1].split("\n")) if n not in got[0])


@settings(max_examples=500, deadline=None)
@given(st.text("ab \n\t\r\x1c\x85\xa0\u2003\u3000é日", max_size=12))
def test_lines_with_single_white_space(text):
    assert lines_of(text) == ([" ".join(x.split()) for x in text.split("\n")] if text else [])


def test_line_cases(spark):
    rows = [(1, None), (2, ""), (3, "same line of some length\n" * 3), (3, "same line of some length\n" * 3), (None, "same line of some length"), (4, "y" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_lines, r.dropped) for r in duplicate_lines(docs).collect()), key=str)
    assert (None, 1, []) in got and (1, 0, []) in got and (2, 0, []) in got and got.count((3, 4, [0, 1, 2])) == 2
    assert duplicate_lines(docs.limit(0)).count() == 0


def test_texts_of_one_id_are_told_apart(spark):
    common = "a line that several documents have"
    rows = [(1, f"{common}\nonly in the first of id one"), (1, f"unlike all others here\n{common}"), (None, f"{common}\nnull one"), (None, f"null two, quite long\n{common}"), (2, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.lit("x"))
    found = duplicate_lines(docs, hashed=True)
    texts = sorted(r.text for r in drop_lines(docs, found).collect())
    assert sum(common in t for t in texts) == 1 and all(any(x in t for t in texts) for x in ("only in the first", "unlike all", "null one", "null two", "alone"))
    plain = sorted(r.text for r in drop_lines(docs, found.drop("text_hash")).collect())
    assert all(any(x in t for t in plain) for x in ("only in the first", "unlike all", "null one", "null two"))


def windows_brute(docs, items, width=5, percent=80):
    from collections import Counter

    out = {}
    for d, t in docs:
        words = (t or "").lower().split()
        for i, x in items:
            item = (x or "").lower().split()
            if not item:
                continue
            w = min(width, len(item))
            bag = lambda seq, w=w: Counter(tuple(seq[k : k + w]) for k in range(len(seq) - w + 1))
            size = min(len(item), len(words))
            if size < w or not bag(words) & bag(item):
                continue
            best = max((sum((bag(words[s : s + size]) & bag(item)).values()), -s) for s in range(len(words) - size + 1))
            total = len(item) - w + 1 + size - w + 1 - best[0]
            if 100 * best[0] >= percent * total:
                out[d, i] = (-best[1], best[0], total)
    return out


def test_windows_against_brute_force(spark):
    draw = random.Random(7)
    words = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(draw.choices(words, k=draw.choice([2, 4, 5, 18, 30, 44])))) for k in range(25)]
    docs = []
    for k in range(60):
        text = draw.choices(words, k=draw.randint(0, 80))
        for _ in range(draw.randint(0, 2)):
            passage = draw.choice(items)[1].split()
            if draw.random() < 0.4:
                passage = passage[1:]
            text[draw.randint(0, len(text)) : 0] = passage
        docs.append((k, " ".join(text)))
    frame = spark.createDataFrame([(d, t, "b") for d, t in docs], "doc_id long, text string, _bad string")
    bench = spark.createDataFrame([(i, t) for i, t in items] + items[:1], "item_id long, text string")
    want = windows_brute(docs, items)
    for options in ({}, {"slice_items": 3}):
        found = benchmark_hits(frame, bench, **options).collect()
        assert {(r.doc_id, r.item_id): (r.start_word, r.common, r.total) for r in found} == want
        assert len(found) == len(want)
    kept = decontaminate(frame, bench)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_multi_index_finds_all_within_radius():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**64, 150, dtype=np.uint64)
    # Fingerprints at every distance from 0 to 40, with many repeated ones.
    flips = [np.bitwise_or.reduce(np.uint64(1) << draw.choice(64, k, replace=False).astype(np.uint64)) if k else np.uint64(0) for k in range(41)]
    marks = np.concatenate([base ^ flip for flip in flips] + [draw.integers(0, 2**64, 4000, dtype=np.uint64)])
    far = np.bitwise_count(marks[:, None] ^ base[None, :])
    for radius in (0, 2, 3, 19, 22):
        at, member = HammingIndex(base, radius).within(marks)
        want = np.argwhere(far <= radius)
        assert sorted(zip(at.tolist(), member.tolist(), strict=True)) == [tuple(x) for x in want.tolist()]


def test_multi_index_is_selective():
    draw = np.random.default_rng(4)
    items, windows = (draw.integers(0, 2**64, n, dtype=np.uint64) for n in (60, 100_000))
    index = HammingIndex(items, 19)
    probed = sum(len(at) for at, _, _ in index.probe(windows)) / (60 * 100_000)
    verified = len(index.within(windows)[0]) / (60 * 100_000)
    assert probed < 0.2 and verified < 0.01


def test_windows_of_similarity_at_the_limit_are_near():
    """Of bags whose weighted similarity is just 0.8, all but a few in a thousand lie within the radius."""
    draw = np.random.default_rng(5)
    missed = 0
    for _ in range(4000):
        item = draw.integers(0, 2**64, 45, dtype=np.uint64)
        window = np.concatenate([item[5:], draw.integers(0, 2**64, 5, dtype=np.uint64)])
        missed += int(np.bitwise_count(fingerprint(item[:41]) ^ fingerprint(window[:41]))) > 19
    assert missed <= 16


def test_window_marks_are_those_of_the_windows():
    shingles = np.random.default_rng(6).integers(0, 2**64, 5000, dtype=np.uint64)
    for lengths in ([1, 7, 55], [300]):
        for m, marks in zip(lengths, window_marks(shingles, lengths, 4100), strict=True):
            assert len(marks) == 4100 and all(marks[k] == fingerprint(shingles[k : k + m]) for k in (0, 1, 2047, 2048, 4099))
    assert [len(x) for x in window_marks(shingles[:10], [4, 30], 100)] == [7, 0]


def test_long_texts_and_items_across_pieces(spark):
    draw = random.Random(11)
    words = [f"v{k}" for k in range(4000)]
    items = [(k, " ".join(draw.choices(words, k=n))) for k, n in enumerate([12, 40, 41, 42, 43, 44, 45, 300])]
    long = draw.choices(words, k=70_000)
    for at, (_, text) in zip(range(9_000, 70_000, 7_500), items, strict=False):
        long[at : at + len(text.split())] = text.split()
    docs = [(1, " ".join(long)), (2, items[3][1]), (3, " ".join(items[3][1].split()[:36])), (4, " ".join(items[7][1].split()[20:]) + " end"), (5, " ".join(long[:500]))]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.common, r.total) for r in benchmark_hits(frame, bench).collect()}
    want = windows_brute(docs[1:], items) | {(1, k): (9_000 + 7_500 * k, n, n) for k, n in enumerate([8, 36, 37, 38, 39, 40, 41, 296])}
    assert got == want and (3, 3) in got and (4, 7) in got


def test_window_cases(spark):
    item = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, None), (2, ""), (None, item), (3, f"x {item.upper()} y"), (3, f"x {item.upper()} y"), (4, "z " * 100_000 + item)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, " "), (None, "z z z z z z")], "item_id long, text string")
    got = [(r.doc_id, r.start_word) for r in benchmark_hits(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([(None, 0), (3, 1), (3, 1), (4, 100_000)], key=str)
    assert benchmark_hits(docs.limit(0), bench).count() == 0 and benchmark_hits(docs, bench.limit(0)).count() == 0
    assert {r.doc_id for r in decontaminate(docs, bench).collect()} == {1, 2, None}
