import random
from itertools import combinations

from quillspark.llm.near_dup import least_matches, near_duplicates

SCHEMA = "doc_id long, text string, id string, component_id string, key int, left string"


def shingles(text, width):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width):
    sets = {}
    for doc, text in rows:
        sets.setdefault(doc, []).append(shingles(text, width))
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sets, 2):
        for x in sets[a]:
            for y in sets[b]:
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    i, j = sorted((find(a), find(b)))
                    root[j] = i
    return {doc: find(doc) for doc in sets}


def run(spark, rows, **options):
    frame = spark.createDataFrame([(d, t, "x", "y", 1, "z") for d, t in rows], SCHEMA)
    return near_duplicates(frame, **options)


def near_copies():
    draw = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    rows, number = [], 0
    for _ in range(12):
        base = draw.choices(words, k=draw.randint(30, 90))
        for _ in range(6):
            text = list(base)
            for _ in range(draw.randint(0, 4)):
                text[draw.randrange(len(text))] = draw.choice(words)
            rows.append((number, " ".join(text)))
            number += 1
    draw.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    rows = near_copies()
    for width in (4, 5):
        got = {r.doc_id: r.component_id for r in run(spark, rows, width=width, block=3).collect()}
        assert got == brute(rows, width)


def test_defined_cases(spark):
    long = "word " * 30_000
    rows = [
        (5, "Same TEXT here now again"), (3, "same text\there\nnow again"), (3, "same text here now again"), (9, None), (8, ""), (7, " \n "),
        (20, "two words"), (21, "Two Words"), (22, "two"), (30, long), (31, long), (40, "Ä b c d e f"), (41, "ä b c d e f"), (None, "two words"),
    ]
    out = run(spark, rows, width=4)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = [tuple(r) for r in out.collect()]
    assert len(found) == len(rows)
    by_id = {r[0]: r for r in found}
    assert by_id[5][2] == 3 and not by_id[5][3] and by_id[3][3]
    assert [by_id[k][1:] for k in (7, 8, 9)] == [(0, 7, True), (0, 8, True), (0, 9, True)]
    assert by_id[21][1:] == (1, 20, False) and by_id[22][2] == 22
    assert by_id[31][1:] == (1, 30, False)
    assert by_id[41][2] == 41  # only A-Z are lower-cased
    assert by_id[None][2] is None and by_id[None][3]


def test_empty_table(spark):
    assert run(spark, []).collect() == []


def test_bounds_rise_and_never_rule_out_equal_signatures():
    bounds = least_matches(80, 1e-5, 1024)
    assert bounds[-1][0] == 1024 and all(m <= n for n, m in bounds)
    assert all(a[1] < b[1] for a, b in zip(bounds, bounds[1:], strict=False))
    assert 0.70 < bounds[-1][1] / 1024 < 0.80
