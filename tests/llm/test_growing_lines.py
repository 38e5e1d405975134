"""Operator 4 with edits that grow with a line's length, against brute force."""

import random

from quillspark.llm.line_dedup import allowed, duplicate_lines, within_edits
from quillspark.llm.queries import queries


def test_replaced_words_and_typing_errors(spark):
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 9))) for _ in range(300)]
    lines = []
    for n in (6, 12, 20, 30, 45, 60) * 6:
        line = draw.choices(words, k=n)
        lines.append(" ".join(line))
        for change in range(3):
            other = list(line)
            place = draw.randrange(n)
            other[place : place + 1] = [[draw.choice(words)], [line[place]] * 2, []][change]
            lines.append(" ".join(other))
    for line in lines[::4]:  # letters changed all over the line, up to what its length allows and one more
        for more in (0, 1):
            other, tau = list(line), int(allowed(len(line), 1, True)) + more
            for place in draw.sample(range(len(line)), tau):
                other[place] = "z"
            lines.append("".join(other))
    lines = sorted(set(lines))
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    far = 0
    for i, a in enumerate(lines):
        for b in lines[:i]:
            tau = int(allowed(min(len(a), len(b)), 1, True))
            if within_edits(a, b, tau):
                root[find(a)] = find(b)
                far += not within_edits(a, b, 1)
    assert far > 60
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    first = {}
    want = {k for k, x in enumerate(lines) if first.setdefault(find(x), k) != k}
    got = {r.doc_id for r in duplicate_lines(docs, growing=True).where("n_dropped > 0").collect()}
    assert got == want
    assert len({r.doc_id for r in duplicate_lines(docs).where("n_dropped > 0").collect()}) < len(want)


def test_query_is_registered_and_drops_more(spark, folder):
    run = queries()
    counts = [run[f"op4_{x}_line_dedup"](spark, folder).agg({"n_dropped": "sum"}).first()[0] for x in ("growing", "segment")]
    assert counts[0] > counts[1]


def test_empty(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "short")], "doc_id long, text string")
    assert {r.n_dropped for r in duplicate_lines(docs, growing=True).collect()} == {0}
    assert duplicate_lines(docs.limit(0), growing=True).count() == 0
