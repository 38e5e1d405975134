import random
import re
from collections import Counter
from contextlib import contextmanager

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import collocations as module
from quillspark.llm.collocations import Filter, _stitched, _walk, collocations, phrase_counts

SCHEMA = "doc_id long, text string, lang string, n long, phrase string, path string, part int"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def phrases(text, longest):
    for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
        words = re.findall("[^ \t]+", piece)
        for size in range(1, longest + 1):
            for k in range(len(words) - size + 1):
                yield tuple(words[k : k + size])


def brute(rows, longest=3, least=10, covered=50, top=2000):
    count, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for p in phrases(text, longest):
            count.setdefault(lang, Counter())[p] += 1
            n[lang] += len(p) == 1
    out = []
    for lang, f in count.items():
        found, longer = [], Counter()
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in cand.items():
            for size in range(2, len(p)):
                for k in range(len(p) - size + 1):
                    longer[p[k : k + size]] = max(longer[p[k : k + size]], a)
        for p, a in cand.items():
            if p in longer and 100 * longer[p] >= covered * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@contextmanager
def many_ranges(spark, count):
    names = {"spark.sql.shuffle.partitions": str(count), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in collocations(frame, **options).collect())


def corpus(seed, docs=60):
    draw, rows = random.Random(seed), []
    words = ["the", "of", "And", "x\x01", "é", "ab", "a", "b", "new", "york", "city", "-", "(", "日本", " "]
    for k in range(docs):
        parts = []
        for _ in range(draw.randint(0, 40)):
            parts.append(draw.choice([" ", "  ", "\t", ". ", ",", "\n", " ? ", " "]))
            parts.append("New York City" if draw.random() < 0.1 else draw.choices(words, range(len(words), 0, -1))[0])
        rows.append((k, "".join(parts), draw.choice(["en", "en", "en", "fr", None, "und", "e", ""])))
    return rows + [rows[0], rows[0], (98, None, "en"), (99, "", "de"), (100, " .,; \n", "it"), (None, "the of and " * 3_000, "fr")]


def test_matches_brute_force_over_many_ranges(spark):
    rows = corpus(1)
    with many_ranges(spark, 23):
        assert run(spark, rows) == brute(rows)
        options = {"longest": 4, "least": 3, "covered": 70, "top": 11}
        assert run(spark, rows, **options) == brute(rows, **options)


def test_no_limit_and_empty_tables(spark):
    rows = corpus(2, 30)
    assert run(spark, rows, top=None, least=2) == brute(rows, least=2, top=10**9)
    assert run(spark, []) == run(spark, [(1, None, None), (2, " ", "en")]) == []


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("abc .\n"), max_size=80), st.integers(2, 4), st.integers(0, 10**6))
def test_a_filter_loses_no_phrase_whose_parts_it_holds(text, length, seed):
    data, draw = lower(text).encode(), random.Random(seed)
    shorter = sorted({p for p in phrases(text, length) if len(p) == length - 1})
    held = set(draw.sample(shorter, draw.randint(0, len(shorter))))
    known = Filter()
    for p in held:
        code = np.zeros(1, dtype=np.uint64)
        for word in p:
            code = Filter.joined(code, Filter.word_hashes([word.encode()]))
        for at in Filter.places(code):
            known.bits[at >> 3] |= np.uint8(1) << (at & 7).astype(np.uint8)
    got = Counter()
    for names, counts in phrase_counts(data, length, known=known)[1]:
        got.update(dict(zip(names.to_pylist(), counts.tolist(), strict=True)))
    want = Counter(" ".join(p) for p in phrases(text, length) if len(p) == length and p[1:] in held and p[:-1] in held)
    assert got == want  # of so few phrases none is let through by chance


def test_long_texts_and_products_over_64_bits(spark):
    """One text is longer than what a task counts at once; a million times the square of a count passes 64 bits."""
    times = 3_300_000
    assert len("x y ") * times > module.CHUNK and 1_000_000 * times**2 > 2**63
    got = run(spark, [(1, "x y " * times, "en")], longest=2)
    side, n = times, 2 * times
    other = times - 1  # "y x"
    assert got == [
        ("en", 1, "x y", times, side, side, n, 1_000_000), ("en", 2, "y x", other, side, side, n, 1_000_000 * other**2 // side**2),
    ]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=4), max_size=40), st.integers(0, 2**30), st.integers(1, 6))
def test_ranges_cut_anywhere_give_the_same_counts(paths, seed, ranges):
    draw = random.Random(seed)
    paths = sorted({tuple(p[:k]) for p in paths for k in range(1, len(p) + 1)})
    n = {p: draw.randint(1, 50) for p in paths}
    cuts = sorted(draw.randint(0, len(paths)) for _ in range(ranges - 1))
    got, ends, names = {}, [], ["lang", "phrase", "depth", "n", "given", "wider", "part"]
    for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(paths)], strict=True)):
        some = paths[a:b]
        size = draw.randint(1, 5)
        batches = [
            pd.DataFrame([("en", " ".join(p), len(p) - 1, n[p], None, None, part) for p in some[k : k + size]], columns=names) for k in range(0, len(some), size)
        ]
        for frame in _walk(iter(batches)):
            for row in frame.itertuples():
                if row.phrase is None:
                    ends.append((part, row.before, row.heads))
                else:
                    got[tuple(row.phrase.split())] = (part, row.before, row.longer, row.open)
    found = {part: (known, more) for part, known, more in _stitched(ends)}
    for p in paths:
        part, before, longer, is_open = got[p]
        known, more = found[part]
        before = [x if x is not None and x == x else known[k] for k, x in enumerate(before)]
        longer = max(longer, more[len(p) - 1] if is_open and len(p) - 1 < len(more) else 0)
        assert before == [n[p[:k]] for k in range(1, len(p))]
        assert longer == max([n[q] for q in paths if len(q) == len(p) + 1 and q[: len(p)] == p], default=0)


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("ab .\n\té"), max_size=60), st.integers(1, 4), st.integers(1, 12))
def test_texts_counted_in_pieces(text, longest, size):
    """Texts are cut at gaps only; the words before a cut go on into the next piece."""
    data, total, head, start = lower(text).encode(), Counter(), [], 0
    words = 0
    while start < len(data):
        gap = module._GAP.search(data, start + size)
        end = gap.start() if gap else len(data)
        number, found, head = phrase_counts(data[start:end], longest, head)
        words += number
        for names, counts in found:
            total.update(dict(zip(names.to_pylist(), counts.tolist(), strict=True)))
        start = end
    want = Counter(" ".join(p) for p in phrases(text, longest))
    assert total == want and words == sum(c for p, c in want.items() if " " not in p)
