"""The sparse search over texts of one row each: the same results, without a row per word, a shuffle of words or a second reading of texts."""

import pytest

from quillspark.operators import search
from quillspark.operators.reports import term_frequencies, term_vectors
from test_guarded_search import brute, marked, may, people, texts_and_questions


@pytest.mark.parametrize("blocks", [8192, 5])
def test_texts_of_one_row_are_ranked_alike(spark, monkeypatch, blocks):
    monkeypatch.setattr(search, "QUERY_BLOCK", blocks)
    monkeypatch.setattr(search, "POINT_BLOCK", 60)
    held, questions = texts_and_questions(7)
    held |= {300: {}, 301: None}  # texts without words do not count as texts
    used = {i for t in questions.values() for i in t}  # of every second text, only these are left
    rows = [(k, bool(t), None if t is None else [x for x in sorted(t.items()) if k % 2 or x[0] in used]) for k, t in held.items()]
    terms = spark.createDataFrame(rows, "id long, said boolean, terms array<struct<idx: int, tf: bigint>>")
    asked = spark.createDataFrame([(k, i, tf) for k, t in questions.items() for i, tf in t.items()], "query_id long, idx int, tf int")
    held = {k: t for k, t in held.items() if t}
    points, queries = marked(spark, *(shown := people(9, 300, 12)))

    def run(**options):
        got = {}
        for r in search.sparse_search(terms, asked, k=6, **options).collect():
            got.setdefault(r.query_id, []).append((r.rank, r.id))
        return {q: [i for _, i in sorted(found)] for q, found in got.items()}

    assert run() == brute(held, questions, 6)
    seen = brute(held, questions, 6, lambda t, q: t % 9 != 4 and may(shown[0][t], shown[1][q]))
    assert run(about=points.where("id % 9 <> 4"), asking=queries) == seen
    assert search.sparse_search(terms, asked.limit(0)).count() == 0 and search.sparse_search(terms.limit(0), asked).count() == 0


def test_words_stay_in_their_row_and_unasked_ones_go(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "a b b c"), (2, "c d"), (3, ""), (4, None), (2, "d e"), (5, "x"), (6, ""), (6, "y")], "id long, text string")
    flat = {}
    for r in term_frequencies(texts, "id", "text").collect():
        flat.setdefault(r.id, {})[r.idx] = r.tf
    asked = term_frequencies(spark.createDataFrame([(7, "b d")], "query_id long, text string"), "query_id", "text")
    used = {r.idx for r in asked.collect()}
    for known in (1 << 20, 1):  # beyond the bound all terms are kept
        monkeypatch.setattr(search, "KNOWN_TERMS", known)
        vectors = term_vectors(texts, "id", "text", search.asked_indices(asked))
        got = {r.id: (r.said, [(x.idx, x.tf) for x in r.terms]) for r in vectors.collect()}
        assert got == {k: (k in flat, sorted((i, n) for i, n in flat.get(k, {}).items() if known == 1 or i in used)) for k in range(1, 7)}
    plan = term_vectors(texts.where("id not in (2, 6)"), "id", "text", search.asked_indices(asked))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
