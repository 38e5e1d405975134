"""Work on slices of Arrow batches, values computed once a row, and words counted where they lie."""

import tracemalloc
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark.functions import slices
from quillspark.functions.html import clean_html, render
from quillspark.functions.text import computed_once, hash_embed_dense, term_counts
from quillspark.operators.chunking import DRAFTS, chunk_pages, draft_lists, number_chunks, windows, windows_column
from quillspark.operators.reports import term_frequencies
from quillspark.plans import views
from quillspark.queries import QUERIES
from quillspark.sources import store


def test_slices_hold_few_bytes_and_every_row(spark):
    values = ["x" * n for n in (5, 0, 3000, 10, 900, 900, 1)] + [None]
    sizes = slices.row_bytes(pa.array(values))
    parts = list(slices.spans(sizes, 1000))
    assert [k for a, b in parts for k in range(a, b)] == list(range(len(values)))
    assert all(sizes[a:b].sum() <= 1000 or b == a + 1 for a, b in parts) and len(parts) == 4
    nested = pa.array([[{"text": "abc", "n": 1}], None, [], [{"text": "d" * 50, "n": 2}, {"text": None, "n": 3}]])
    assert [int(x) for x in slices.row_bytes(nested.slice(1))] == [8, 8, 8 + 2 * 24 + 50]
    # Every call sees few rows of a batch, which scalar functions over whole batches would not.
    limit = slices.SLICE_BYTES
    seen = slices.sliced(lambda x, y: pa.array([len(x)] * len(x), pa.int32()), "int", F.col("text"), F.col("id"))
    rows = spark.range(0, 64, 1, 1).select("id", F.repeat(F.lit("a"), limit // 8).alias("text")).select("id", seen.alias("n")).collect()
    assert len(rows) == 64 and max(r.n for r in rows) <= 8


@pytest.mark.parametrize(("column", "plain"), [(windows_column, windows), (clean_html, render)])
def test_windows_and_pages_hold_a_slice(monkeypatch, column, plain):
    made = []
    monkeypatch.setattr(F, "arrow_udf", lambda each, kind: made.append(each) or (lambda *columns: None))
    monkeypatch.setattr(slices, "SLICE_BYTES", 1 << 16)
    column(None)
    texts = ["\n".join(f"<p>{k} {n} {'word ' * 40}</p>" for n in range(k % 60)) for k in range(400)] + [None, ""]
    batch = pa.array(texts)
    first = made[0](iter([batch]))
    assert len(next(first)) < len(batch) / 10  # before the rest of the batch is worked on
    got = [x for part in made[0](iter([batch])) for x in part.to_pylist()]
    assert got == [plain(x or "") for x in texts]
    del got, first
    peaks = []
    for batches in (1, 3):
        tracemalloc.start()
        arrow, most = pa.total_allocated_bytes(), 0
        for _ in made[0](iter([batch] * batches)):
            most = max(most, pa.total_allocated_bytes() - arrow)
        peaks.append(tracemalloc.get_traced_memory()[1] + most)
        tracemalloc.stop()
    assert max(peaks) < batch.nbytes / 2 and peaks[1] < 1.2 * peaks[0], (peaks, batch.nbytes)


def test_drafts_as_arrow_values():
    assert draft_lists([[], [("a", None, True)], []]).to_pylist() == [[], [{"text": "a", "section_header": None, "is_atomic": True}], []]
    assert draft_lists([]).to_pylist() == [] and "is_atomic" in DRAFTS


def test_values_computed_once(spark):
    plan = spark.range(1).select(hash_embed_dense(F.col("id").cast("string"), "dense", 40).alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha2(") == 1
    assert [r[0] for r in spark.sql("select * from values (1), (null) as t(x)").select(computed_once(F.col("x"), lambda x: x + x)).collect()] == [2, None]
    assert spark.sql("select cast(null as string) as t").select(hash_embed_dense(F.col("t"), "dense", 3)).first()[0] == [None] * 3


def test_words_are_counted_within_their_row(spark, monkeypatch):
    long = "w" * 100
    texts = ["A a b c\x1cd", "", None, f" {long} {long} ß İ \n", "b b b"]
    index = lambda w: int(sha256(w.encode()).hexdigest()[:8], 16) % 7
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r[0]: [tuple(x) for x in r[1]] for r in frame.select("id", term_counts(F.col("text"), 7)).collect()}
    want = {k: sorted(Counter(map(index, (x or "").lower().split())).items()) for k, x in enumerate(texts)}
    assert got == want
    plan = term_frequencies(frame, "id", "text", 7)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # no row is moved where ids occur once
    double = frame.unionByName(frame.where("id in (0, 4)")).unionByName(spark.createDataFrame([(None, "n"), (None, "n n")], "id int, text string"))
    more = {(k, i): n * (2 if k in (0, 4) else 1) for k, x in want.items() for i, n in x} | {(None, index("n")): 3}
    for few in (100, 0):
        monkeypatch.setattr(store, "_FEW_KEYS", few)
        assert {(r.id, r.idx): r.tf for r in term_frequencies(double, "id", "text", 7).collect()} == more
        assert store.one_per_key(double, ["id"]).count() == 6
    assert np.isclose(sum(more.values()), sum(r.tf for r in term_frequencies(double, "id", "text", 7).collect()))


def test_drafts_are_made_once(spark, folder):
    plans = [QUERIES[name](spark, folder) for name in ("chk10_size_rules", "chk02_split_operation")] + [chunk_pages(views.structured_pages(spark, folder))]
    for plan in plans:
        assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    drafts = [(0, [("a", "h", True), (" ", "h", True), ("b", "h", False)]), (1, []), (2, None), (3, [(None, "h", True)])]
    rows = number_chunks(spark.createDataFrame(drafts, f"page_id int, drafts {DRAFTS}")).collect()
    assert sorted((r.page_id, r.chunk_index, r.text) for r in rows) == [(0, 0, "a"), (0, 2, "b")]
