"""Queries against their SQL over documents of which some have no text, as sizes above sf0.1 hold a few."""

import duckdb
import pytest
from test_queries import plain

from quillspark.queries import QUERIES, SQL


def written(folder, where, name):
    """The documents of a folder, some without text, as a table of their own."""
    path = where / name
    path.mkdir()
    empty = "CASE WHEN doc_id % 9 IN (1, 5) THEN '' WHEN doc_id % 9 = 4 THEN '  ' ELSE text END"
    duckdb.sql(f"COPY (SELECT * REPLACE ({empty} AS text) FROM '{folder}/documents.parquet' WHERE doc_id < 60) TO '{path}/documents.parquet' (FORMAT parquet)")
    return str(path)


@pytest.fixture(scope="module")
def gaps(folder, tmp_path_factory):
    return written(folder, tmp_path_factory.mktemp("gaps"), "documents")


def differ(spark, folder, name):
    """Rows of a query that its SQL lacks, and the other way round."""
    frame, base = QUERIES[name](spark, folder), duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    found, columns = base.execute(SQL[name]), sorted(frame.columns)
    names = [x[0] for x in found.description]
    want = sorted(tuple(plain(dict(zip(names, row, strict=True))[c]) for c in columns) for row in found.fetchall())
    got = sorted(tuple(plain(row[c]) for c in columns) for row in frame.collect())
    return [x for x in got if x not in want], [x for x in want if x not in got], len(got) - len(want)


@pytest.mark.parametrize("kind", ["chk02_split_operation", "chk03_split_incident", "chk04_split_troubleshoot", "chk05_split_adr", "chk06_split_faq", "chk07_split_meeting"])
def test_drafts_of_pages_without_text(spark, gaps, kind):
    assert differ(spark, gaps, kind) == ([], [], 0)


def test_sections_of_pages_without_text(spark, gaps):
    assert differ(spark, gaps, "chk01_sections") == ([], [], 0)


def test_attachments_of_documents_without_text(spark, gaps):
    assert differ(spark, gaps, "flt05_analyze_attachments") == ([], [], 0)


def test_ratios_of_texts_with_any_character(spark, gaps):
    assert differ(spark, gaps, "fn08_max_char_ratio") == ([], [], 0)
    plan = QUERIES["fn08_max_char_ratio"](spark, gaps)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # counted once, not for the filter too


@pytest.mark.parametrize("name", ["idx02_lookup_links", "idx02_ordered_index", "idx03_ingestion_results", "st01_stream_chunking"])
def test_files_of_documents_without_text_are_read_by_extraction(spark, gaps, name):
    assert differ(spark, gaps, name) == ([], [], 0)
