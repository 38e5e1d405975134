"""Names of queries, what runs them, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The views of ``plans.views`` in SQL.
PAGES = """pages_v AS (
  SELECT doc_id, doc_id::VARCHAR AS page_id, source AS space_key, substr(text, 1, 40) AS title, text AS body_html,
    (doc_id % 3 + 1)::INTEGER AS version_number, TIMESTAMP '2024-01-01' + to_hours(doc_id::INTEGER) AS last_modified,
    CASE WHEN doc_id % 10 = 0 THEN []::VARCHAR[] ELSE [lang] END AS allowed_groups, []::VARCHAR[] AS allowed_users,
    '/pages/' || doc_id AS webui_link,
    CASE WHEN doc_id % 6 < 5 THEN [['장애대응', 'troubleshooting', 'faq', '회의록', 'adr'][doc_id % 6 + 1]] ELSE []::VARCHAR[] END AS labels,
    [source] AS ancestors, lang FROM documents)"""
FILES = """files_v AS (
  SELECT doc_id, doc_id || '-att-0' AS attachment_id, doc_id::VARCHAR AS page_id,
    ['a.pdf', 'b.docx', 'c.xlsx', 'd.csv', 'e.DOC', 'f.png', 'g.xls'][doc_id % 7 + 1] AS filename,
    ['application/pdf', 'application/vnd.openxmlformats-officedocument.wordprocessingml.document',
     'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet', 'text/csv', 'application/octet-stream', 'image/png',
     'application/vnd.ms-excel'][doc_id % 7 + 1] AS mime_type,
    CASE WHEN doc_id % 13 = 0 THEN '' ELSE text END AS extracted_text,
    CASE WHEN doc_id % 2 = 0 THEN 'https://Files.example.com/' || doc_id ELSE 'https://elsewhere.example.org/' || doc_id END AS download_url
  FROM documents)"""
EDGES = """edges_v AS (
  SELECT doc_id::VARCHAR AS page_id, CASE WHEN doc_id > 0 THEN (doc_id // 2)::VARCHAR END AS parent_id FROM documents)"""
SNAPSHOTS = """before_v AS (
  SELECT o_orderkey::VARCHAR AS page_id, 1 AS version_number, o_orderdate::VARCHAR AS last_modified_at FROM orders WHERE o_orderkey % 11 <> 0),
after_v AS (
  SELECT o_orderkey::VARCHAR AS page_id, CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS version_number,
    o_orderdate::VARCHAR AS last_modified_at FROM orders WHERE o_orderkey % 13 <> 0)"""
LINES = """lines_v AS (
  SELECT *, CASE WHEN len(raw) < 60 AND line_no % 2 = 0 THEN 14.0 WHEN len(raw) < 60 THEN 10.6 ELSE 10.0 END AS max_size,
    CASE WHEN line_no % 9 = 8 THEN 9.0 ELSE 10.0 END AS min_size, len(raw) < 60 AND line_no % 3 = 0 AS bold, trim(raw) AS text
  FROM (SELECT doc_id || '-att-0' AS attachment_id, parts[i + 1] AS raw, i AS line_no, i // 10 + 1 AS page_no
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents))
  WHERE trim(raw) <> '')"""
CELLS = """cells_v AS (
  SELECT (l_orderkey // 500)::VARCHAR AS attachment_id, 'items' AS sheet_name, l_orderkey * 8 + l_linenumber AS row_no,
    [l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_quantity::VARCHAR, l_extendedprice::VARCHAR, l_shipdate::VARCHAR, l_returnflag] AS cells
  FROM lineitem)"""
PROGRESS = """progress_v AS (
  SELECT user_id::VARCHAR AS job_id, ts, event_id, CASE WHEN event_type = 'signup' THEN 'COMPLETED' ELSE 'IN_PROGRESS' END AS status,
    floor(value)::BIGINT AS processed_pages FROM events)"""
TOKENS = "(len(regexp_replace({0}, '[^가-힣぀-ヿ一-鿿]', '', 'g')) + len(list_filter(regexp_split_to_array(regexp_replace({0}, '[가-힣぀-ヿ一-鿿]', ' ', 'g'), '\\s+'), lambda w: w <> '')))"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add
