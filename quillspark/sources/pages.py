"""Page listings from JSON, crawl and delta payloads, and CSV files."""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.text import normalize_link, parse_iso_offset
from quillspark.operators.gates import extracted_format
from quillspark.sources.sheets import ENCODINGS

#: Fields of a page response.
RESPONSES = (
    "single_page_responses array<struct<id: string, space: struct<key: string, id: string, name: string>, title: string,"
    " body: struct<storage: struct<value: string>>, version: struct<number: int, when: string>, _links: struct<webui: string>,"
    " metadata: struct<labels: struct<results: array<struct<name: string>>>>, ancestors: array<struct<title: string>>,"
    " attachments: array<struct<filename: string, content_type: string>>>>"
)


def flatten_responses(responses: DataFrame) -> DataFrame:
    """Page rows with nested attachments from parsed page responses."""
    row = responses.select(F.explode("single_page_responses").alias("p"))
    none = F.array().cast("array<string>")
    when = parse_iso_offset(F.col("p.version.when"))
    files = F.transform(
        F.coalesce("p.attachments", F.array().cast("array<struct<filename: string, content_type: string>>")),
        lambda x, k: F.struct(
            F.concat(F.col("p.id"), F.lit("-att-"), k.cast("string")).alias("attachment_id"), x["filename"].alias("filename"),
            x["content_type"].alias("mime_type"), F.lit("").alias("extracted_text"), extracted_format(x["content_type"]).alias("extracted_format"),
            when.alias("last_modified"),
        ),
    )
    return row.select(
        F.col("p.id").alias("page_id"), F.col("p.space.key").alias("space_key"), F.coalesce("p.space.id", F.lit("")).alias("space_id"),
        F.coalesce("p.space.name", F.lit("")).alias("space_name"), F.col("p.title").alias("title"), F.col("p.body.storage.value").alias("body_html"),
        F.col("p.version.number").alias("version_number"), when.alias("last_modified"), F.col("p._links.webui").alias("webui_link"),
        F.coalesce(F.col("p.metadata.labels.results.name"), none).alias("labels"), F.coalesce(F.col("p.ancestors.title"), none).alias("ancestors"),
        files.alias("attachments"),
    )


def read_page_responses(spark: SparkSession, path: str) -> DataFrame:
    return flatten_responses(spark.read.schema(RESPONSES).json(path, multiLine=True))


def attachments_of(pages: DataFrame) -> DataFrame:
    """One row per attachment with its page and the page's version."""
    rows = pages.select("page_id", "version_number", "space_key", F.explode("attachments").alias("a"))
    return rows.select("page_id", "version_number", "space_key", "a.*")


def map_crawled_documents(docs: DataFrame, chain: DataFrame, site: str) -> DataFrame:
    """Crawled documents as page rows; titles of ancestors from the root down, those outside the batch left out."""
    flat = docs.select(
        F.col("page.id").alias("page_id"), F.col("space.key").alias("space_key"), F.coalesce("space.id", F.lit("")).alias("space_id"),
        F.coalesce("space.name", F.lit("")).alias("space_name"), F.col("page.title").alias("title"), F.col("page.body").alias("body_html"),
        F.coalesce("page.version", F.lit(0)).alias("version_number"), parse_iso_offset(F.col("page.modified")).alias("last_modified"),
        normalize_link(F.col("page.webui"), site).alias("webui_link"),
    ).where("last_modified is not null")
    titles = flat.select(F.col("page_id").alias("ancestor_id"), F.col("title").alias("_title"))
    path = chain.join(titles, "ancestor_id").groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("d"), "_title"))).alias("_path"))
    none = F.array().cast("array<string>")
    joined = flat.join(path, "page_id", "left")
    return joined.withColumn("ancestors", F.coalesce(F.col("_path._title"), none)).withColumn("labels", none).drop("_path")


def map_changed_documents(changed: DataFrame, acl: DataFrame, site: str = "") -> tuple[DataFrame, DataFrame]:
    """(page rows of a delta with their access lists, rows without a modification time); a delta gives no labels or ancestors."""
    none = F.array().cast("array<string>")
    link = F.col("page_url") if "page_url" in changed.columns else F.lit("")
    flat = changed.select(
        "page_id", "space_key", F.coalesce("space_name", "name", F.lit("")).alias("space_name"), "title", "body_html",
        F.coalesce("version_number", F.lit(0)).alias("version_number"), parse_iso_offset(F.col("last_modified_at")).alias("last_modified"),
        normalize_link(link, site).alias("webui_link"), none.alias("labels"), none.alias("ancestors"),
    )
    joined = flat.join(acl.select("page_id", "allowed_groups", "allowed_users"), "page_id", "left")
    joined = joined.withColumn("allowed_groups", F.coalesce("allowed_groups", none)).withColumn("allowed_users", F.coalesce("allowed_users", none))
    return joined.where("last_modified is not null"), joined.where("last_modified is null").select("page_id", F.lit("transform_changed_html").alias("stage"))


def chunking_messages(pages: DataFrame, attachments: DataFrame) -> DataFrame:
    """One message per page and per attachment: ids, version and kind, never a body."""
    of_pages = pages.select("page_id", F.lit(None).cast("string").alias("attachment_id"), "space_key", "version_number", F.lit("page").alias("source_type"))
    of_files = attachments.select("page_id", "attachment_id", "space_key", "version_number", F.lit("attachment").alias("source_type"))
    return of_pages.unionByName(of_files)


def _decoded(raw: bytes) -> str:
    for encoding in ENCODINGS:
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    raise AssertionError("latin-1 decodes anything")


def csv_cells(name: str, raw: bytes) -> Iterator[tuple[str, int, list[str]]]:
    """(sheet, row number, cells) of one small file at hand; cells trimmed and kept as text, empty rows left out.

    Files of any size are read by ``sheets.read_csv_cells``.
    """
    csv.field_size_limit(sys.maxsize)
    sheet = PurePosixPath(name).stem or name
    rows = ([cell.strip() for cell in row] for row in csv.reader(io.StringIO(_decoded(raw))))
    for number, row in enumerate(row for row in rows if any(row)):
        yield sheet, number, row
