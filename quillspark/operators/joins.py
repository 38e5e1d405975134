"""Lookups of one table's rows in another: equi, semi and anti joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import DEFAULT_DOC_TYPE, sample_text
from quillspark.sources.store import stage

Classifier = Callable[[list[str]], list[tuple[str, float] | tuple[str, float, str | None] | None]]

#: A side is broadcast up to so many rows and characters; beyond that the join shuffles.
SMALL_ROWS, SMALL_CHARS = 100_000, 32_000_000


def small(frame: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """The frame, to be broadcast if it has few rows that are not wide.

    It is computed once and staged, so that neither the count (which reads no
    column) nor the join computes it again; its characters are counted only if
    its rows are few.
    """
    held = stage(frame, "side")
    if held.count() > rows:
        return held
    chars = held.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    return F.broadcast(held) if (chars or 0) <= SMALL_CHARS else held


def load_message_pages(messages: DataFrame, raw_pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages with their page, messages without one)."""
    pages = raw_pages.select([F.col(c).alias(c if c == "page_id" else f"page_{c}") for c in raw_pages.columns])
    return messages.join(pages, "page_id"), messages.join(raw_pages.select("page_id"), "page_id", "left_anti")


def load_message_attachments(messages: DataFrame, raw_attachments: DataFrame, raw_pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(attachment messages whose attachment and page exist, the others)."""
    about = messages.where(F.col("source_type") == "attachment")
    known = raw_attachments.select("attachment_id", "page_id").join(raw_pages.select("page_id"), "page_id", "left_semi")
    files = raw_attachments.drop("page_id")
    found = about.join(known, ["attachment_id", "page_id"], "left_semi").join(files, "attachment_id")
    return found, about.join(known, ["attachment_id", "page_id"], "left_anti")


def inherit_parent(drafts: DataFrame, pages: DataFrame) -> DataFrame:
    """Attachment drafts with access, space, link and title of their page; their own time, name and type stay."""
    parent = pages.select("page_id", "allowed_groups", "allowed_users", "space_key", "webui_link", F.col("title").alias("page_title"), "version_number")
    return drafts.join(parent, "page_id")


def filter_unchanged(chunks: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunks to index, skipped): skipped if the cached version equals the page's."""
    same = chunks["chunk_id"] == F.col("_chunk")
    held = cache.select(F.col("chunk_id").alias("_chunk"), F.col("version_number").alias("_version"))
    same = same & (chunks["version_number"] == F.col("_version"))
    return chunks.join(held, same, "left_anti"), chunks.join(held, same, "left_semi")


def attach_version(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """Chunks with the version of their page; raises in the task that meets an unknown page."""
    joined = chunks.join(pages.select("page_id", F.col("version_number").alias("_version")), "page_id", "left")
    known = F.when(F.col("_version").isNull(), F.raise_error(F.concat(F.lit("unknown page "), F.col("page_id")))).otherwise(F.col("_version"))
    return joined.withColumn("version_number", known.cast("int")).drop("_version")


def attach_download_url(chunks: DataFrame, attachments: DataFrame) -> DataFrame:
    return chunks.join(attachments.select("attachment_id", "download_url"), "attachment_id", "left")


def resolve_doc_type(pages: DataFrame, cache: DataFrame, classified: DataFrame, least: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """(pages with their space's document type, entries to cache).

    A cached type wins; else a classification that is sure enough; else
    operation. Failed classifications (null confidence) are not cached, unsure
    ones are.
    """
    sure = F.when(F.col("confidence") >= least, F.col("dominant")).otherwise(F.lit(DEFAULT_DOC_TYPE))
    fresh = classified.join(cache.select("space_key"), "space_key", "left_anti").where("confidence is not null")
    fresh = fresh.select("space_key", sure.alias("doc_type"), "confidence")
    known = cache.select("space_key", "doc_type").unionByName(fresh.select("space_key", "doc_type"))
    typed = pages.join(small(known), "space_key", "left").withColumn("doc_type", F.coalesce("doc_type", F.lit(DEFAULT_DOC_TYPE)))
    return typed, fresh


def active_ids(pages: DataFrame, attachments: DataFrame) -> DataFrame:
    """Distinct (kind, id) of pages and attachments."""
    of_pages = pages.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"))
    return of_pages.unionByName(attachments.select(F.lit("attachment").alias("kind"), F.col("attachment_id").alias("id"))).distinct()


def find_ghosts(points: DataFrame, active: DataFrame) -> DataFrame:
    """Stored ids that are no longer active; only page points speak for pages, only attachment points for attachments."""
    ident = F.when(F.col("source_type") == "attachment", F.col("attachment_id")).otherwise(F.col("page_id"))
    stored = points.select(F.col("source_type").alias("kind"), ident.alias("id")).where("id is not null").distinct()
    return stored.join(active, ["kind", "id"], "left_anti")


def delete_cascade(points: DataFrame, ghosts: DataFrame) -> DataFrame:
    """Points without those of ghost pages (their attachments' included) and of ghost attachments."""
    pages = small(ghosts.where("kind = 'page'").select(F.col("id").alias("page_id")))
    files = small(ghosts.where("kind = 'attachment'").select(F.col("id").alias("attachment_id")))
    return points.join(pages, "page_id", "left_anti").join(files, "attachment_id", "left_anti")


def apply_soft_deletes(points: DataFrame, ids: DataFrame) -> DataFrame:
    """Marks the points of the given pages and attachments; rows and vectors stay."""
    pages = small(ids.where("kind = 'page'").select(F.col("id").alias("page_id"), F.lit(True).alias("_p")).distinct())
    files = small(ids.where("kind = 'attachment'").select(F.col("id").alias("attachment_id"), F.lit(True).alias("_a")).distinct())
    marked = points.join(pages, "page_id", "left").join(files, "attachment_id", "left")
    deleted = F.coalesce("_p", "_a", F.col("is_deleted"), F.lit(False))
    return marked.withColumn("is_deleted", deleted).select(*points.columns)


def diff_snapshots(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(page_id, change): new, updated, unchanged or deleted_candidate, by version and time of the two listings."""
    mark = lambda frame, name: frame.select("page_id", F.struct("version_number", "last_modified_at").alias(name))
    both = mark(previous, "was").join(mark(current, "now"), "page_id", "full_outer")
    change = (
        F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "deleted_candidate")
        .when(F.col("was") == F.col("now"), "unchanged").otherwise("updated")
    )
    return both.select("page_id", change.alias("change"))


def fetch_chunk_texts(chunk_ids: DataFrame, chunk_lookup: DataFrame) -> DataFrame:
    """Texts of known chunks; an empty URL is null, a missing text is empty."""
    found = chunk_ids.select("chunk_id").distinct().join(chunk_lookup, "chunk_id")
    return found.select("chunk_id", F.coalesce("text", F.lit("")).alias("text"), F.when(F.col("download_url") != "", F.col("download_url")).alias("download_url"))


def new_job_requests(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    """Requests whose job has not gone beyond being started, once each."""
    taken = jobs.where(F.col("status").isin("IN_PROGRESS", "COMPLETED", "FAILED")).select("job_id")
    return requests.dropDuplicates(["job_id"]).join(taken, "job_id", "left_anti")


def classify_spaces(pages: DataFrame, load: Callable[[], Classifier]) -> DataFrame:
    """(space_key, dominant, confidence, secondary) by one sample page per space, the one with the smallest id.

    ``load`` gives, once per worker, a callable from sample texts to (type,
    confidence) or (type, confidence, second type); None for a text that it
    cannot classify. A second type that is missing, empty or the first one
    again is null.
    """
    sample = sample_text(F.col("title"), F.col("labels"), F.col("body_html"))
    samples = pages.groupBy("space_key").agg(F.min_by(sample, "page_id").alias("sample"))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            found = [(*(x or (None, None)), None)[:3] for x in model(batch["sample"].tolist())]
            kinds, sure, second = zip(*found, strict=True) if found else ((), (), ())
            second = [None if not y or y == x else y for x, y in zip(kinds, second, strict=True)]
            yield pd.DataFrame({"space_key": batch.space_key, "dominant": kinds, "confidence": pd.array(sure, dtype="Float64"), "secondary": second})

    return samples.mapInPandas(each, "space_key string, dominant string, confidence double, secondary string")


def union_trash(batches: list[DataFrame]) -> DataFrame:
    """Distinct (kind, id) of trash listings of several spaces and result pages."""
    first, *others = (b.select("kind", "id") for b in batches)
    for other in others:
        first = first.unionByName(other)
    return first.distinct()


def union_delete_candidates(delta: DataFrame, trash: DataFrame, webhook: DataFrame, *, confirm: bool) -> DataFrame:
    """Distinct (kind, id) of the three triggers; the delta's only if confirmed."""
    ids = trash.select("kind", "id").unionByName(webhook.select("kind", "id"))
    return (ids.unionByName(delta.select("kind", "id")) if confirm else ids).distinct()


def sorted_ids(frame: DataFrame, group: str, ident: str) -> DataFrame:
    """Distinct ids of each group as rows, sorted by group and id over all partitions, so that no row grows with a group."""
    return frame.select(group, ident).distinct().orderBy(group, ident)
