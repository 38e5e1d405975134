"""Aggregations: crawl, message, index, job and quality reports; term counts; job states."""

from __future__ import annotations

from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import asked_term_counts, term_counts, to_kst
from quillspark.sources.store import apart

TERMINAL = ("COMPLETED", "FAILED")


def crawl_report(pages: DataFrame, attachments: DataFrame, failures: DataFrame) -> DataFrame:
    """Pages, attachments and failed pages per space, counted; ``failed_ids`` lists the last."""
    counted = lambda frame, name: frame.groupBy("space_key").agg(F.count("*").alias(name))
    joined = counted(pages, "pages").join(counted(attachments, "attachments"), "space_key", "full_outer").join(counted(failures, "failed"), "space_key", "full_outer")
    zero = F.lit(0).cast("long")
    return joined.select("space_key", *(F.coalesce(c, zero).alias(c) for c in ("pages", "attachments", "failed")))


def failed_ids(failures: DataFrame) -> DataFrame:
    """Failed pages as rows, sorted by space and id."""
    return failures.select("space_key", "page_id").orderBy("space_key", "page_id")


def message_results(chunks: DataFrame, to_index: DataFrame, gates: DataFrame) -> DataFrame:
    """Status and counts per page and attachment; gates hold what never became a chunk."""
    keys = ["page_id", "attachment_id"]
    named = lambda frame: frame.select("chunk_id", "page_id", F.coalesce("attachment_id", F.lit("")).alias("attachment_id"))
    marked = named(chunks).join(to_index.select("chunk_id", F.lit(1).alias("_up")).distinct(), "chunk_id", "left")
    counts = marked.groupBy(*keys).agg(F.count("*").alias("chunks"), F.count("_up").alias("upserted"))
    done = counts.select(*keys, F.lit("SUCCESS").alias("status"), "chunks", "upserted", (F.col("chunks") - F.col("upserted")).alias("skipped"))
    zero = F.lit(0).cast("long")
    stopped = gates.select("page_id", F.coalesce("attachment_id", F.lit("")).alias("attachment_id"), "status", zero.alias("chunks"), zero.alias("upserted"), zero.alias("skipped"))
    return done.unionByName(stopped.join(done.select(*keys), keys, "left_anti"))


def index_report(to_index: DataFrame, skipped: DataFrame) -> DataFrame:
    """One row: how many chunks were upserted and how many skipped; ``index_ids`` lists them."""
    return index_ids(to_index, skipped).agg(F.count_if(F.col("outcome") == "upserted").alias("upserted"), F.count_if(F.col("outcome") == "skipped").alias("skipped"))


def index_ids(to_index: DataFrame, skipped: DataFrame) -> DataFrame:
    """(outcome, chunk_id) of every chunk of a run."""
    named = lambda frame, outcome: frame.select(F.lit(outcome).alias("outcome"), "chunk_id")
    return named(to_index, "upserted").unionByName(named(skipped, "skipped"))


def job_totals(results: DataFrame) -> DataFrame:
    good = F.count_if(F.col("status") == "SUCCESS")
    bad = F.count_if(F.col("status") != "SUCCESS")
    return results.groupBy("job_id").agg((good + bad).alias("total_pages"), good.alias("processed_pages"), bad.alias("failed_pages"))


def sync_log_rows(jobs: DataFrame) -> DataFrame:
    """Terminal jobs as log rows: whole seconds, half to even, never negative."""
    start = F.coalesce("started_at", "finished_at")
    seconds = F.bround(F.col("finished_at").cast("double") - start.cast("double"), 0).cast("long")
    at_least_0 = lambda name: F.greatest(F.lit(0), F.coalesce(F.col(name), F.lit(0))).alias(name)
    return jobs.where("finished_at is not null").select(
        "job_id", "mode", "status", at_least_0("updated_pages"), at_least_0("deleted_pages"), at_least_0("failed_pages"),
        start.alias("started_at"), "finished_at", F.greatest(F.lit(0), seconds).alias("duration"),
    )


def soft_delete_ids(ids: DataFrame, points: DataFrame) -> DataFrame:
    """(kind, id, applied): whether each id that was asked for has points."""
    ident = F.when(F.col("source_type") == "attachment", F.col("attachment_id")).otherwise(F.col("page_id"))
    stored = points.select(F.col("source_type").alias("kind"), ident.alias("id")).distinct().withColumn("found", F.lit(True))
    asked = ids.select("kind", F.trim("id").alias("id")).where("id <> ''").distinct().join(stored, ["kind", "id"], "left")
    return asked.select("kind", "id", F.coalesce("found", F.lit(False)).alias("applied"))


def soft_delete_report(ids: DataFrame, points: DataFrame) -> DataFrame:
    """How many ids of each kind have points, and how many have none; ``soft_delete_ids`` lists them."""
    return soft_delete_ids(ids, points).groupBy("kind").agg(F.count_if("applied").alias("applied"), F.count_if(~F.col("applied")).alias("missing"))


def term_frequencies(frame: DataFrame, ident: str, text: str, vocabulary: int = 100_000) -> DataFrame:
    """(id, idx, tf): lower-cased words hashed into a vocabulary and counted, one row per index.

    Words are counted within their row (``term_counts``). Only the counts of
    ids that several rows have are shuffled, to be added up.
    """
    alone, others = apart(frame.select(ident, text), [ident])
    counted = lambda rows: rows.select(ident, F.inline(term_counts(F.col(text), vocabulary)))
    if others is None:
        return counted(alone)
    return counted(alone).unionByName(counted(others).groupBy(ident, "idx").agg(F.sum("tf").alias("tf")))


def term_vectors(frame: DataFrame, ident: str, text: str, asked: Broadcast, vocabulary: int = 100_000) -> DataFrame:
    """(id, said, terms): one row per id with an array of (idx, tf) of the indices in ``asked``, and whether it has any word.

    As ``term_frequencies``, without a row per word. Only the counts of ids
    that several rows have are shuffled, to be added up.
    """
    alone, others = apart(frame.select(ident, text), [ident])
    counted = lambda rows: rows.select(ident, asked_term_counts(F.col(text), asked, vocabulary).alias("t")).select(ident, "t.said", "t.terms")
    if others is None:
        return counted(alone)
    flat = counted(others).select(ident, "said", F.inline_outer("terms")).groupBy(ident, "idx").agg(F.sum("tf").alias("tf"), F.bool_or("said").alias("said"))
    listed = F.filter(F.collect_list(F.struct("idx", "tf")), lambda x: x["idx"].isNotNull())
    return counted(alone).unionByName(flat.groupBy(ident).agg(F.bool_or("said").alias("said"), F.sort_array(listed).alias("terms")))


def document_frequencies(terms: DataFrame) -> DataFrame:
    """(idx, df): how many texts hold each index; one row per text and index comes in."""
    return terms.groupBy("idx").agg(F.count("*").alias("df"))


def pdf_body_font_size(lines: DataFrame) -> DataFrame:
    """Per file the font size of most characters; of equal ones the first seen."""
    sized = lines.groupBy("attachment_id", F.round("min_size", 1).alias("size")).agg(F.sum(F.length("text")).alias("chars"), F.min("line_no").alias("first"))
    return sized.groupBy("attachment_id").agg(F.max_by("size", F.struct("chars", (-F.col("first")).alias("f"))).alias("body_size"))


def chunk_quality(chunks: DataFrame) -> DataFrame:
    """Shares that the chunker aims at, and the median of tokens.

    ``with_columns`` is the share of sheet chunks all of whose rows name their
    columns ("[sheet] column: value"), null for other types; it needs ``text``.
    """
    share = lambda cond: F.avg(cond.cast("double"))
    missing = F.col("page_id").isNull() | (F.coalesce("section_header", F.lit("")) == "") | (F.coalesce("space_key", F.lit("")) == "")
    more = []
    if "text" in chunks.columns:
        named = F.forall(F.split("text", "\n"), lambda line: line.rlike(r"^\[.*\] [^:]+: "))
        more = [share(F.when(F.col("doc_type").isin("xlsx", "csv"), named)).alias("with_columns")]
    return chunks.groupBy("doc_type").agg(
        F.count("*").alias("chunks"), share(F.col("token_count").between(200, 800)).alias("in_range"), share(missing).alias("missing_metadata"),
        share(F.col("section_header") != "untitled").alias("with_header"), F.percentile("token_count", F.lit(0.5)).alias("median_tokens"), *more,
    )


def failed_jobs(log: DataFrame) -> DataFrame:
    return log.where("status <> 'SUCCESS'").groupBy("stage", "status").agg(F.count("*").alias("jobs"), F.min("started_at").alias("first_at"))


def failed_job_rows(log: DataFrame, page_id: str | None = None) -> DataFrame:
    """Failed jobs by page and start time: of one page, or all in that order."""
    failed = log.where("status <> 'SUCCESS'")
    return (failed if page_id is None else failed.where(F.col("page_id") == page_id)).orderBy("page_id", "started_at")


def job_state_latest(progress: DataFrame) -> DataFrame:
    """State of each job after its progress in order of (ts, event_id); what follows a terminal state counts for nothing."""
    order = Window.partitionBy("job_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    over = F.coalesce(F.max(F.col("status").isin(*TERMINAL)).over(order), F.lit(False))
    live = progress.withColumn("_over", over).where(~F.col("_over"))
    last = F.max_by(F.struct("status", F.greatest(F.lit(0), "processed_pages").alias("processed_pages")), F.struct("ts", "event_id"))
    return live.groupBy("job_id").agg(last.alias("s"), F.count("*").alias("events")).select("job_id", "s.status", "s.processed_pages", "events")


def completion_events(jobs: DataFrame) -> DataFrame:
    """JSON events of finished jobs; failed ones carry a code and their message."""
    filled = lambda name: F.coalesce(F.trim(F.col(name)), F.lit("")) != ""
    done = jobs.where(F.col("status").isin(*TERMINAL) & filled("job_id") & filled("mode") & filled("admin_user_id"))
    failed = F.col("status") == "FAILED"
    body = F.struct(
        F.col("job_id").alias("jobId"), F.col("admin_user_id").alias("adminUserId"), "mode", "status", to_kst(F.col("finished_at")).alias("completedAt"),
        F.when(failed, F.lit("INGEST_FAILED")).alias("errorCode"), F.when(failed, F.col("message")).alias("message"),
    )
    return done.select("job_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("event"))
