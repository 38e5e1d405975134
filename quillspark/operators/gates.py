"""Filters and predicates: spaces, access, attachment quality, malformed messages, job requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import max_char_ratio

#: Parts of a MIME type and file extensions, in order of precedence.
MIME_HINTS = (
    ("pdf", "pdf"), ("wordprocessingml", "docx"), ("msword", "docx"), ("spreadsheetml", "xlsx"), ("ms-excel", "xlsx"), ("csv", "csv"),
)
EXTENSIONS = {".pdf": "pdf", ".docx": "docx", ".doc": "docx", ".xlsx": "xlsx", ".xls": "xlsx", ".csv": "csv"}
MIN_TEXT_LENGTH, MAX_REPETITION = 200, 0.8
JOB_MODES = ("full", "delta")
MESSAGE = "page_id string, attachment_id string, space_key string, version_number int, source_type string, _corrupt_record string"


def filter_space(pages: DataFrame, space_key: str) -> DataFrame:
    return pages if not space_key else pages.where(F.col("space_key") == space_key)


def pages_since(pages: DataFrame, since: str) -> DataFrame:
    return pages.where(F.col("last_modified") >= F.lit(since).cast("timestamp"))


def has_acl() -> Column:
    return (F.size("allowed_groups") > 0) | (F.size("allowed_users") > 0)


def acl_gate(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(indexable, without any access entry)."""
    return pages.where(has_acl()), pages.where(~has_acl())


def empty_body_gate(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """Pages that no chunk came from."""
    return pages.join(chunks.select("page_id").distinct(), "page_id", "left_anti")


def attachment_type(mime: Column, filename: Column) -> Column:
    """Type by MIME hint, else by extension; null if neither is known."""
    out = F.when(F.lit(False), F.lit(""))
    for hint, kind in MIME_HINTS:
        out = out.when(F.lower(mime).contains(hint), kind)
    extension = F.lower(F.regexp_extract(filename, r"[^.](\.[^.]+)$", 1))
    for ending, kind in EXTENSIONS.items():
        out = out.when(extension == ending, kind)
    return out


def extracted_format(mime: Column) -> Column:
    return F.when(F.lower(mime).rlike("spreadsheetml|csv|excel"), "sheet_serialized").otherwise("raw_text")


def analyze_attachments(attachments: DataFrame) -> DataFrame:
    """Adds ``attachment_type``, ``status`` and ``reason``; the first rule that applies decides.

    Unknown types are unsupported; empty texts with a file (a link, or a local
    path) are left to extraction; short texts and texts of one repeated character are poor.
    """
    text = F.coalesce("extracted_text", F.lit(""))
    places = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("download_url", "local_path") if c in attachments.columns]
    by_file = (text == "") & (F.concat(F.lit(""), *places) != "")
    typed = attachments.withColumn("attachment_type", attachment_type(F.col("mime_type"), F.col("filename")))
    ratio = F.when(F.length(text) >= MIN_TEXT_LENGTH, max_char_ratio(text)).otherwise(0.0)
    reason = (
        F.when(F.col("attachment_type").isNull(), "unknown type").when(by_file, "by file")
        .when(F.length(text) < MIN_TEXT_LENGTH, "short").when(ratio > MAX_REPETITION, "repetition").otherwise("ok")
    )
    status = (
        F.when(F.col("reason") == "unknown type", "UNSUPPORTED_ATTACH_TYPE")
        .when(F.col("reason").isin("short", "repetition"), "LOW_QUALITY_ATTACH").otherwise("SUCCESS")
    )
    return typed.withColumn("reason", reason).withColumn("status", status)


def metadata_filter(points: DataFrame, wanted: dict[str, object]) -> DataFrame:
    """Scalars by equality, lists by any; on array columns any element may match."""
    out = points
    for name, value in wanted.items():
        values = list(value) if isinstance(value, (list, tuple, set)) else [value]
        is_array = points.schema[name].dataType.typeName() == "array"
        entries = F.array(*map(F.lit, values)) if values else F.array().cast(points.schema[name].dataType if is_array else "array<string>")
        out = out.where(F.arrays_overlap(F.col(name), entries) if is_array else F.col(name).isin(values))
    return out


def acl_filter(points: DataFrame, groups: list[str], user: str, sentinel: str = "*") -> DataFrame:
    """Rows that one of the groups, everybody or the user may see."""
    mine = F.array(*map(F.lit, [*groups, sentinel]))
    return points.where(F.arrays_overlap("allowed_groups", mine) | F.array_contains("allowed_users", user))


def exclude_deleted(points: DataFrame) -> DataFrame:
    """Rows not marked as deleted; no mark is no deletion."""
    return points.where(~F.coalesce("is_deleted", F.lit(False)))


def route_malformed(messages: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(parsed messages, rejected rows): JSON objects with a page id, and an attachment id where it is about one."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = messages.withColumn("_m", F.from_json(column, MESSAGE, options))
    blank = lambda name: F.coalesce(F.trim(F.col(f"_m.{name}")), F.lit("")) == ""
    about_file = F.coalesce(F.col("_m.source_type") == "attachment", F.lit(False))
    bad = F.col("_m").isNull() | F.col("_m._corrupt_record").isNotNull() | blank("page_id") | (about_file & blank("attachment_id"))
    marked = parsed.withColumn("_bad", bad)
    good = marked.where(~F.col("_bad")).select(*[c for c in messages.columns if c != column], "_m.*").drop("_corrupt_record")
    return good, marked.where("_bad").select(*messages.columns)


def validate_job_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid requests with ``requested_ts``, rejected ones with ``reason``)."""
    blank = lambda name: F.coalesce(F.trim(F.col(name)), F.lit("")) == ""
    stamp = F.try_to_timestamp(F.trim("requestedAt"))
    reason = (
        F.when(blank("jobId"), "jobId").when(blank("mode") | ~F.trim("mode").isin(*JOB_MODES), "mode")
        .when(blank("adminUserId"), "adminUserId").when(blank("requestedAt") | stamp.isNull(), "requestedAt")
    )
    judged = requests.withColumn("requested_ts", stamp).withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null").drop("requested_ts")


def allowed_download(attachments: DataFrame, hosts: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose host may be downloaded from, the rest with their status)."""
    host = F.lower(F.expr("try_parse_url(download_url, 'HOST')"))
    good = F.coalesce(host.isin([h.lower() for h in hosts]), F.lit(False))
    return attachments.where(good), attachments.where(~good).withColumn("status", F.lit("ATTACH_DOWNLOAD_FAILED"))


def route_retries(failures: DataFrame, attempts: int = 5) -> tuple[DataFrame, DataFrame]:
    """(retries with their next count and delay in seconds, dead letters)."""
    count = F.coalesce(F.expr("try_cast(retry_count as int)"), F.lit(0))
    counted = failures.withColumn("_count", F.when(count < 0, 0).otherwise(count))
    again = counted.where(F.col("_count") < attempts - 1)
    again = again.withColumn("delay_s", F.pow(F.lit(2.0), "_count").cast("int")).withColumn("retry_count", F.col("_count") + 1)
    return again.drop("_count"), counted.where(F.col("_count") >= attempts - 1).drop("_count")
