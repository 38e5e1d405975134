"""Shapes of JSON payloads: restrictions, delete events, trash listings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RESTRICTIONS = (
    "operation string, restrictions struct<group: struct<results: array<struct<id: string, groupId: string, name: string>>>,"
    " user: struct<results: array<struct<accountId: string>>>>"
)
#: Events that delete a page or an attachment.
DELETE_EVENTS = (
    "page_removed", "page_trashed", "blogpost_removed", "blogpost_trashed", "content_removed", "attachment_removed", "attachment_trashed",
)


def _ordered(values: Column) -> Column:
    """Trimmed, without blanks, first of repeats kept."""
    return F.array_distinct(F.filter(F.transform(values, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))


def _filled(value: Column) -> Column:
    return F.when(F.trim(value) != "", F.trim(value))


def parse_restrictions(payload: Column, prefix: str = "") -> Column:
    """Groups and users of a read restriction; wrong shapes give empty lists."""
    parsed = F.from_json(payload, _RESTRICTIONS)
    groups = F.transform(
        parsed["restrictions"]["group"]["results"], lambda g: F.coalesce(_filled(g["id"]), _filled(g["groupId"]), _filled(g["name"]))
    )
    groups = F.transform(_ordered(groups), lambda g: F.concat(F.lit(prefix), g))
    users = _ordered(F.transform(parsed["restrictions"]["user"]["results"], lambda u: u["accountId"]))
    empty = F.array().cast("array<string>")
    return F.struct(F.coalesce(groups, empty).alias("allowed_groups"), F.coalesce(users, empty).alias("allowed_users"))


def parse_delete_event(payload: Column) -> Column:
    """(kind, id) of a delete event; null for other events and for events without an id."""
    named = F.coalesce(_filled(F.get_json_object(payload, "$.event")), F.get_json_object(payload, "$.eventType"))
    event = F.lower(F.trim(named))
    at = lambda path: _filled(F.get_json_object(payload, path))
    attachment, top = at("$.attachment.id"), at("$.id")
    page = F.coalesce(at("$.page.id"), at("$.blogpost.id"), at("$.blogPost.id"), at("$.content.id"))
    found = (
        F.when(attachment.isNotNull(), F.struct(F.lit("attachment").alias("kind"), attachment.alias("id")))
        .when(page.isNotNull(), F.struct(F.lit("page").alias("kind"), page.alias("id")))
        .when(top.isNotNull(), F.struct(F.when(event.contains("attachment"), F.lit("attachment")).otherwise(F.lit("page")).alias("kind"), top.alias("id")))
    )
    return F.when(event.isin(*DELETE_EVENTS), found)


def parse_trashed(kind: Column, ident: Column, status: Column) -> Column:
    """(kind, id) of a trashed item; null without an id or with another status."""
    good = _filled(ident).isNotNull() & (status.isNull() | (status == "trashed"))
    return F.when(good, F.struct(F.when(kind == "attachment", F.lit("attachment")).otherwise(F.lit("page")).alias("kind"), F.trim(ident).alias("id")))
