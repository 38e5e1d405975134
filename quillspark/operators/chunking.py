"""Cutting texts into chunks: sections by document type, then size rules, in one pass per document."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.html import render
from quillspark.functions.slices import lists, sliced
from quillspark.functions.text import CJK, chunk_id, coerce_doc_type, count_tokens, infer_doc_type, section_header, section_path

#: Token limits of a window, its overlap, the least size of a chunk, and of an atomic one.
MAX_TOKENS, OVERLAP_TOKENS, MIN_TOKENS, ATOMIC_MAX_TOKENS = 800, 100, 200, 1500
DRAFTS = "array<struct<text: string, section_header: string, is_atomic: boolean>>"

_LETTER = re.compile(CJK)
_HEADING = re.compile(r"^#{2,4}\s+(.+)$", re.MULTILINE)


class Draft(NamedTuple):
    text: str
    section_header: str
    is_atomic: bool = False


def tokens_in(text: str) -> int:
    return len(_LETTER.findall(text)) + len(_LETTER.sub(" ", text).split())


def _pack(words: list[str], limit: int) -> list[str]:
    """Words of an overlong line in as few parts as their order allows."""
    sums, parts, start = [0, *accumulate(map(tokens_in, words))], [], 0
    while start < len(words):
        end = max(start + 1, bisect_right(sums, sums[start] + limit) - 1)
        parts.append(" ".join(words[start:end]))
        start = end
    return parts


def windows(text: str, limit: int = MAX_TOKENS, overlap: int = OVERLAP_TOKENS) -> list[str]:
    """A text of at most ``limit`` tokens as it is; a longer one in windows of whole lines.

    Each window goes on from so many of the last lines of the one before that
    they hold ``overlap`` tokens, but at least one line further. Every line is
    counted once; ends and starts are looked up in the running sums.
    """
    if tokens_in(text) <= limit:
        return [text]
    units: list[str] = []
    for line in filter(str.strip, text.split("\n")):
        units += [line] if tokens_in(line) <= limit else _pack(line.split(), limit)
    sums, out, start = [0, *accumulate(map(tokens_in, units))], [], 0
    while units:
        end = max(start + 1, bisect_right(sums, sums[start] + limit) - 1)
        out.append("\n".join(units[start:end]))
        if end == len(units):
            break
        start = max(start + 1, bisect_right(sums, sums[end] - overlap) - 1)
    return out or [text]


def merge_small(drafts: list[Draft], least: int = MIN_TOKENS) -> list[Draft]:
    """A small draft joins the one before while that is small too; atomic ones stand alone."""
    out: list[Draft] = []
    room = False  # whether the last one may still grow
    for draft in drafts:
        small = not draft.is_atomic and tokens_in(draft.text) < least
        if small and room:
            out[-1] = out[-1]._replace(text=f"{out[-1].text}\n{draft.text}")
            room = tokens_in(out[-1].text) < least
        else:
            out.append(draft)
            room = small
    return out


def sized(drafts: list[Draft]) -> list[Draft]:
    """Size rules: windows for what is too long, numbered parts where it is atomic, then merging."""
    out: list[Draft] = []
    for draft in drafts:
        if draft.is_atomic and tokens_in(draft.text) <= ATOMIC_MAX_TOKENS:
            out.append(draft)
            continue
        parts = windows(draft.text)
        for k, part in enumerate(parts, 1):
            header = f"{draft.section_header} (Part {k}/{len(parts)})" if draft.is_atomic else draft.section_header
            out.append(Draft(part, header, draft.is_atomic))
    return merge_small(out)


def sections(text: str, level: int) -> tuple[str, list[tuple[str, str]]]:
    """What stands before the first heading of exactly that level, and (heading, body) of each."""
    mark = "#" * level + " "
    lines = text.split("\n")
    at = [k for k, line in enumerate(lines) if line.startswith(mark)]
    if not at:
        return text.strip(), []
    found = [
        (lines[a][len(mark) :].strip(), "\n".join(lines[a + 1 : b]).strip()) for a, b in zip(at, [*at[1:], len(lines)], strict=True)
    ]
    return "\n".join(lines[: at[0]]).strip(), found


def _said(header: str, body: str) -> str:
    return "\n".join(filter(None, (header, body))).strip() if body else header


def _by_level(text: str, levels: tuple[int, ...], atomic: bool, least: int = 1, everywhere: bool = False) -> list[Draft]:
    """Sections at the first level that has any; none if that level has fewer than ``least``.

    The preamble goes with the first section, or with each one (``everywhere``).
    """
    for level in levels:
        before, found = sections(text, level)
        if not found:
            continue
        if len(found) < least:
            return []
        drafts = []
        for k, (header, body) in enumerate(found):
            lead = f"{before}\n\n" if before and (everywhere or k == 0) else ""
            said = lead + _said(header, body)
            drafts.append(Draft(said.strip() if everywhere else said, header or "untitled", atomic))
        return drafts
    return []


def _first_heading(text: str, otherwise: str) -> str:
    found = _HEADING.search(text)
    return found[1].strip() if found and found[1].strip() else otherwise


def split_operation(text: str) -> list[Draft]:
    return _by_level(text, (2, 3), False) or [Draft(text, "untitled")]


def split_incident(text: str) -> list[Draft]:
    return _by_level(text, (2, 3), True) or [Draft(text, "untitled", True)]


def split_troubleshoot(text: str) -> list[Draft]:
    return _by_level(text, (3,), True, least=2) or split_incident(text)


def split_adr(text: str) -> list[Draft]:
    return [Draft(text, _first_heading(text, "ADR"), True)]


def split_faq(text: str) -> list[Draft]:
    """Headings of level 3 or 4 if there are two; else two lines that end in a question mark; else the whole."""
    if drafts := _by_level(text, (3, 4), True, least=2):
        return drafts
    lines = text.split("\n")
    at = [k for k, line in enumerate(lines) if line.strip().endswith("?")]
    if len(at) < 2:
        return [Draft(text, _first_heading(text, "FAQ"), True)]
    drafts = []
    for start, end in zip(at, [*at[1:], len(lines)], strict=True):
        question = re.sub(r"^\s*#*\s*|\s+$", "", lines[start])
        drafts.append(Draft("\n".join(lines[start:end]).strip(), question or "FAQ", True))
    return drafts


def split_meeting(text: str) -> list[Draft]:
    return _by_level(text, (2, 3), True, everywhere=True) or [Draft(text, _first_heading(text, "회의록"), True)]


SPLITTERS: dict[str, Callable[[str], list[Draft]]] = {
    "operation": split_operation,
    "incident": split_incident,
    "troubleshoot": split_troubleshoot,
    "adr": split_adr,
    "faq": split_faq,
    "meeting": split_meeting,
}


def body_drafts(body: str | None, kind: str, *, is_html: bool = True) -> list[Draft]:
    text = render(body) if is_html else (body or "").strip()
    drafts = SPLITTERS.get(kind, split_operation)(text) if text else []
    return [x for x in drafts if x.text.strip()]


def draft_lists(rows: list[list[Draft]]) -> pa.Array:
    """Drafts of each row as Arrow values of type ``DRAFTS``."""
    return lists(rows, text=pa.string(), section_header=pa.string(), is_atomic=pa.bool_())


def drafts_column(body: Column, kind: Column, *, is_html: bool = True, size_rules: bool = True) -> Column:
    """Drafts of a page as one array, computed per row in Arrow batches."""

    def each(bodies: pa.Array, kinds: pa.Array) -> pa.Array:
        drafts = (body_drafts(text.as_py(), name.as_py(), is_html=is_html) for text, name in zip(bodies, kinds, strict=True))
        return draft_lists([sized(x) if size_rules else x for x in drafts])

    return sliced(each, DRAFTS, body, kind)


def sections_column(text: Column, level: int) -> Column:
    """``sections`` over a column: what stands before the first heading of a level, and each heading with its body."""

    def each(texts: pa.Array) -> pa.Array:
        cut = [sections(x.as_py() or "", level) for x in texts]
        found = lists([x for _, x in cut], header=pa.string(), body=pa.string())
        return pa.StructArray.from_arrays([pa.array([x for x, _ in cut], pa.string()), found], names=["before", "sections"])

    return sliced(each, "struct<before: string, sections: array<struct<header: string, body: string>>>", text)


def windows_column(text: Column, limit: int = MAX_TOKENS, overlap: int = OVERLAP_TOKENS) -> Column:
    def each(texts: pa.Array) -> pa.Array:
        return pa.array([windows(x.as_py() or "", limit, overlap) for x in texts], pa.list_(pa.string()))

    return sliced(each, "array<string>", text)


def merge_undersized(drafts: Column, least: int = MIN_TOKENS) -> Column:
    """``merge_small`` as a built-in fold over a column of drafts."""

    def small(draft: Column) -> Column:
        return ~draft["is_atomic"] & (count_tokens(draft["text"]) < least)

    def step(done: Column, draft: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(
            F.concat_ws("\n", last["text"], draft["text"]).alias("text"), last["section_header"].alias("section_header"),
            F.lit(False).alias("is_atomic"),
        )
        grow = (F.size(done) > 0) & small(draft) & F.coalesce(small(last), F.lit(False))
        return F.when(grow, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(draft)))

    return F.aggregate(drafts, F.array().cast(DRAFTS), step)


def number_chunks(drafted: DataFrame, drafts: str = "drafts") -> DataFrame:
    """One row per draft with its place from 0; blank drafts keep their number and go.

    Rows without drafts go with the blank ones: the plain ``posexplode`` has Spark filter them
    out before, for which it makes the drafts a second time.
    """
    rows = drafted.select("*", F.posexplode_outer(drafts).alias("chunk_index", "_draft")).drop(drafts)
    return rows.select("*", "_draft.text", "_draft.section_header", "_draft.is_atomic").drop("_draft").where(F.trim("text") != "")


def chunk_pages(pages: DataFrame, doc_type: Column | None = None, *, is_html: bool = True) -> DataFrame:
    """Chunks of page bodies with their metadata; pages stay one row until their drafts are made.

    ``doc_type`` defaults to what the labels say; unknown types are operation.
    """
    kind = infer_doc_type(F.col("labels")) if doc_type is None else coerce_doc_type(doc_type)
    typed = pages.withColumn("doc_type", kind)
    drafted = typed.withColumn("drafts", drafts_column(F.col("body_html"), F.col("doc_type"), is_html=is_html)).drop("body_html")
    rows = number_chunks(drafted)
    return rows.select(
        chunk_id(F.col("page_id"), F.col("chunk_index")).alias("chunk_id"), "page_id", F.lit(None).cast("string").alias("attachment_id"),
        F.col("title").alias("page_title"), section_header(F.col("section_header")).alias("section_header"),
        section_path(F.col("ancestors"), F.col("section_header")).alias("section_path"), "chunk_index", "labels", "doc_type",
        "space_key", "allowed_groups", "allowed_users", "webui_link", "last_modified", "version_number",
        F.lit("page").alias("source_type"), count_tokens(F.col("text")).cast("long").alias("token_count"), "text",
    )

