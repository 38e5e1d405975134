"""Wiki storage markup to normalised text, as a vectorised function over a column of pages.

A page is read once, token by token, and elements are written out as they
close. Text is held in pieces that move from an element to the one around it
without being copied, so the time taken grows with the page's length.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column

from quillspark.functions.slices import sliced

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What stands before a heading, and plain quotes for curly ones.
_HEADINGS = {f"h{k}": "#" * k for k in range(1, 7)}
_QUOTES = str.maketrans({"“": '"', "”": '"', "‘": "'", "’": "'"})
#: Elements whose content is no markup.
_VERBATIM = ("script", "style")
#: Elements that change what they hold; others only pass it on.
_SHAPED = frozenset([*_HEADINGS, "p", "li", "ul", "ol", "table", "tr", "td", "th", "ac:task", "ac:task-status", "ac:task-body"])
#: Elements that are made of others.
_PARTS = {"ul": ("li",), "ol": ("li",), "tr": ("td", "th"), "ac:task": ("ac:task-status", "ac:task-body")}
_WORD = re.compile(r"[a-zA-Z][^\s/>]*")
#: The rest of a tag, where a ">" in a quoted value does not end it; never steps back.
_REST = re.compile(r"""((?>[^>=]+|=\s*"[^"]*"|=\s*'[^']*'|=)*+)>""")


class _Finder:
    """Looks for fixed strings from positions that only grow, and over no part of the source twice."""

    def __init__(self, source: str):
        self.source, self.last = source, {}

    def __call__(self, what: str, at: int) -> int:
        place = self.last.get(what, 0)
        if 0 <= place < at or what not in self.last:
            place = self.last[what] = self.source.find(what, at)
        return place


def _tokens(source: str) -> Iterator[tuple[str, str]]:
    """(kind, value): "text", "start", "end" and "empty" (an element without content), "code" and "block" (code, as written).

    Character references in text are decoded. Comments, declarations and the
    content of scripts count as text. A tag that never ends is text.
    """
    find, at, quoted = _Finder(source), 0, True
    while at < len(source):
        opened = find("<", at)
        if opened < 0:
            opened = len(source)
        if opened > at:
            yield "text", unescape(source[at:opened])
        if opened == len(source):
            return
        at = opened + 1
        lead = source[at : at + 1]
        if source.startswith("!--", at):
            end = find("-->", at + 3)
            yield "text", source[at + 3 : end if end >= 0 else len(source)]
            at = end + 3 if end >= 0 else len(source)
        elif source.startswith("![CDATA[", at):
            end = find("]]>", at)
            yield "text", source[at + 8 : end if end >= 0 else len(source)]
            at = end + 3 if end >= 0 else len(source)
        elif lead and lead in "!?":
            end = find(">", at)
            end = end if end >= 0 else len(source)
            said = source[at + 1 : end]
            yield "text", said[8:] if said[:8].lower() == "doctype " else said
            at = end + 1
        elif word := _WORD.match(source, at + (lead == "/")):
            name, rest = word[0].lower(), _REST.match(source, word.end()) if quoted else None
            if rest is None:
                quoted, end = False, find(">", word.end())
                if end < 0:
                    yield "text", unescape(source[opened:])
                    return
                said, at = source[word.end() : end], end + 1
            else:
                said, at = rest[1], rest.end()
            if lead == "/":
                yield "end", name
                continue
            if name == "code" and not said and (end := find("</code>", at)) >= 0:
                yield "code", source[at:end]
                at = end + 7
                continue
            if name == "ac:structured-macro" and said.lstrip().startswith('ac:name="code"'):
                body = find("<ac:plain-text-body>", at)
                start = body + len("<ac:plain-text-body>")
                data = body >= 0 and source.startswith("<![CDATA[", start)
                close = find("]]>", start) if data else start
                end = find("</ac:plain-text-body>", close) if body >= 0 and close >= 0 else -1
                last = find("</ac:structured-macro>", end) if end >= 0 else -1
                if last >= 0:
                    yield "block", source[start + 9 : close] if data else source[start:end]
                    at = last + len("</ac:structured-macro>")
                    continue
            yield ("empty" if name in _VOID or said.endswith("/") else "start"), name
            if name in _VERBATIM and not said.endswith("/"):
                end = find(f"</{name}", at)
                yield "text", source[at : end if end >= 0 else len(source)]
                at = end if end >= 0 else len(source)
        else:
            yield "text", "<"


class _Text:
    """Text in pieces: what is put around it, cut off its ends or appended to it costs no copy of the rest."""

    def __init__(self, *pieces: str):
        self.pieces = deque(pieces)

    def add(self, other: _Text) -> None:
        """Append another text, which is used up; the shorter row of pieces moves."""
        if len(other.pieces) > len(self.pieces):
            other.pieces.extendleft(reversed(self.pieces))
            self.pieces = other.pieces
        else:
            self.pieces.extend(other.pieces)

    def strip(self) -> _Text:
        pieces = self.pieces
        while pieces and not (left := pieces[0].lstrip()):
            pieces.popleft()
        if pieces:
            pieces[0] = left
        while pieces and not (right := pieces[-1].rstrip()):
            pieces.pop()
        if pieces:
            pieces[-1] = right
        return self

    def within(self, before: str, after: str) -> _Text:
        self.pieces.appendleft(before)
        self.pieces.append(after)
        return self

    def __str__(self) -> str:
        return "".join(self.pieces)


@dataclass
class _Element:
    """An open element: what it has said so far, and the items, cells or parts that it is made of."""

    name: str
    said: _Text = field(default_factory=_Text)
    #: (name, text) of the elements right below, where a list, a row or a task needs them.
    below: list[tuple[str, _Text]] = field(default_factory=list)
    #: Cells of the rows of a table.
    rows: list[list[str]] = field(default_factory=list)


def _row(cells: list[str]) -> str:
    return "| " + " | ".join(cells) + " |"


def _shape(done: _Element) -> _Text:
    """What an element that ends says to the one around it."""
    name, said = done.name, done.said
    if name in _HEADINGS:
        return said.strip().within(f"\n{_HEADINGS[name]} ", "\n")
    if name == "p":
        return said.strip().within("", "\n")
    if name in ("li", "ac:task-status"):
        return said.strip()
    if name in ("ul", "ol"):
        out, number = _Text("\n"), 0
        for kind, text in done.below:
            if kind == "li":
                number += 1
                out.add(text.strip().within(f"{number}. " if name == "ol" else "- ", "\n"))
        return out if number else _Text("\n\n")
    if name == "table":
        lines = [_row(cells) for cells in done.rows]
        if lines:
            lines.insert(1, _row(["---"] * len(done.rows[0])))
        return _Text("\n" + "\n".join(lines) + "\n")
    if name == "ac:task" and [kind for kind, _ in done.below] == ["ac:task-status", "ac:task-body"] and not str(said).strip():
        state, body = (text for _, text in done.below)
        ends = "\n" if body.pieces and body.pieces[-1].endswith("\n") else ""
        return body.strip().within(f"\n- [{'x' if str(state).strip() == 'complete' else ' '}] ", ends)
    if name == "ac:task":
        out = _Text()
        for _, text in done.below:
            out.add(text)
        out.add(said)
        return out
    return said


class _Page:
    """The open elements of a page. Unknown end tags are ignored, and an end tag ends all that its element holds."""

    def __init__(self) -> None:
        self.open = [_Element("")]
        self.depths: dict[str, list[int]] = {}

    def start(self, name: str) -> None:
        self.depths.setdefault(name, []).append(len(self.open))
        self.open.append(_Element(name))

    def end(self, name: str) -> None:
        if self.depths.get(name):
            self.close(self.depths[name][-1])

    def close(self, depth: int) -> None:
        while len(self.open) > depth:
            done, around = self.open.pop(), self.open[-1]
            self.depths[done.name].pop()
            if done.name == "tr":
                cells = [str(text).strip().replace("\n", " ") for kind, text in done.below if kind in ("td", "th")]
                table = next((x for x in reversed(self.open) if x.name == "table"), None) if self.depths.get("table") else None
                if table is not None:
                    table.rows.append(cells)
            text = _shape(done)
            if done.name in _PARTS.get(around.name, ()):
                around.below.append((done.name, text))
            elif around.name not in ("ul", "ol", "table"):  # which are written from their items and rows alone
                around.said.add(text)

    def text(self) -> str:
        self.close(1)
        return str(self.open[0].said)


def _tidy(text: str) -> str:
    """Without page shortcodes, spaces at line ends, and more than one empty line in a row; plain quotes."""
    kept, at, find = [], 0, _Finder(text)
    while True:
        starts = [x for x in (find("{{<", at), find("{{%", at)) if x >= 0]
        ends = [x for x in (find(">}}", min(starts) + 3), find("%}}", min(starts) + 3)) if x >= 0] if starts else []
        if not ends:
            break
        kept.append(text[at : min(starts)])
        at = min(ends) + 3
    lines, empty = [], 0
    for line in "".join([*kept, text[at:]]).translate(_QUOTES).split("\n"):
        line = line.rstrip()
        empty = 0 if line else empty + 1
        if empty < 2:
            lines.append(line)
    return "\n".join(lines).strip()


def render(html: str | None) -> str:
    """A page's normalised text; empty for null and blank pages.

    Code is kept verbatim (fenced or in backticks), tasks of a state and a body
    become check boxes, headings, lists and tables become markdown, other wiki
    tags go. A table shows its own rows; a table in a cell is part of the cell.
    """
    if not html or not html.strip():
        return ""
    page, code = _Page(), []
    for kind, value in _tokens(html.replace("\0", "")):
        top = page.open[-1].said
        if kind == "text":
            top.pieces.append(value)
        elif kind in ("code", "block"):
            # A mark stands for the code, whose line breaks are its own.
            mark = f"\0{len(code)}\0"
            top.pieces.append(f"`{mark}`" if kind == "code" else f"\n```\n{mark}\n```\n")
            code.append(unescape(value).strip())
        elif value == "br":
            top.pieces.append("\n")
        elif value in _SHAPED:
            if kind in ("start", "empty"):
                page.start(value)
            if kind in ("end", "empty"):
                page.end(value)
    pieces = page.text().split("\0")  # every second one is the number of a code
    return _tidy("".join(code[int(x)] if k % 2 else x for k, x in enumerate(pieces)))


def clean_html(html: Column) -> Column:
    """``render`` over a column, in Arrow batches."""
    return sliced(lambda pages: pa.array([render(x.as_py()) for x in pages], pa.string()), "string", html)
