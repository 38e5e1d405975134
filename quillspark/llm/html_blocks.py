"""Operator 5: main text of HTML pages by two passes of block rules."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    """a about after all also an and are as at be been but by can could did do does for from had has have he her his how i
    if in into is it its more most no not of on one or other our out she should so some such than that the their them then
    there these they this to up was we were what when where which who will with would you your
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour que qui
    sa se ses son sont sur un une vous
    aber als am auch auf aus bei bin bis das dass dem den der die durch ein eine einem einen einer es für hat ich ihr im ist
    mit nach nicht noch nur oder sich sie sind über um und uns von vor war wenn werden wie wir wird zu zum zur
    al como con del el ella ellos entre era esta este fue ha hay las lo los más me mi muy nos o para pero por porque si sin
    sobre su sus también te tiene y ya""".split()
)

#: Elements whose content is no markup and never text of the page.
_RAW = ("script", "style", "template", "textarea", "iframe", "title", "noembed", "noframes")
#: Elements that end a block where they start and where they end.
_BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
    section select summary table tbody td tfoot th thead tr ul""".split()
)
#: Elements without content.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are not part of an article.
_OUTSIDE = frozenset("nav footer aside head menu dialog button select fieldset search option".split())
#: Elements and roles that hold an article.
_INSIDE = frozenset("article main".split())
_OUTSIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
#: Words of a class or id that mark something beside the article. A word counts whole, with or without a plural s.
_BESIDE = frozenset(
    """ad adbox adsense advert advertisement advertising adslot banner breadcrumb breadcrumbs comment commentlist
    comments consent cookie cookiebar copyright disclaimer disqus footer footnav gdpr header interstitial login masthead menu
    menubar modal nav navbar navigation navmenu newsletter notice notification outbrain overlay pager pagination paywall
    popup privacy promo promotion reaction recommended related replies respond reviews search share sharing shoutbox sidebar
    sidenav signup skyscraper social sponsor sponsored subscribe subscription taboola tagcloud teaser toolbar topbar topnav
    tracking widget""".split()
)
#: Those that mark the article's own head inside an article.
_HEADS = frozenset(["header", "banner", "masthead"])
#: Elements closed by the start of another one.
_CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
#: Blocks between which an implied end does not reach further up.
_FENCES = frozenset(["ul", "ol", "dl", "table", "div", "article", "section", "main", "body"])

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: The rest of a tag up to its end; a ">" in a quoted value does not count. Never steps back.
_REST = re.compile(r"""((?>[^>=]+|=\s*"[^"]*"|=\s*'[^']*'|=)*+)>""")
_RAW_ENDS = {name: re.compile(rf"</{name}(?![^\s/>])[^>]*>?", re.IGNORECASE) for name in _RAW}
_MARKS = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

OUT, NEUTRAL, ARTICLE = 0, 1, 2


@dataclass
class Block:
    """A run of text between block boundaries."""

    place: int
    heading: bool
    #: Innermost element above whose class, id or kind speaks against it (its number), none: 0.
    region: int = 0
    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    text: str = ""
    links: int = 0
    stops: float = 0.0

    def finish(self) -> None:
        self.text = " ".join("".join(self.pieces).split())
        self.links = min(len(" ".join("".join(self.linked).split())), len(self.text))
        words = self.text.lower().split()
        if words:
            self.stops = sum(w.strip(".,;:!?\"'()[]") in STOP_WORDS for w in words) / len(words)


@dataclass
class Open:
    """An open element."""

    name: str
    place: int
    region: int
    heading: bool
    #: How many open elements lie below the nearest fence, itself included.
    fence: int


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest) of a page in order: "text", "start" and "end", in time linear in its length.

    Comments, declarations and the content of raw elements are left out. A tag
    that never ends takes the rest of the page with it; where only quotes keep
    it open, tags end at the next ">" from there on.
    """
    at, plain = 0, False
    while at < len(html):
        opened = html.find("<", at)
        if opened < 0:
            yield "text", "", html[at:]
            return
        if opened > at:
            yield "text", "", html[at:opened]
        lead = html[opened + 1 : opened + 2]
        if lead == "!" and html.startswith("<!--", opened):
            end = html.find("-->", opened + 2)
            at = end + 3 if end >= 0 else len(html)
        elif lead == "!" and html.startswith("<![CDATA[", opened):
            end = html.find("]]>", opened)
            yield "text", "", html[opened + 9 : end if end >= 0 else len(html)].replace("&", "&amp;")
            at = end + 3 if end >= 0 else len(html)
        elif lead and (lead in "!?" or lead == "/" and not _NAME.match(html, opened + 2)):
            end = html.find(">", opened)
            at = end + 1 if end >= 0 else len(html)
        elif lead == "/" or _NAME.match(html, opened + 1):
            name = _NAME.match(html, opened + (2 if lead == "/" else 1))
            whole = None if plain else _REST.match(html, name.end())
            if whole is None:
                plain, end = True, html.find(">", name.end())
                if end < 0:
                    return
                rest, at = html[name.end() : end], end + 1
            else:
                rest, at = whole[1], whole.end()
            word = name[0].lower()
            if lead == "/":
                yield "end", word, ""
            elif word in _RAW_ENDS:
                close = _RAW_ENDS[word].search(html, at)
                at = close.end() if close else len(html)
            else:
                yield "start", word, rest
        else:
            yield "text", "", "<"
            at = opened + 1


def _place(name: str, rest: str, place: int) -> tuple[int, bool]:
    """An element's place, given its parent's, and whether its kind, class or id speaks against what it holds."""
    if place == OUT or name in _OUTSIDE:
        return OUT, False
    if name == "header" and place != ARTICLE:
        return OUT, False
    inside, against = name in _INSIDE, name == "form"
    if rest and "=" in rest or "hidden" in rest:
        for key, *values in _MARKS.findall(rest):
            key, value = key.lower(), next((v for v in values if v), "")
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
                return OUT, False
            if key == "role":
                if value.lower() in _OUTSIDE_ROLES:
                    return OUT, False
                inside |= value.lower() in ("main", "article")
            elif key in ("class", "id") and name not in ("html", "body"):
                for token in value.split():
                    words = [x.lower() for x in _PARTS.findall(token)]
                    if words and words[0] in ("has", "with", "no", "without"):
                        continue  # says something of the page, such as has-sidebar
                    beside = {x for x in words if x in _BESIDE or x.removesuffix("s") in _BESIDE}
                    against |= bool(beside - (_HEADS if place == ARTICLE or inside else set()))
    return ARTICLE if inside else place, against


def blocks_of(html: str) -> tuple[list[Block], list[int]]:
    """All blocks of a page in order, with the place of each, and the region around each region (0: none)."""
    stack = [Open("", NEUTRAL, 0, False, 0)]
    depths: dict[str, list[int]] = defaultdict(list)
    around, found = [0], []
    now, links = Block(NEUTRAL, False), 0

    def cut() -> None:
        nonlocal now
        if now.pieces:
            found.append(now)
        top = stack[-1]
        now = Block(top.place, top.heading, top.region)

    def close(depth: int) -> list[Open]:
        """End the elements from a depth on."""
        nonlocal links
        gone = stack[depth:]
        del stack[depth:]
        for element in gone:
            depths[element.name].pop()
            links -= element.name == "a"
        return gone

    for kind, name, rest in tokens(html):
        if kind == "text":
            text = unescape(rest) if "&" in rest else rest
            now.pieces.append(text)
            if links:
                now.linked.append(text)
        elif name in _VOID:
            if name == "br":
                now.pieces.append(" ")
            elif name == "hr":
                cut()
        elif kind == "end":
            if depths[name]:
                gone = close(depths[name][-1])
                top = stack[-1]
                if any(x.name in _BLOCK or (x.place, x.region) != (top.place, top.region) for x in gone):
                    cut()
            elif name == "p":
                cut()
        elif not rest.endswith("/") or name in _BLOCK:
            ends = _CLOSES.get(name, ("p",) if name in _BLOCK else ())
            if ends:
                depth = max((depths[x][-1] for x in (*ends, "p") if depths[x]), default=0)
                if depth >= stack[-1].fence and depth:
                    close(depth)
            parent = stack[-1]
            place, against = _place(name, rest, parent.place)
            region = parent.region
            if against:
                region = len(around)
                around.append(parent.region)
            fence = len(stack) + 1 if name in _FENCES else parent.fence
            stack.append(Open(name, place, region, parent.heading or name in ("h1", "h2", "h3", "h4", "h5", "h6"), fence))
            depths[name].append(len(stack) - 1)
            links += name == "a"
            if name in _BLOCK or (place, region) != (parent.place, parent.region):
                cut()
    cut()
    for block in found:
        block.finish()
    return [x for x in found if x.text], around


#: Characters from which a block can decide for itself, stop words for each word, share of linked characters, and
#: blocks in a row that are mostly links and so a menu.
LONG, SHORT, STOPS_HIGH, STOPS_LOW, LINKED, MENU = 200, 70, 0.32, 0.20, 0.33, 3

BAD, UNSURE, GOOD = -1, 0, 1


def first_pass(block: Block) -> int:
    """Good, bad or unsure, by stop-word density, length and link density.

    Prose is good: a block with many stop words from ``SHORT`` characters on,
    with some from ``LONG`` on. One without any is in a language that no list
    knows: there length decides alone, where few characters are linked. Blocks
    that are mostly links, and short ones with a copyright sign, are bad. Short
    blocks, headings, and longer ones with few stop words (tables, names) are
    unsure.
    """
    size = len(block.text)
    if block.links > LINKED * size and size - block.links < SHORT:
        return BAD
    if size < LONG and "\u00a9" in block.text:
        return BAD
    if not block.heading and size >= SHORT and block.stops >= (STOPS_LOW if size >= LONG else STOPS_HIGH):
        return GOOD
    if not block.heading and size >= SHORT and block.stops == 0 and block.links <= LINKED * size:
        return GOOD
    return UNSURE


def settle(blocks: list[Block], labels: list[int], around: list[int]) -> list[int]:
    """Places of the blocks, from the marks above them and from where the prose is.

    A class, an id or a form speaks against all that an element holds, unless
    nothing else on the page is prose or an article: then it marks a wrapper
    (such as ``layout-sidebar-right``), and the elements around the most prose
    with the fewest marks lose theirs. Beside an article that holds at least
    half of the prose, unmarked blocks are outside too.
    """
    chosen = [k for k, x in enumerate(blocks) if x.place != OUT and (labels[k] == GOOD or x.place == ARTICLE)]
    free = {0}
    if chosen and all(blocks[k].region for k in chosen):
        depth = [0]
        for parent in around[1:]:
            depth.append(depth[parent] + 1)
        least = min(depth[blocks[k].region] for k in chosen)
        sizes: dict[int, int] = defaultdict(int)
        for k in chosen:
            if depth[blocks[k].region] == least:
                sizes[blocks[k].region] += len(blocks[k].text)
        region = max(sizes, key=lambda r: (sizes[r], -r))
        while region:
            free.add(region)
            region = around[region]
    places = [x.place if x.region in free else OUT for x in blocks]
    prose = [0, 0, 0]
    for block, label, place in zip(blocks, labels, places, strict=True):
        prose[place] += len(block.text) if label == GOOD else 0
    if ARTICLE in places and prose[ARTICLE] >= prose[NEUTRAL]:
        places = [OUT if x == NEUTRAL else x for x in places]
    return places


def second_pass(labels: list[int], places: list[int]) -> list[bool]:
    """Unsure blocks take the label of the nearest decided neighbour; at equal distance bad wins.

    Blocks outside are bad and count for nothing as neighbours. In an article a
    block of links is bad only in a row of ``MENU`` such blocks, else unsure.
    Where no block of the article, or of the page, is decided, unsure ones stay.
    """
    size, labels = len(labels), list(labels)
    start = 0
    while start < size:
        end = start
        while end < size and labels[end] == BAD and places[end] == ARTICLE:
            end += 1
        if end - start < MENU:
            labels[start:end] = [UNSURE] * (end - start)
        start = max(end, start + 1)

    def nearest(order: Iterable[int]) -> list[tuple[int, int]]:
        out, last = [(size + 1, GOOD)] * size, {}
        for i in order:
            if places[i] != OUT:
                if labels[i] != UNSURE:
                    last[places[i]] = i
                if places[i] in last:
                    out[i] = (abs(i - last[places[i]]), labels[last[places[i]]])
        return out

    before, after = nearest(range(size)), nearest(range(size - 1, -1, -1))
    keep = [labels[i] == GOOD or labels[i] == UNSURE and min(before[i], after[i])[1] == GOOD for i in range(size)]
    return [good and place != OUT for good, place in zip(keep, places, strict=True)]


def main_text(html: str | None) -> str:
    """The article of a page: its blocks, white space made single, joined by two line feeds."""
    if not html:
        return ""
    blocks, around = blocks_of(html)
    labels = [first_pass(x) for x in blocks]
    keep = second_pass(labels, settle(blocks, labels, around))
    return "\n\n".join(x.text for x, good in zip(blocks, keep, strict=True) if good)


def extract_main_text(
    pages: DataFrame, *, id_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html", out: str = "text"
) -> DataFrame:
    """Main text of every page: the id columns, ``text`` and ``n_chars`` (its code points).

    One row per input row, in one pass over the table without a shuffle. A
    page is cut into blocks at block elements; character references are
    decoded and white space inside a block becomes one space. Stop-word
    density, length and link density label the blocks (``first_pass``),
    elements and classes say which lie outside (``settle``), and blocks that
    are unsure take the label of their nearest decided neighbours
    (``second_pass``). The good ones are joined in page order by two line feeds.

    Defined cases: a null or empty page, or one without an article's text,
    gives an empty text. Unclosed and stray tags, comments and quotes never
    fail. Repeated rows, null ids and pages of any length are treated like any
    other; further columns are ignored; an empty table gives an empty result.
    """
    chosen = pages.select(*id_cols, F.col(html_col).cast("string").alias("_html"))
    fields = [f"`{c}` {chosen.schema[c].dataType.simpleString()}" for c in id_cols]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("_html")]
            columns = [batch.column(c) for c in id_cols]
            columns += [pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*id_cols, out, "n_chars"])

    return chosen.mapInArrow(each, ", ".join([*fields, f"`{out}` string", "n_chars long"]))
