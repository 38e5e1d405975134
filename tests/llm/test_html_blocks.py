"""Operator 5: rules, wrappers, odd markup, and a plain second implementation over the whole table."""

import re
import time
from collections import Counter
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from quillspark.llm.html_blocks import BAD, GOOD, OUT, UNSURE, blocks_of, extract_main_text, first_pass, main_text, second_pass, settle

PROSE = "The cat and the dog were in the house with a mouse that was on the roof of it, and so they were all at home. " * 4
ARTICLE = f"<article><h1>Title of it</h1><p>{PROSE}</p><p>Short one.</p></article>"
WANT = f"Title of it\n\n{PROSE.strip()}\n\nShort one."


class Plain(HTMLParser):
    """Text of the article elements, cut at paragraphs, headings and list items; no rules at all."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.depth, self.parts = 0, [""]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag == "br":
            self.parts[-1] += " "
        elif tag in ("p", "h1", "h2", "h3", "li", "article"):
            self.parts.append("")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in ("p", "h1", "h2", "h3", "li", "article"):
            self.parts.append("")

    def handle_data(self, data):
        if self.depth:
            self.parts[-1] += data

    def text(self):
        return "\n\n".join(x for x in (" ".join(part.split()) for part in self.parts) if x)


def test_whole_table_against_a_plain_version(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in extract_main_text(pages).collect()}
    want = {r.page_id: Plain(r.html or "").text() for r in pages.collect()}
    assert got == {k: (x, len(x)) for k, x in want.items()}


def test_the_rules_decide_without_article_elements(spark):
    """Prose decides, unsure blocks follow it, and the text hardly changes when articles become plain elements."""
    same, kept, found, decided = 0, 0, 0, Counter()
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        with_article, renamed = row.html or "", re.sub(r"<(/?)(article|main)\b", r"<\1div", row.html or "")
        a, b = Counter(main_text(with_article).split()), Counter(main_text(renamed).split())
        same, kept, found = same + sum((a & b).values()), kept + sum(a.values()), found + sum(b.values())
        decided.update(first_pass(x) for x in blocks_of(renamed)[0])
    assert same >= 0.95 * kept and same >= 0.95 * found
    assert min(decided[x] for x in (BAD, UNSURE, GOOD)) > 100


@pytest.mark.parametrize("tag", ["article", "div"])
@pytest.mark.parametrize(
    "marks",
    ["content-with-sidebar", "layout-sidebar-right", "page two-col sidebar-left", "post comments-open", "single share-buttons-on", "story-related"],
)
def test_wrappers_do_not_erase_what_they_wrap(marks, tag):
    comments = '<div class="comments"><article class="comment">' + "I think that this is the best of the posts and I do like it. " * 20 + "</article></div>"
    inner = ARTICLE.replace("article", tag)
    assert main_text(f'<body><nav><a href="/">Home</a></nav><div class="{marks}">{inner}{comments}</div><footer>(c) us</footer></body>') == WANT
    assert main_text(f'<body><form id="all"><div class="{marks}"><div class="ad">Buy the thing that we sell</div>{inner}</div></form></body>') == WANT


@pytest.mark.parametrize(
    ("html", "text"),
    [
        # A wide gap inside a link is one space before links are counted.
        (f"<div><p>{PROSE}</p><p>{PROSE}<a href=x>{' ' * 400}here</a></p></div>", f"{PROSE.strip()}\n\n{PROSE.strip()} here"),
        ("<article><p>sum <math><mi>x</mi><mo>+</mo><mn>1</mn></math> and <object>plain</object> <svg><text>drawn</text></svg><noscript>kept</noscript></p></article>",
         "sum x+1 and plain drawnkept"),
        (f"<article><p>{PROSE}</p><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul><p>{PROSE}</p><p><a>Read the report</a></p></article>",
         f"{PROSE.strip()}\n\n{PROSE.strip()}\n\nRead the report"),
        (f"<div><p>{PROSE}</p></div><div>&copy; 2024 the house</div>", PROSE.strip()),
        (f"<article><p>Teaser only.</p></article><div><p>{PROSE}</p><p>{PROSE}</p></div>", f"Teaser only.\n\n{PROSE.strip()}\n\n{PROSE.strip()}"),
        (f"<article><p>{PROSE}</p></article><div><p>{PROSE[:110]}</p></div>", PROSE.strip()),
        ('<article><p title="a > b">one<p data-x=\'>\'>two<a href=x"y>z</a></article>', "one\n\ntwoz"),
        ("<article>one<![CDATA[ <b> & ]]>two<?x y?><!DOCTYPE z></ >three</article>", "one <b> & twothree"),
        ("<article>one<!--><p>two</p></article>", "one\n\ntwo"), ("<article>one<p title='x>two</article>three>four", "one\n\ntwo"),
        ("<article>&#x41;&#66;&copy;&nbsp;&amp;lt; &unknown; &#0;</article>", "AB© &lt; &unknown; �"),
        ("<ul><li>alpha<li>beta</ul>", "alpha\n\nbeta"), ("<div hidden><p>no</p></div><p style='display: none'>no</p><p>yes</p>", "yes"),
    ],
)
def test_cases(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize(
    "piece",
    ['<a "x', "<a 'x", '<a b="x', "<a b='x", '<a =" ', "<!--", "<![CDATA[", "<script>", "<p", "</", "<", "&", '<div class="ad">x', "<b>x", "<li>x", "<b><p>x</b>"],
)
def test_time_is_linear(piece):
    start = time.perf_counter()
    main_text(piece * 100_001)
    assert time.perf_counter() - start < 6


@pytest.mark.parametrize(("opened", "then"), [("<b>", "</i>"), ("<span>", "<p>x"), ("<a href=x>", "<div>y</a>")])
def test_time_is_linear_with_unclosed_elements(opened, then):
    start = time.perf_counter()
    main_text(opened * 50_000 + then * 50_000)
    assert time.perf_counter() - start < 6


def test_neighbours_decide():
    assert second_pass([GOOD, UNSURE, UNSURE, BAD, UNSURE], [1] * 5) == [True, True, False, False, False]
    assert second_pass([UNSURE, BAD, UNSURE], [1, OUT, 1]) == [True, False, True]
    assert second_pass([], []) == [] and settle([], [], [0]) == []


def test_columns_and_rows(spark):
    rows = [(1, "u", None), (1, "u", ARTICLE), (1, "u", ARTICLE), (None, None, ""), (2, "v", "<p>" + "word " * 100_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("_html", F.lit(2))
    got = sorted((r.page_id or 0, len(r.text), r.n_chars) for r in extract_main_text(frame).collect())
    assert got == [(0, 0, 0), (1, 0, 0), (1, len(WANT), len(WANT)), (1, len(WANT), len(WANT)), (2, 499_999, 499_999)]


def test_prose_of_a_language_without_a_list_survives_beside_links():
    first = "Это первый абзац на языке, для которого нет списка слов, и он достаточно длинный, чтобы быть текстом статьи."
    second = "日本語の段落です。" * 12
    page = f"<div><a href=x>One link here</a> <a href=y>Another link</a></div><div><p>{first}</p><p>{second}</p></div>"
    assert main_text(page) == f"{first}\n\n{second}"
