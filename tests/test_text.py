"""The helpers that fold one document, against plain renditions of their rules; laws of the jobs."""

import hashlib
import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from quillspark.functions import text
from quillspark.functions.html import render
from quillspark.operators import chunking
from quillspark.plans import indexing, views
from quillspark.sources.pages import csv_cells


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""), ("  ", ""), ("<h2> A </h2><p> b &amp; c </p>", "## A\nb & c"), ("<ul><li>x</li><li><b>y</b></li></ul>", "- x\n- y"),
        ("<ol><li>x</li><li>y</li></ol>", "1. x\n2. y"), ("a<br/>b<br>c", "a\nb\nc"),
        ("<table><tr><th>h</th><th>i</th></tr><tr><td>1</td><td>2\n3</td></tr></table>", "| h | i |\n| --- | --- |\n| 1 | 2 3 |"),
        ('<ac:structured-macro ac:name="code"><ac:plain-text-body><![CDATA[if a < b: x("</p>")]]></ac:plain-text-body></ac:structured-macro>', '```\nif a < b: x("</p>")\n```'),
        ("<p>see <code>&lt;env&gt;</code></p>", "see `<env>`"),
        ("<ac:task><ac:task-status>complete</ac:task-status><ac:task-body>do</ac:task-body></ac:task>", "- [x] do"),
        ("<ac:image><ri:attachment/></ac:image>“q” {{< ref \"a\" >}}", '"q"'),
        ("<table><tr><td>a<table><tr><td>b</td><td>c</td></tr></table></td></tr></table>", "| a | b | c | | --- | --- | |\n| --- |"),
        ("<ul><li>a<ul><li>b</li></ul></li><li>c</li>lost</ul>", "- a\n- b\n- c"), ("<ac:task><ac:task-id>1</ac:task-id>x</ac:task>", "1x"),
        ("<ac:task><ac:task-status>incomplete</ac:task-status> <ac:task-body><p>a <b>b</b></p></ac:task-body></ac:task>then", "- [ ] a b\nthen"),
        ('<ac:structured-macro ac:name="code" x="y"><ac:parameter>py</ac:parameter><ac:plain-text-body>a &lt; b</ac:plain-text-body></ac:structured-macro>', "```\na < b\n```"),
        ('<ac:structured-macro ac:name="info"><ac:rich-text-body><p>hint</p></ac:rich-text-body></ac:structured-macro>', "hint"),
        ("<code class='x'>a</code> <code>b <i>c</i>  </code>", "a `b <i>c</i>`"), ("a {{% x %}} b {{< y", "a  b {{< y"), ("<p title='a > b'>c</p><script>if (a < b) {}</script>", "c\nif (a < b) {}"),
        ("<!DOCTYPE html><?x?>a < b &amp;amp; <", "htmlx?a < b &amp; <"), ("<p>one<p>two", "onetwo"), ("x\n\n\n\n\ny   ", "x\n\ny"), ("</p>stray <!-- note -->", "stray  note"),
    ],
)
def test_render(html, want):
    assert render(html) == want


@pytest.mark.parametrize(
    "piece",
    ["<code>", "<p>x", "<li>x", "<ul><li>x", "<a \"x", "<a b='x", "<!--", "<ac:task>", "{{<", "{{< x >}}", '<ac:structured-macro ac:name="code">', "<div>x", "<script>", "<"],
)
def test_render_time_is_linear(piece):
    start = time.perf_counter()
    render(piece * 50_001)
    assert time.perf_counter() - start < 8


def test_render_nested_tables_do_not_double():
    assert len(render("<table><tr><td>x" * 200)) < 6_000


def slow_windows(body, limit, overlap):
    count = chunking.tokens_in
    if count(body) <= limit:
        return [body]
    units = []
    for line in body.split("\n"):
        if not line.strip():
            continue
        if count(line) <= limit:
            units.append(line)
            continue
        part = []
        for word in line.split():
            if part and count(" ".join([*part, word])) > limit:
                units.append(" ".join(part))
                part = []
            part.append(word)
        units.append(" ".join(part))
    out, start = [], 0
    while True:
        end = start + 1
        while end < len(units) and sum(map(count, units[start : end + 1])) <= limit:
            end += 1
        out.append("\n".join(units[start:end]))
        if end == len(units):
            return out
        back = end
        while back > start + 1 and sum(map(count, units[back:end])) < overlap:
            back -= 1
        start = back


def test_windows_against_slow_version():
    draw = random.Random(3)
    for _ in range(300):
        lines = [" ".join(draw.choices(["word", "가나", "x", "漢字 a"], k=draw.randint(0, 25))) for _ in range(draw.randint(1, 20))]
        limit = draw.randint(5, 30)
        overlap = draw.randint(1, limit)
        assert chunking.windows("\n".join(lines), limit, overlap) == slow_windows("\n".join(lines), limit, overlap)


def test_splitters():
    body = "intro\n## A\none\n### B\ntwo\n### C\nthree"
    headers = lambda kind: [d.section_header for d in chunking.SPLITTERS[kind](body)]
    assert headers("operation") == ["A"] and headers("troubleshoot") == ["B", "C"] == headers("faq") and headers("adr") == ["A"]
    assert chunking.split_operation(body)[0].text.startswith("intro\n\nA\none")
    assert chunking.split_meeting("pre\n## A\nx\n## B")[1].text == "pre\n\nB"
    assert [d.section_header for d in chunking.split_faq("lost\nWhat?\nthis\n# Why?\nthat")] == ["What?", "Why?"]
    assert chunking.split_incident("plain") == [chunking.Draft("plain", "untitled", True)]


def test_size_rules():
    long = "\n".join(f"w{k} " * 40 for k in range(50))
    parts = chunking.sized([chunking.Draft(long, "H", True)])
    assert [d.section_header for d in parts] == [f"H (Part {k}/{len(parts)})" for k in range(1, len(parts) + 1)] and len(parts) > 1
    assert chunking.sized([chunking.Draft("a " * 1000, "H", True)])[0].text == "a " * 1000
    small = [chunking.Draft("a " * 90, str(k)) for k in range(5)]
    merged = chunking.merge_small(small)
    assert [d.section_header for d in merged] == ["0", "3"] and chunking.tokens_in(merged[0].text) == 270


def test_ids(spark):
    row = spark.range(1).select(text.chunk_id(F.lit("p"), F.lit(2)).alias("c"), text.point_id(F.lit("abc")).alias("p"), text.count_tokens(F.lit("가나 ab\x1fc 漢 ")).alias("n")).first()
    assert row.c == hashlib.sha1(b"p:2:").hexdigest() and row.p == str(uuid.uuid5(uuid.NAMESPACE_OID, "abc")) and row.n == 5


def test_csv():
    assert list(csv_cells("s.csv", "a, b\n,\n 007 ,x".encode("utf-8-sig"))) == [("s", 0, ["a", "b"]), ("s", 1, ["007", "x"])]
    assert list(csv_cells("k.csv", "가,나".encode("cp949"))) == [("k", 0, ["가", "나"])]


def test_second_run_indexes_nothing(spark, folder):
    pages = views.pages(spark, folder).limit(40)
    empty = pages.select(F.lit("").alias("chunk_id"), "version_number").where("false")
    first = indexing.run_ingestion(pages, empty, is_html=False)
    chunks = first["to_index"]
    assert chunks.count() == chunks.select("chunk_id").distinct().count() > 0
    assert first["points"].count() == 3 * chunks.count() and first["payload"].where("size(allowed_groups) = 0").isEmpty()
    second = indexing.run_ingestion(pages, first["cache"], is_html=False)
    assert second["to_index"].isEmpty() and second["skipped"].count() == chunks.count()
