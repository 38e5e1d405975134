"""Cutting and rendering over whole tables, against second implementations that are plain and slow."""

import hashlib
import re
from collections import Counter
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from quillspark.operators import chunking, layout
from quillspark.plans import views
from quillspark.queries import QUERIES


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def tokens(text):
    letters = re.findall("[가-힣぀-ヿ一-鿿]", text)
    return len(letters) + len(re.sub("[가-힣぀-ヿ一-鿿]", " ", text).split())


def pieces(text, limit=800, overlap=100):
    """Windows, by trying every end and every start."""
    if tokens(text) <= limit:
        return [text]
    units = []
    for line in (x for x in text.split("\n") if x.strip()):
        if tokens(line) <= limit:
            units.append(line)
            continue
        part = []
        for word in line.split():
            if part and tokens(" ".join([*part, word])) > limit:
                units.append(" ".join(part))
                part = []
            part.append(word)
        units.append(" ".join(part))
    out, start = [], 0
    while True:
        end = start + 1
        while end < len(units) and sum(map(tokens, units[start : end + 1])) <= limit:
            end += 1
        out.append("\n".join(units[start:end]))
        if end == len(units):
            return out
        back = end
        while back > start + 1 and sum(map(tokens, units[back:end])) < overlap:
            back -= 1
        start = back


def by_size(drafts):
    """(text, header, atomic) under the size rules."""
    cut = []
    for text, header, atomic in drafts:
        parts = [text] if atomic and tokens(text) <= 1500 else pieces(text)
        cut += [(p, f"{header} (Part {k}/{len(parts)})" if atomic and (len(parts) > 1 or tokens(text) > 1500) else header, atomic) for k, p in enumerate(parts, 1)]
    out = []
    for text, header, atomic in cut:
        if out and not atomic and not out[-1][2] and tokens(text) < 200 and tokens(out[-1][0]) < 200:
            out[-1] = (f"{out[-1][0]}\n{text}", out[-1][1], False)
        else:
            out.append((text, header, atomic))
    return out


@pytest.fixture(scope="module")
def bodies(spark, folder):
    return {r.page_id: r for r in views.pages(spark, folder).select("page_id", "body_html", "labels", "doc_id").collect()}


def test_windows(spark, folder, bodies):
    got = {}
    for r in QUERIES["chk08_windows"](spark, folder).collect():
        got.setdefault(str(r.doc_id), []).append((r.window, r.tokens, r.text_md5))
    assert {k: sorted(x) for k, x in got.items()} == {k: [(n, tokens(w), md5(w)) for n, w in enumerate(pieces(r.body_html))] for k, r in bodies.items()}


def test_size_rules_and_part_labels(spark, folder, bodies):
    want = {}
    for k, r in bodies.items():
        found = re.search(r"^#{2,4}\s+(.+)$", r.body_html.strip(), re.MULTILINE)
        want[k] = [(n, h, md5(t)) for n, (t, h, _) in enumerate(by_size([(r.body_html.strip(), found[1].strip() if found else "ADR", True)]))]
    got = {}
    for r in QUERIES["chk10_size_rules"](spark, folder).collect():
        got.setdefault(r.page_id, []).append((r.chunk_index, r.section_header, r.text_md5))
    assert {k: sorted(x) for k, x in got.items()} == want
    labels = {}
    for r in QUERIES["win03_part_labels"](spark, folder).collect():
        labels.setdefault(r.page_id, []).append((r.place, r.part, r.parts))
    for k, rows in labels.items():
        count = len(by_size([(bodies[k].body_html.strip(), "untitled", True)]))
        assert sorted(rows) == ([(n, str(n + 1), str(count)) for n in range(count)] if count > 1 else [(0, "", "")])


def test_chunks_of_pages(spark, folder, bodies):
    kinds = {"장애대응": "incident", "troubleshooting": "troubleshoot", "faq": "faq", "회의록": "meeting", "adr": "adr"}
    drafts = {}  # the splitters' own rows are compared with SQL
    names = ("operation", "incident", "troubleshoot", "adr", "faq", "meeting")
    texts = {}
    for name in names:
        cut = chunking.drafts_column(F.col("body_html"), F.lit(name), size_rules=False)
        for r in views.structured_pages(spark, folder).select("page_id", cut.alias("d")).collect():
            texts[name, r.page_id] = [(d.text, d.section_header, d.is_atomic) for d in r.d]
    for k, r in bodies.items():
        kind = kinds[r.labels[0]] if r.labels else "operation"
        drafts[k] = [(n, kind, h.strip() or "untitled", tokens(t), md5(t)) for n, (t, h, _) in enumerate(by_size(texts[kind, k]))]
    got = {}
    for r in QUERIES["chk11_chunk_pages"](spark, folder).collect():
        got.setdefault(r.page_id, []).append((r.chunk_index, r.doc_type, r.section_header, r.token_count, r.text_md5))
        assert r.chunk_id == hashlib.sha1(f"{r.page_id}:{r.chunk_index}:".encode()).hexdigest()
    assert {k: sorted(x) for k, x in got.items()} == drafts


def test_chunks_of_sheets(spark, folder):
    sheets = {}
    for r in views.cells(spark, folder).collect():
        sheets.setdefault(r.attachment_id, []).append((r.row_no, r.cells))

    def recut(texts, start):
        if sum(map(tokens, texts)) <= 800:
            return [("\n".join(texts), f"[items] 행 {start}~{start + len(texts) - 1}")]
        size = next((s for s in (50, 25, 10) if s < len(texts)), 1)
        if len(texts) == 1:
            parts = pieces(texts[0])
            return [(p, f"[items] 행 {start}" + (f" (part {k}/{len(parts)})" if len(parts) > 1 else "")) for k, p in enumerate(parts, 1)]
        if size == 1:
            return [x for k, t in enumerate(texts) for x in ([(t, f"[items] 행 {start + k}")] if tokens(t) <= 800 else recut([t], start + k))]
        return [x for k in range(0, len(texts), size) for x in recut(texts[k : k + size], start + k)]

    want = {}
    for name, rows in sheets.items():
        texts = ["[items] " + " | ".join(f"col_{k}: {c}" for k, c in enumerate(cells, 1)) for _, cells in sorted(rows)]
        cut = [x for k in range(0, len(texts), 50) for x in recut(texts[k : k + 50], k + 1)]
        want[name] = [(n, h, md5(t)) for n, (t, h) in enumerate(cut)]
    got = {}
    for r in QUERIES["chk12_chunk_sheets"](spark, folder).collect():
        got.setdefault(r.attachment_id, []).append((r.chunk_index, r.section_header, r.text_md5))
    assert {k: sorted(x) for k, x in got.items()} == want


def test_numbering_of_sheets_over_spans(spark):
    rows = [("a", "s", (k * 37) % 901 * 11, [str(k)]) for k in range(901)] + [("b", "s", 5, ["x"]), ("b", "s", 5, ["y"])]
    frame = spark.createDataFrame(rows, "attachment_id string, sheet_name string, row_no long, cells array<string>")
    got = sorted((r.attachment_id, r.n, r.row_no, r.cells) for r in layout._numbered(frame, "row_no", ["cells"], "n", 64).collect())
    assert [(a, r, c) for a, _, r, c in got] == sorted((a, r, c) for a, _, r, c in rows) and [n for a, n, _, _ in got if a == "a"] == list(range(901))


def test_chunks_of_sections(spark, folder):
    sections = {}
    for r in layout.lines_to_sections(layout.mark_headings(views.laid_out_lines(spark, folder))).collect():  # compared with SQL in win05
        sections.setdefault(r.attachment_id, []).append((r.section, r.header, r.text))
    names = {r.attachment_id: r.filename for r in views.attachments(spark, folder).collect()}
    want = {}
    for k, rows in sections.items():
        cut = by_size([(t, h or names[k], False) for _, h, t in sorted(rows, key=lambda x: x[0])])
        want[k] = [(n, h, md5(t)) for n, (t, h, _) in enumerate(cut) if t.strip()]
    got = {}
    for r in QUERIES["chk13_chunk_sections"](spark, folder).collect():
        got.setdefault(r.attachment_id, []).append((r.chunk_index, r.section_header, r.text_md5))
    assert {k: sorted(x) for k, x in got.items()} == want


class Tree(HTMLParser):
    """A page as nested lists, void elements closed at once, nothing else implied."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.root = self.at = ("", [], None)
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = (tag, [], self.at)
        self.at[1].append(node)
        if tag not in ("br", "hr", "img", "input", "link", "meta"):
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node[2] is not None and node[0] != tag:
            node = node[2]
        if node[2] is not None:
            self.at = node[2]

    def handle_data(self, data):
        self.at[1].append(data)

    def handle_comment(self, data):
        self.at[1].append(data)

    def handle_decl(self, decl):
        self.at[1].append(decl.removeprefix("DOCTYPE "))


def said(node):
    if isinstance(node, str):
        return node
    tag, below, _ = node
    inner = "".join(map(said, below))
    if re.fullmatch("h[1-6]", tag):
        return f"\n{'#' * int(tag[1])} {inner.strip()}\n"
    if tag in ("ul", "ol"):
        items = [said(x).strip() for x in below if not isinstance(x, str) and x[0] == "li"]
        return "\n" + "\n".join((f"{k}. " if tag == "ol" else "- ") + x for k, x in enumerate(items, 1)) + "\n"
    return {"p": inner.strip() + "\n", "br": "\n", "li": inner.strip()}.get(tag, inner)


def test_rendered_pages(spark, folder):
    got = {r.page_id: (r.n_chars, r.text_md5) for r in QUERIES["fn07_clean_html"](spark, folder).collect()}
    want = {}
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        text = said(Tree(r.html or "").root).translate(str.maketrans("“”‘’", "\"\"''"))
        text = re.sub(r"\n{3,}", "\n\n", "\n".join(x.rstrip() for x in text.split("\n"))).strip()
        want[r.page_id] = (len(text), md5(text))
    assert got == want


def test_embedded_pools(spark, folder, bodies):
    got, dense = {}, {}
    for r in QUERIES["idx01_embed_pools"](spark, folder).collect():
        assert len(r.dense) == r.dim and len(r.indices) == len(r.values) == r.terms and r.indices == sorted(r.indices)
        got.setdefault(r.chunk_id, {})[r.pool] = (r.dim, dict(zip(r.indices, r.values, strict=True)))
        dense.setdefault(r.pool, set()).add(tuple(r.dense))
    kinds = {"장애대응": "incident", "troubleshooting": "troubleshoot", "faq": "faq", "회의록": "meeting", "adr": "adr"}

    def terms(text):
        return dict(Counter(int(hashlib.sha256(w.encode()).hexdigest()[:8], 16) % 100_000 for w in text.lower().split()))

    want, texts = {}, set()
    for r in views.pages(spark, folder).collect():
        kind = kinds[r.labels[0]] if r.labels else "operation"
        rows = by_size([tuple(d) for d in chunking.body_drafts(r.body_html, kind, is_html=False)])
        for n, (text, header, _) in enumerate(rows):
            ident = hashlib.sha1(f"{r.page_id}:{n}:".encode()).hexdigest()
            label = " ".join(filter(None, [" ".join(r.labels), r.space_key, kind]))
            want[ident] = {"title": (16, terms(f"{r.title} {header}")), "content": (16, terms(text)), "label": (16, terms(label))}
            texts.add(text)
    assert got == want
    # Equal texts share a vector, others do not.
    assert len(dense["content"]) == len(texts)


def test_tokens_by_space(spark, folder):
    kinds = {"장애대응": "incident", "troubleshooting": "troubleshoot", "faq": "faq", "회의록": "meeting", "adr": "adr"}
    want = {}
    for r in views.pages(spark, folder).where("size(allowed_groups) > 0").collect():
        kind = kinds[r.labels[0]] if r.labels else "operation"
        for text, _, _ in by_size([tuple(d) for d in chunking.body_drafts(r.body_html, kind, is_html=False)]):
            chunks, total = want.get((r.space_key, kind), (0, 0))
            want[r.space_key, kind] = (chunks + 1, total + tokens(text))
    got = {(r.space_key, r.doc_type): (r.chunks, r.tokens) for r in QUERIES["flagship_tokens_by_space"](spark, folder).collect()}
    assert got == want
