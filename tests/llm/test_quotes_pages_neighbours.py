"""Operators 3, 5 and 6."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm.html_blocks import extract_main_text, main_text
from quillspark.llm.nearest import chi_square_below, chi_square_reach, nearest_neighbours
from quillspark.llm.quotes import link_quotes, reply_order


def thread(spark, rows):
    return spark.createDataFrame(rows, "message_id long, sent long, text string, scope string, place string")


def test_nested_quotes_make_a_tree(spark):
    first = "Shall we meet on Monday?\nThe room is free."
    rows = [
        (1, 10, first, "a", "x"),
        (2, 20, "> Shall we meet on  MONDAY?\n> The room is free.\nYes, at nine.", "a", "x"),
        (3, 30, "On Tuesday someone wrote:\n>> Shall we meet on Monday?\n>> The room is free.\n> Yes, at nine.\nFine.", "a", "x"),
        (4, 40, "> The room is free.\nWhich room?", "a", "x"),
        (5, 50, "> a mail that nobody has\n> > Yes, at nine.\nOK then.", "a", "x"),
        (6, 60, "> Shall we meet on Monday?\n> The room is free.\nNo.", "b", "x"),
        (7, 5, "> Fine.\nearlier than what it quotes", "a", "x"),
        (8, 70, None, "a", "x"), (9, 80, "", "a", "x"), (9, 80, "", "a", "x"), (None, 1, "x", "a", "x"), (10, None, "x", "a", "x"),
    ]
    links = link_quotes(thread(spark, rows), scope_col="scope")
    found = {r.message_id: r for r in reply_order(links).collect()}
    assert {k: r.parent_id for k, r in found.items()} == {1: None, 2: 1, 3: 2, 4: 1, 5: 2, 6: None, 7: None, 8: None, 9: None}
    assert found[3].own_text == "Fine." and found[3].quote_levels == 2 and found[5].parent_level == 2
    order = sorted((r.position, k) for k, r in found.items() if r.root_id == 1)
    assert order == [(0, 1), (1, 2), (2, 4), (3, 3), (4, 5)]
    assert found[3].depth == 2
    everywhere = {r.message_id: r.parent_id for r in link_quotes(thread(spark, rows)).collect()}
    assert everywhere[6] == 1


def test_long_chains_and_hot_roots(spark):
    rows = [(0, 0, "start", "a", "x")]
    rows += [(k, k, f"> {'start' if k == 1 else f'say {k - 1}'}\nsay {k}", "a", "x") for k in range(1, 40)]
    rows += [(k, k, f"> start\nanswer {k}", "a", "x") for k in range(100, 160)]
    found = {r.message_id: r for r in reply_order(link_quotes(thread(spark, rows), scope_col="scope")).collect()}
    assert found[39].depth == 39 and all(found[k].depth == 1 for k in range(100, 160))
    assert sorted(r.position for r in found.values()) == list(range(100))
    assert all(found[r.parent_id].position < r.position for r in found.values() if r.parent_id is not None)
    assert reply_order(link_quotes(thread(spark, []))).count() == 0


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("<nav><p>only a menu</p></nav>", ""),
        ("<article><h1>A</h1><p>b &amp; c&#33;<p>d\n  e<br>f</article><footer>x</footer>", "A\n\nb & c!\n\nd e f"),
        ("<main><p>one<script>var a='</p>';</script></p><!-- <p>no</p> --><aside>side</aside><p>two</main>", "one\n\ntwo"),
        ('<article><header><h1>Title</h1></header><p>Body.</p><section class="comments"><article><p>me too</p></article></section></article>', "Title\n\nBody."),
        ('<article><div class="entry-header"><h2>Head</h2></div><div id="cookie-notice">Accept</div><form><p>mail</p></form>text</article>', "Head\n\ntext"),
        ('<body class="has-sidebar"><article><p>kept<b>bold</b></p><div class="sidebar">x</div></article>', "keptbold"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one\n\ntwo\n\na\n\nb"),
        ("<article><p>unclosed <b>tag", "unclosed tag"), ("<article><p>a < b and c > d</p></article>", "a < b and c > d"),
        ("<article><p>" + "word " * 20_000 + "</article>", ("word " * 20_000).strip()),
    ],
)
def test_main_text(html, text):
    assert main_text(html) == text


def test_blocks_without_an_article_element():
    good = "It was the best of times and it was the worst of times, as the old story has it, and so we go on with what we have in hand. " * 2
    page = f"<div>Short lead</div><p>{good}</p><p>Also short.</p><p>{good}</p><ul><li><a href=x>link one</a><li><a href=y>link two</a></ul><p>End</p>"
    kept = main_text(page).split("\n\n")
    assert kept == ["Short lead", good.strip(), "Also short.", good.strip()]


def test_pages_whole_table(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").withColumn("text", F.lit("clash")).withColumn("_html", F.lit(1))
    out = extract_main_text(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    rows = out.collect()
    assert len(rows) == pages.count() and all(r.n_chars == len(r.text) > 0 for r in rows)
    assert extract_main_text(pages.limit(0)).count() == 0


def exact(rows, asks, k):
    good = {i: np.array(v, dtype=float) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in filter(asks, good):
        ranked = sorted(((-(float((good[q] * v).sum())), i) for i, v in good.items() if i != q and len(v) == len(good[q])))[:k]
        out[q] = [i for _, i in ranked]
    return out


def test_neighbours_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = exact(rows, lambda i: i % 20 == 0, 20)
    got = {}
    for r in nearest_neighbours(frame, F.col("vec_id") % 20 == 0, block_rows=400, query_rows=8).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.95


def test_neighbour_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [5.0, 1.0]), (2, [-1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, []), (9, [1.0, 0.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (None, [1.0, 1.0]), (11, [1.0, 2.0, 3.0]), (20, [0.5, 9.0]),
    ]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, score int")
    got = nearest_neighbours(frame, F.col("vec_id") % 10 == 0, k=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [
        (0, 1, 1, 5.0), (0, 2, 9, 1.0), (0, 3, 10, 1.0), (10, 1, 1, 5.0), (10, 2, 0, 1.0), (10, 3, 9, 1.0), (20, 1, 1, 11.5), (20, 2, 0, 0.5), (20, 3, 9, 0.5),
    ]
    assert len(nearest_neighbours(frame.where("vec_id < 3"), F.col("vec_id") == 0, k=20).collect()) == 2
    assert nearest_neighbours(frame.limit(0), F.lit(True)).collect() == []


def test_chi_square():
    assert abs(chi_square_below(np.array([23.54]), 16)[0] - 0.9) < 1e-3
    assert abs(chi_square_reach(0.95, 8) - 15.507) < 1e-2
