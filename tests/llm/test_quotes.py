"""Operator 3 against a plain linker, with odd turns, long chains and forged quotations."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillspark.llm.quotes import as_mail, link_quotes, numbered, reply_order

SCHEMA = "message_id long, sent long, text string, scope string, own_text string, root_id string"


def plain(text):
    return re.sub(r"\s+", " ", text.lower()).strip()


def parse(text):
    """(own text, runs of quoted lines as (level, text), deepest level)."""
    own, runs, last = [], [], None
    for line in re.split(r"\r?\n", text or ""):
        mark = re.match(r"(?:\s{0,3}>)+ ?", line)
        level, rest = (mark[0].count(">"), line[mark.end() :]) if mark else (0, line)
        if level != last:
            runs.append((level, []))
        runs[-1][1].append(rest)
        last = level
        if level == 0 and not re.match(r"(?i)\s*on\b.{0,200}\bwrote\s*:\s*$", rest):
            own.append(rest)
    own = re.sub(r"\n\s*\n\s*\n+", "\n\n", "\n".join(own)).strip(" \n\r\t")
    return own, [(level, "\n".join(lines)) for level, lines in runs if level], max(level for level, _ in runs)


def linked(rows):
    """{(scope, id): (parent, root, depth, position)} by loops over all messages."""
    seen = {}
    for i, sent, text, scope in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[1], r[2] is not None, r[2] or "")):
        seen.setdefault((scope, i), (sent, *parse(text)))
    owner = {}
    for (scope, i), (sent, own, _, _) in seen.items():
        for said in {plain(x) for x in [own, *own.split("\n")]} - {""} if own else ():
            owner[scope, said] = min(owner.get((scope, said), (sent, i)), (sent, i))
    parents = {}
    for (scope, i), (sent, _, runs, _) in seen.items():
        votes = {}
        for level, text in runs:
            for part, said in [(0, plain(text)), *((1, plain(x)) for x in text.split("\n"))]:
                if said and (found := owner.get((scope, said))) and found < (sent, i):
                    votes[level, part, found] = votes.get((level, part, found), 0) + len(said)
        best = max(((-level, -part, size, found) for (level, part, found), size in votes.items()), default=None)
        parents[scope, i] = best and best[3][1]
    out, depth = {}, {}
    for key in sorted(seen, key=lambda k: (seen[k][0], k[1])):
        up = parents[key]
        depth[key] = (key[1], 0) if up is None else (depth[key[0], up][0], depth[key[0], up][1] + 1)
    trees = {}
    for key in seen:
        trees.setdefault((key[0], depth[key][0]), []).append((depth[key][1], seen[key][0], key[1], key))
    for members in trees.values():
        for place, (*_, key) in enumerate(sorted(members, key=lambda m: m[:3])):
            out[key] = (parents[key], *depth[key], place)
    return out


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    links = link_quotes(frame, scope_col="scope", **options)
    return {(r.scope, r.message_id): (r.parent_id, r.root_id, r.depth, r.position) for r in reply_order(links).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_linker(spark, seed):
    draw = random.Random(seed)
    words = [f"word{k}" for k in range(30)]
    rows, said = [], []
    for k in range(160):
        own = "\n".join(" ".join(draw.choices(words, k=draw.randint(1, 5))) for _ in range(draw.randint(1, 3)))
        lines = []
        for level in range(draw.randint(0, 3), 0, -1):
            # Quotes of earlier, later and unknown messages, some of a single line, some with other spaces and case.
            text = draw.choice(said) if said and draw.random() < 0.8 else "nobody said this"
            if draw.random() < 0.3:
                text = draw.choice(text.split("\n"))
            if draw.random() < 0.3:
                text = text.upper().replace(" ", "  ")
            lines += [draw.choice([">" * level, "> " * level, " >" * level]) + " " + x for x in text.split("\n")]
        text = "\n".join([*lines, *(["On Monday somebody wrote:"] if draw.random() < 0.2 else []), own])
        rows.append((k, draw.choice([k, k // 4, 100 - k]), text, draw.choice(["a", "b", None])))
        said.append(own)
    rows += [(5, 500, "again", rows[5][3]), (7, 3, None, "b"), (None, 1, "x", "a"), (300, None, "x", "a"), (301, 4, "", "a"), (301, 4, "", "a")]
    assert found(spark, rows) == linked(rows)


def test_forged_quotations_make_no_circle(spark):
    rows = [(1, 10, "> two\none", "a"), (2, 20, "> one\ntwo", "a"), (3, 20, "> three\nthree", "a"), (4, 30, "> two\n> one\nfour", "a"), (5, 40, ">>> four\n> never said\nfive", "a")]
    got = found(spark, rows)
    assert got == linked(rows) and got["a", 1][0] is None and got["a", 3][0] is None and got["a", 5][0] == 4


def test_long_chain(spark):
    turns = spark.range(10_000).select(F.lit("c").alias("conv_id"), F.col("id").alias("turn"), F.concat(F.lit("say "), "id").alias("text"))
    mails = as_mail(turns, bucket=64)
    got = reply_order(link_quotes(mails, scope_col="scope"))
    assert got.where("depth = message_id and position = message_id and root_id = 0 and (parent_id = message_id - 1 or message_id = 0)").count() == 10_000


def test_long_message(spark):
    body = "\n".join(f"line {k}" for k in range(20_000))
    got = found(spark, [(1, 1, body, "a"), (2, 2, "> " + body.replace("\n", "\n> ") + "\nyes", "a"), (3, 3, "> line 19999\nno", "a")])
    assert got["a", 2][:2] == (1, 1) and got["a", 3][:2] == (1, 1)


def test_mails_of_odd_turns(spark):
    rows = [("c", 2, "two"), ("c", 1, "one"), ("c", 3, None), ("c", 4, "b"), ("c", 4, "a"), ("c", 4, "a"), ("c", None, "lost"), (None, 1, "null"), (None, 2, "more")]
    frame = spark.createDataFrame(rows, "conv_id string, turn int, text string").withColumn("at", F.lit(1)).withColumn("bucket", F.lit(1))
    for bucket in (3, 4096):
        got = sorted(((r.scope or "", r.message_id, r.text) for r in as_mail(frame, bucket=bucket).collect()))
        assert got == sorted([
            ("", 1, "null"), ("", 2, "> null\nmore"), ("c", 1, "one"), ("c", 2, "> one\ntwo"), ("c", 3, ">> one\n> two\n"),
            ("c", 4, ">> two\n> \na"), ("c", 4, ">> \n> a\na"), ("c", 4, ">> a\n> a\nb"),
        ])
    assert as_mail(frame.limit(0)).count() == 0


def test_orders_of_other_types(spark):
    rows = [(1, 10, "one", "a"), (2, 20, "> one\ntwo", "a"), (3, 30, "> one\nthree", "a")]
    frame = spark.createDataFrame(rows, "message_id long, sent long, text string, scope string")
    for order in (F.col("sent").cast("string"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("sent").cast("int")), F.timestamp_seconds("sent")):
        got = reply_order(link_quotes(frame.withColumn("sent", order), scope_col="scope"))
        assert {r.message_id: r.position for r in got.collect()} == {1: 0, 2: 1, 3: 2}


def test_numbers_of_rows(spark):
    frame = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.when(F.col("id") % 2 == 0, (F.col("id") % 7).cast("string"))).alias("part"), F.md5(F.col("id").cast("string")).alias("line"))
    got = {}
    for r in numbered(frame, ["part"], ["line"], "n").collect():
        got.setdefault(r.part, []).append((r.line, r.n))
    assert sum(map(len, got.values())) == 3000 and None in got
    assert all([n for _, n in sorted(rows)] == list(range(len(rows))) for rows in got.values())
