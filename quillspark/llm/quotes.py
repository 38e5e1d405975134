"""Operator 3: quotation linking of messages into reply-ordered conversations, on DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import stash, unused

#: A line's quote marks: any number of ">", each with spaces around it, or "|" where another mark follows.
_MARKS = r"^(?:\s{0,3}>)+ ?"
#: A line that introduces a quotation.
_INTRO = r"(?i)^\s*(?:on\b.{0,200}\bwrote|am\b.{0,200}\bschrieb\b.{0,80}|le\b.{0,200}\ba écrit|el\b.{0,200}\bescribió)\s*:\s*$"


def normalised(text: Column) -> Column:
    """Text without the differences that quoting makes: case, white space and line breaks."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def with_levels(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``_lines`` (level and content of each line) and ``_runs`` (maximal runs of one level).

    The level is the number of quote marks at a line's start. All within one
    row: no line ever leaves its message.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.transform(
        F.split(text, r"\r?\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(line, _MARKS, "").alias("text"),
        ),
    )
    starts = F.filter(
        F.sequence(F.lit(0), F.size("_lines") - 1),
        lambda i: (i == 0) | (F.get("_lines", i)["level"] != F.get("_lines", i - 1)["level"]),
    )
    runs = F.transform(
        "_starts",
        lambda start, k: F.struct(
            F.get("_lines", start)["level"].alias("level"),
            F.array_join(
                F.slice("_lines", start + 1, F.coalesce(F.get("_starts", k + 1), F.size("_lines")) - start)["text"], "\n"
            ).alias("text"),
        ),
    )
    return messages.withColumn("_lines", lines).withColumn("_starts", starts).withColumn("_runs", runs).drop("_starts")


def own_text() -> Column:
    """What a message says itself: its unquoted lines without lines that introduce a quotation, trimmed."""
    own = F.filter("_lines", lambda line: (line["level"] == 0) & ~line["text"].rlike(_INTRO))
    return F.trim(F.regexp_replace(F.array_join(own["text"], "\n"), r"\n\s*\n\s*\n+", "\n\n"), F.lit(" \n\r\t"))


def _digest(text: Column) -> Column:
    return F.substring(F.sha2(normalised(text), 256), 1, 32)


def link_quotes(
    messages: DataFrame,
    *,
    id_col: str = "message_id",
    order_col: str = "sent",
    scope_col: str | None = None,
    text_col: str = "text",
) -> DataFrame:
    """Each message with what it says itself and the message that it replies to.

    Quote levels are parsed, and each run of lines of one level is a passage.
    A passage and each of its lines are normalised and hashed, and joined to
    the earliest message of the scope that says them itself, whole or as a
    line. Of a message's passages the shallowest with a match decides, whole
    passages before lines, then the match with most characters, then the
    latest message. Only earlier messages (by ``order_col``, then id) can be
    replied to, so that links never form a circle.

    Returns one row per message: the scope (null without ``scope_col``), the
    id and order columns, ``own_text``, ``quote_levels`` (deepest level),
    ``parent_id`` and ``parent_level`` (null for a message that opens a
    conversation).

    Each hash has one owner before the join, so a text that very many messages
    share joins once per quoting passage, never with all of them. Defined
    cases: null and empty texts quote nothing and say nothing; a quotation of
    a message that is not in the table links nothing, but deeper levels may;
    rows with a null id or order are left out; repeated ids keep the first row
    by order and text; other columns are ignored; an empty table gives an
    empty result.
    """
    scope = F.lit(None).cast("string") if scope_col is None else F.col(scope_col)
    base = messages.select(
        scope.alias("scope"), F.col(id_col).alias("id"), F.col(order_col).alias("sent"), F.col(text_col).cast("string").alias("text")
    ).where("id is not null and sent is not null")
    base = base.groupBy("scope", "id").agg(F.min(F.struct("sent", "text")).alias("row")).select("scope", "id", "row.sent", "row.text")
    parsed = with_levels(base).withColumn("own_text", own_text())
    parsed = parsed.withColumn("quote_levels", F.coalesce(F.array_max(F.transform("_lines", lambda x: x["level"])), F.lit(0)))
    parsed = stash(parsed.select("scope", "id", "sent", "own_text", "quote_levels", F.filter("_runs", lambda r: r["level"] > 0).alias("quoted")), "parsed")
    place = F.coalesce(F.col("scope").cast("string"), F.lit("\0")).alias("place")

    said = parsed.where("own_text <> ''").select(
        place, "sent", "id",
        F.explode(F.array_distinct(F.concat(F.array("own_text"), F.split("own_text", "\n")))).alias("said"),
    )
    said = said.withColumn("hash", _digest(F.col("said"))).where(normalised(F.col("said")) != "")
    owners = said.groupBy("place", "hash").agg(F.min(F.struct("sent", "id")).alias("owner"))

    asks = parsed.where(F.size("quoted") > 0).select("scope", place, "id", "sent", F.posexplode("quoted").alias("at", "run"))
    whole = asks.select("scope", "place", "id", "sent", "at", "run.level", F.lit(0).alias("part"), F.col("run.text").alias("said"))
    parts = asks.select("scope", "place", "id", "sent", "at", "run.level", F.lit(1).alias("part"), F.explode(F.split("run.text", "\n")).alias("said"))
    asked = whole.unionByName(parts).withColumn("said", normalised(F.col("said"))).where("said <> ''")
    asked = asked.withColumn("hash", _digest(F.col("said"))).withColumn("size", F.length("said")).drop("said")
    met = asked.join(owners, ["place", "hash"]).where(F.col("owner") < F.struct("sent", "id"))
    votes = met.groupBy("scope", "id", "level", "part", "owner").agg(F.sum("size").alias("size"))
    rank = F.struct((-F.col("level")).alias("a"), (-F.col("part")).alias("b"), "size", "owner")
    best = votes.groupBy("scope", "id").agg(F.max(rank).alias("best"))
    best = best.select(
        F.col("scope").alias("_scope"), F.col("id").alias("_id"), F.col("best.owner.id").alias("parent_id"), (-F.col("best.a")).alias("parent_level")
    )
    joined = parsed.join(best, parsed["scope"].eqNullSafe(F.col("_scope")) & (parsed["id"] == F.col("_id")), "left")
    return joined.select("scope", F.col("id").alias(id_col), F.col("sent").alias(order_col), "own_text", "quote_levels", "parent_id", "parent_level")


def numbered(frame: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: each row's place in its group, from 0, in an order of any types (nulls first).

    Rows are sorted by range over groups and order together, so that a group of
    any size is spread over tasks; a row's place is its place in its own range
    and the number of the group's rows in the ranges before. Groups may be null.
    Equal rows take places in any order.
    """
    part, line, first, many, *keys = unused(frame, "part", "line", "first", "many", *(f"key{k}" for k in range(len(groups) + 1)))
    spread = frame.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order)
    # Written with its ranges, which another computation might cut elsewhere.
    spread = stash(spread.withColumn(part, F.spark_partition_id()).withColumn(line, F.monotonically_increasing_id()), "numbered")
    runs = spread.groupBy(*groups, part).agg(F.min(line).alias(first), F.count("*").alias(many))
    before = F.sum(many).over(Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(*(F.col(c).alias(k) for c, k in zip([*groups, part], keys, strict=True)), (F.coalesce(before, F.lit(0)) - F.col(first)).alias(many))
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip([*groups, part], keys, strict=True)]
    return spread.join(runs, same).withColumn(name, F.col(line) + F.col(many)).select(*frame.columns, name)


def reply_order(links: DataFrame, *, id_col: str = "message_id", order_col: str = "sent") -> DataFrame:
    """Conversations of linked messages: adds ``root_id``, ``depth`` and ``position``.

    A conversation is a tree of replies; its root replies to nothing. Depths
    come from pointer doubling: each round joins a message to the ancestor
    that it points at and doubles the step, and messages that have reached
    their root take no part in later rounds. ``position`` counts from 0 by
    depth, then order (of any type), then id: every reply comes after what it
    answers. A conversation of any size is numbered in parts (``numbered``).

    ``links`` has one row per message, as ``link_quotes`` returns it: scopes may
    be null, ids and orders not. A parent that is no message of the scope is
    none, so its replies open conversations. An empty table gives an empty
    result.
    """
    links = stash(links, "links")
    known = links.select(F.col("scope").alias("s"), F.col(id_col).alias("i"))
    todo = links.select("scope", F.col(id_col).alias("id"), F.col("parent_id").alias("parent"))
    todo = todo.join(known, todo["scope"].eqNullSafe(F.col("s")) & (F.col("parent") == F.col("i")), "left")
    todo = stash(todo.select("scope", "id", F.col("i").alias("up")), "parents")
    keys = ["scope", "id"]
    ends = todo.where("up is null").select(*keys, F.col("id").alias("root_id"), F.lit(0).cast("long").alias("depth"))
    open_ = todo.where("up is not null").select(*keys, "up", F.lit(1).cast("long").alias("step"))
    while not open_.isEmpty():
        at = ends.select(F.col("scope").alias("s"), F.col("id").alias("i"), "root_id", "depth")
        jump = open_.select(F.col("scope").alias("s2"), F.col("id").alias("i2"), F.col("up").alias("up2"), F.col("step").alias("step2"))
        a = open_.join(at, open_["scope"].eqNullSafe(F.col("s")) & (F.col("up") == F.col("i")), "left")
        a = a.join(jump, a["scope"].eqNullSafe(F.col("s2")) & (F.col("up") == F.col("i2")), "left")
        a = stash(
            a.select(
                *keys, "root_id", (F.col("depth") + F.col("step")).alias("depth"),
                F.col("up2").alias("up"), (F.col("step") + F.col("step2")).alias("step"),
            ),
            "doubled",
        )
        ends = ends.unionByName(a.where("root_id is not null").select(*keys, "root_id", "depth"))
        open_ = a.where("root_id is null").select(*keys, "up", "step")
    ends = ends.select(F.col("scope").alias("_scope"), F.col("id").alias("_id"), "root_id", "depth")
    placed = links.join(ends, links["scope"].eqNullSafe(F.col("_scope")) & (links[id_col] == F.col("_id"))).drop("_scope", "_id")
    return numbered(stash(placed, "placed"), ["scope", "root_id"], ["depth", order_col, id_col], "position")


def as_mail(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", bucket: int = 4096) -> DataFrame:
    """Turns as mails: each quotes the turn before it, and that turn's own quotation one level deeper.

    Returns ``scope``, ``message_id`` (the turn), ``sent`` and ``text``; what a
    mail replies to is only in its text. Turns are numbered by turn and text,
    and each ``bucket`` of them meets the two before it, so a conversation of
    any length is dealt over tasks.

    Defined cases: null conversations form one; rows with a null turn have no
    place and are left out; null texts are empty; of equal turns the one with
    the smaller text comes first, and equal rows quote one another. Other
    columns are ignored; an empty table gives an empty result.
    """
    turns = turns.select(F.col(conv_col).alias("scope"), F.col(turn_col).alias("sent"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = numbered(turns.where("sent is not null"), ["scope"], ["sent", "text"], "at")
    own = F.floor(F.col("at") / bucket)
    rows = rows.withColumn("bucket", F.explode(F.when(F.col("at") % bucket >= bucket - 2, F.array(own, own + 1)).otherwise(F.array(own))))
    order = Window.partitionBy("scope", "bucket").orderBy("at")
    quote = lambda text, mark: F.concat(F.lit(mark), F.regexp_replace(text, "\n", "\n" + mark))
    rows = rows.withColumn("last", F.lag("text", 1).over(order)).withColumn("older", F.lag("text", 2).over(order)).where(own == F.col("bucket"))
    return rows.select(
        "scope", F.col("sent").alias("message_id"), "sent",
        F.concat_ws("\n", F.when(F.col("older").isNotNull(), quote(F.col("older"), ">> ")), F.when(F.col("last").isNotNull(), quote(F.col("last"), "> ")), "text").alias("text"),
    )
