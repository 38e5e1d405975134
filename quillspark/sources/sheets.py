"""CSV files of any size as cells: one file is read by many tasks, by ranges of its bytes."""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.sources.store import stage

#: Encodings in the order in which they are tried; a file has the first that decodes all of it.
ENCODINGS = ("utf-8-sig", "cp949", "utf-8", "latin-1")
#: Ranges of files whose states are broadcast; each is a path and two numbers.
RANGES = 50_000
_PLACE = ["file", "range"]


def quoted_after(line: bytes, quoted: bool) -> bool:
    """Whether a quoted cell is open at the end of a line, given whether one is at its start.

    A quote opens a cell only as its first character; inside, two are one. What
    follows the closing quote of a cell belongs to it up to the comma.
    """
    at = 0
    while True:
        if not quoted:
            if line[at : at + 1] != b'"':
                comma = line.find(b",", at)
                if comma < 0:
                    return False
                at = comma + 1
                continue
            at, quoted = at + 1, True
        close = line.find(b'"', at)
        if close < 0:
            return True
        if line[close + 1 : close + 2] == b'"':
            at = close + 2
            continue
        quoted, comma = False, line.find(b",", close + 1)
        if comma < 0:
            return False
        at = comma + 1


def _decodes(line: bytes, encoding: str) -> bool:
    try:
        line.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


def _ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each range: where a start outside and inside quotes ends, and which encodings decode it."""
    here, found = None, None

    def row() -> pd.DataFrame:
        return pd.DataFrame([(*here, *found)], columns=[*_PLACE, "plain", "quoted", "utf8", "cp949"])

    for batch in batches:
        for file, start, line in zip(batch.file, batch.range, batch.line, strict=True):
            if (file, start) != here:
                if here is not None:
                    yield row()
                here, found = (file, start), [False, True, True, True]
            line = bytes(line)
            if b'"' in line:
                found[0], found[1] = quoted_after(line, found[0]), quoted_after(line, found[1])
            if not line.isascii():
                found[2], found[3] = found[2] and _decodes(line, "utf-8"), found[3] and _decodes(line, "cp949")
    if here is not None:
        yield row()


def _states(rows: pd.DataFrame) -> pd.DataFrame:
    """The ranges of one file in order: whether each starts inside quotes, and the file's encoding."""
    rows = rows.sort_values("range")
    state, starts = False, []
    for plain, quoted in zip(rows.plain, rows.quoted, strict=True):
        starts.append(state)
        state = bool(quoted if state else plain)
    ok = {"utf-8-sig": rows.utf8.all(), "cp949": rows.cp949.all(), "utf-8": rows.utf8.all(), "latin-1": True}
    return rows[_PLACE].assign(inside=starts, encoding=next(e for e in ENCODINGS if ok[e]))


def _cells(record: str) -> list[str]:
    """Trimmed cells of one record."""
    if '"' not in record:
        return [x.strip() for x in record.split(",")]
    csv.field_size_limit(sys.maxsize)
    return [x.strip() for row in csv.reader(x + "\n" for x in record.split("\n")) for x in row]


_READ = "file string, range long, seq long, cells array<string>, piece string, ends boolean"


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records of each range as rows of cells, and pieces of those that begin or end in another range."""
    here, held, out, seq, headless = None, [], [], 0, False

    def flush() -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=[x.split()[0] for x in _READ.split(", ")])
        out.clear()
        return frame

    def close() -> None:
        if held:  # the record goes on in the next range, or the file ends inside quotes
            out.append((*here, seq, None, "\n".join(held), False))

    for batch in batches:
        for file, start, line, inside, encoding in zip(batch.file, batch.range, batch.line, batch.inside, batch.encoding, strict=True):
            if (file, start) != here:
                close()
                here, held, seq, quoted, headless = (file, start), [], 0, bool(inside), bool(inside)
            line = bytes(line)
            quoted = quoted_after(line, quoted) if b'"' in line else quoted
            text = line.decode("utf-8" if encoding == "utf-8-sig" else encoding)
            if start == 0 and not seq and not held and encoding == "utf-8-sig":
                text = text.removeprefix("﻿")
            held.append(text.removesuffix("\r") if not quoted else text)
            if quoted:
                continue
            record, held = "\n".join(held), []
            if headless:
                out.append((*here, -1, None, record, True))
                headless = False
            elif any(cells := _cells(record)):
                out.append((*here, seq, cells, None, None))
                seq += 1
        if out:
            yield flush()
    close()
    if out:
        yield flush()


def _joined(rows: pd.DataFrame) -> pd.DataFrame:
    """Records of one file that lie in several ranges, from their pieces; each counts where it begins."""
    out, pieces, place = [], [], None
    for start, seq, piece, ends in rows.sort_values(["range", "seq"])[["range", "seq", "piece", "ends"]].itertuples(index=False):
        if not pieces:
            place = (start, seq)
        pieces.append(piece)
        if ends:
            out.append((*place, _cells("\n".join(pieces))))
            pieces = []
    if pieces:
        out.append((*place, _cells("\n".join(pieces))))
    found = pd.DataFrame([x for x in out if any(x[2])], columns=["range", "seq", "cells"])
    return found.assign(file=rows.file.iat[0])[["file", "range", "seq", "cells"]]


def read_csv_cells(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Cells of all CSV files of a folder (or several, or patterns): attachment_id, sheet_name, row_no, cells.

    Cells are text, trimmed, however long; rows without any text are left out
    and ``row_no`` counts the others. A file's id is its path, so that files
    of one name in two folders are two sheets; ``sheet_name`` is its stem.
    A file's encoding is the first of ``ENCODINGS`` that decodes all of it.

    Files are read by ranges of bytes (``spark.sql.files.maxPartitionBytes``),
    cut at line ends. Whether a line end is one of a record depends on the
    quotes before it: a first pass finds for each range where a start outside
    and inside quotes ends, a scan over a file's ranges then gives each its
    start, and a second pass reads the records. Pieces of records that cross
    ranges are joined. One row for each range of a file meets in a task, never
    its cells.
    """
    text = spark.read.format("text").option("lineSep", "\n").option("pathGlobFilter", "*.csv").load(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range")]
    lines = text.select(*place, F.col("value").cast("binary").alias("line"))
    states = lines.mapInPandas(_ranges, "file string, range long, plain boolean, quoted boolean, utf8 boolean, cp949 boolean")
    states = states.groupBy("file").applyInPandas(_states, "file string, range long, inside boolean, encoding string")
    states = stage(states, "ranges")
    if states.limit(RANGES + 1).count() <= RANGES:
        known = lines.join(F.broadcast(states), _PLACE)
    else:
        known = lines.withColumn("order", F.monotonically_increasing_id()).join(states, _PLACE).repartition(*_PLACE).sortWithinPartitions(*_PLACE, "order")
    read = stage(known.select(*_PLACE, "line", "inside", "encoding").mapInPandas(_records, _READ), "records")
    whole = read.where("cells is not null").select(*_PLACE, "seq", "cells")
    joined = read.where("piece is not null").groupBy("file").applyInPandas(_joined, "file string, range long, seq long, cells array<string>")
    rows = whole.unionByName(stage(joined, "joined"))
    counts = rows.groupBy(*_PLACE).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*_PLACE, F.coalesce(before, F.lit(0)).alias("before"))
    stem = F.url_decode(F.regexp_replace(F.regexp_extract("file", r"([^/]*)\.csv$", 1), r"\+", "%2B"))
    return rows.join(counts, _PLACE).select(
        F.col("file").alias("attachment_id"), stem.alias("sheet_name"), (F.col("seq") + F.col("before")).cast("int").alias("row_no"), "cells"
    )
