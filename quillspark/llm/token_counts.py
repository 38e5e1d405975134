"""Operator 8: token counts by a separator scan over flat token files."""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import lookup, new_path, stash

#: Fixed values of the byte-level vocabulary of 50,257 ids: how texts are cut before merging, and its separator.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATOR = 50256
#: Characters encoded at a time; a longer text is cut where a word starts.
PIECE = 1 << 16


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a bare path is local."""
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces that encode to the same ids as the whole: cut before a space between two letters."""
    start = 0
    while len(text) - start > PIECE:
        at = start + PIECE
        while at < len(text) - 1 and not (text[at] == " " and text[at - 1].isalpha() and text[at + 1].isalpha()):
            at += 1
        if at >= len(text) - 1:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def write_token_files(
    docs: DataFrame,
    folder: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_file: str = "/opt/tokenizers/byte_bpe_50k.tiktoken",
    separator: int = SEPARATOR,
) -> DataFrame:
    """Encode whole texts into flat files of 16-bit ids, each text followed by the separator.

    One file per partition, without header or index. Each attempt of a task
    writes a file of its own; the rows returned (``file``, ``ordinal`` from 0
    and the id column: which document is in which place) name only the files of
    the attempts that Spark took, so what a lost or speculative attempt left
    behind is in no row, and joins with nothing.

    Texts that spell the separator are ordinary text. Null and empty texts are
    documents without tokens.
    """
    spark = docs.sparkSession
    with open(ranks_file, "rb") as lines:  # a vocabulary file on the driver, of fixed size
        ranks = spark.sparkContext.broadcast({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    fs, path = _open(folder)
    fs.create_dir(path, recursive=True)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoder = tiktoken.Encoding("flat", pat_str=CUT, mergeable_ranks=ranks.value, special_tokens={})
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"  # of this attempt alone
        fs, path = _open(folder)
        ordinal = 0
        with fs.open_output_stream(f"{path}/{name}") as out:
            for batch in batches:
                for text in batch.column("text"):
                    for piece in _pieces(text.as_py() or ""):
                        out.write(np.array(encoder.encode_ordinary(piece), dtype="<u2").tobytes())
                    out.write(np.array([separator], dtype="<u2").tobytes())
                count = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * count), pa.array(range(ordinal, ordinal + count), pa.int64()), batch.column("id")],
                    ["file", "ordinal", "id"],
                )
                ordinal += count

    return stash(texts.mapInArrow(each, "file string, ordinal long, id long"), "manifest").withColumnRenamed("id", id_col)


def scan_token_files(
    spark: SparkSession, folder: str, *, separator: int = SEPARATOR, width: int = 2, block_bytes: int = 1 << 22, glob: str = "*.bin"
) -> DataFrame:
    """Documents of flat token files: ``file``, ``ordinal``, ``start`` (token), ``n_tokens`` and ``terminated``.

    Files are cut into blocks of ``block_bytes``, whatever their size; each
    task reads a block and finds its separators at once with numpy. A prefix
    scan over the blocks of a file (running count and last position of
    separators) then says with which ordinal and at which token a block's
    first document starts, so that documents may span any number of blocks.

    ``width`` is the bytes of an id (1, 2, 4 or 8, little-endian). Two
    separators in a row enclose a document of no tokens; tokens after the last
    separator are a document that is not terminated; an empty file has none.
    Bytes beyond a file's last whole id are not read. The folder's listing
    comes from Spark and the bytes from the same file system, of which the
    workers read single ranges.
    """
    if block_bytes % width:
        raise ValueError("a block holds whole ids")
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", "length")
    sized = files.select("path", F.floor(F.col("length") / width).alias("tokens")).where("tokens > 0")
    per = block_bytes // width
    blocks = sized.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / per))))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path, block, tokens in zip(batch.path, batch.block, batch.tokens, strict=True):
                fs, name = _open(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
                first, last = block * per, min((block + 1) * per, tokens)
                with fs.open_input_file(name) as data:
                    ids = np.frombuffer(data.read_at((last - first) * width, first * width), dtype=f"<u{width}")
                found.append(np.flatnonzero(ids == separator).astype(np.int64) + first)
            yield batch.assign(ends=found)

    wide = blocks.repartition("path", "block").mapInPandas(each, "path string, tokens long, block long, ends array<long>")
    wide = stash(wide, "separators")
    count = F.size("ends").cast("long")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scan = wide.select("path", "block", count.alias("n"), F.element_at("ends", F.when(count > 0, F.lit(-1))).alias("last"))
    scan = scan.select(
        "path", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ordinals"),
        F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(-1)).alias("carried"),
    )
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    ends = wide.where(count > 0).join(scan, ["path", "block"])
    ends = ends.select(
        "path", "ordinals", F.posexplode("ends").alias("k", "end"), F.concat(F.array("carried"), F.col("ends")).alias("starts")
    )
    closed = ends.select(
        name, (F.col("ordinals") + F.col("k")).alias("ordinal"), (F.get("starts", F.col("k")) + 1).alias("start"),
        (F.col("end") - F.get("starts", F.col("k")) - 1).alias("n_tokens"), F.lit(True).alias("terminated"),
    )
    final = wide.groupBy("path").agg(
        F.max("tokens").alias("tokens"), F.sum(count).alias("ordinal"), F.coalesce(F.max(F.array_max("ends")), F.lit(-1)).alias("last")
    )
    rest = F.col("tokens") - F.col("last") - 1
    tail = final.where(rest > 0).select(name, "ordinal", (F.col("last") + 1).alias("start"), rest.alias("n_tokens"), F.lit(False).alias("terminated"))
    return closed.unionByName(tail)


def count_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, **options) -> DataFrame:
    """Tokens of every document, counted in flat token files that are written first.

    Returns one row per input row: the id column and ``n_tokens``. Files go to
    ``folder`` (a new one in the shared folder by default). Null and empty
    texts have 0 tokens; rows with null or repeated ids are counted one by one;
    other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    manifest = write_token_files(docs, folder, id_col=id_col, text_col=text_col, **options)
    found = scan_token_files(spark, folder)
    return lookup(manifest, found.select("file", "ordinal", "n_tokens"), ["file", "ordinal"], rows=0).select(id_col, "n_tokens")
