"""Operator 12: phrase collocations from count streams in prefix and suffix order."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import stash
from quillspark.llm.quotes import numbered
from quillspark.llm.shingles import mix

#: Bytes of text of one language that a task counts at once, before counts are added up (memory only).
CHUNK = 1 << 23
#: Bits of the filter that is broadcast (8 MB), as a power of two.
FILTER_BITS = 26
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: A tab counts as a space, and what ends a piece as a line's end.
_PLAIN = bytes.maketrans(b"\t.,;:!?\x0b\x0c\r", b" " + b"\n" * 9)
_GAP = re.compile(rb"[ \t.,;:!?\n-\r]")


def tokens_of(data: bytes) -> list[bytes]:
    """Words, and a line's end for what ends a piece."""
    return [x for x in data.translate(_PLAIN).replace(b"\n", b" \n ").split(b" ") if x]


class Filter:
    """A set of phrases as bits: never denies a phrase that was added, and takes the same memory for any number of them."""

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8) if bits is None else bits

    @staticmethod
    def word_hashes(words: list[bytes]) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)

    @staticmethod
    def joined(before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Hash of phrases one word longer; a word alone is joined to 0."""
        return mix(before * _FACTOR + word)

    @staticmethod
    def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint64(64 - FILTER_BITS)
        return (hashes >> shift).astype(np.int64), (mix(hashes + _FACTOR) >> shift).astype(np.int64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        one, two = (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 for at in self.places(hashes))
        return (one & two).astype(bool)


def phrase_counts(data: bytes, longest: int, head: list[bytes] = (), known: Filter | None = None) -> tuple[int, list[tuple[pa.Array, np.ndarray]], list[bytes]]:
    """Counts of the phrases of a lower-cased text: (words, (phrases, counts) by length, last tokens).

    Lengths go from 1 to ``longest``; with ``known``, only ``longest`` itself
    is counted, and only phrases that hold two shorter ones of that filter.
    ``head`` holds the tokens before the text; phrases that end in it count
    for nothing, so a text may be counted piece by piece.
    """
    tokens = [*head, *tokens_of(data)]
    codes, kinds = pd.factorize(np.array(tokens, dtype=object))
    tail = tokens[-(longest - 1) :] if longest > 1 else []
    if not len(codes):
        return 0, [], []
    words = pa.array(kinds, pa.binary()).cast(pa.string())
    codes = np.where((kinds == b"\n")[codes], -1, codes)
    late, count, out = np.arange(len(codes)) >= len(head), len(kinds), []
    may = np.ones(max(0, len(codes) - longest + 1), dtype=bool)
    if known is not None and len(may):
        hashed, part = Filter.word_hashes(kinds)[codes], np.zeros(len(codes), dtype=np.uint64)
        for k in range(longest - 1):
            part = Filter.joined(part[: len(codes) - k], hashed[k:])[: len(codes) - k]
            part = part[:-1] if k < longest - 2 else part
        held = known.holds(part)
        may = held[: len(may)] & held[1 : len(may) + 1]
    ids, columns = codes, np.arange(count)[:, None]
    for length in range(1, longest + 1):
        last = late[length - 1 :]
        if length == 1:
            seen = np.bincount(codes[(codes >= 0) & last], minlength=count)
        else:
            if len(ids) < 2:
                break
            joined = (ids[:-1] >= 0) & (codes[length - 1 :] >= 0)
            if known is not None:  # a place goes on only if the whole phrase that starts there may count
                joined[: len(may)] &= may[: len(joined)]
                joined[len(may) :] = False
            keys = ids[:-1] * count + codes[length - 1 :]
            if length == longest:
                keys, seen = np.unique(keys[joined & last], return_counts=True)
            else:
                keys, held = np.unique(keys[joined], return_inverse=True)
                ids = np.full(len(joined), -1)
                ids[joined] = held
                seen = np.bincount(ids[(ids >= 0) & last], minlength=len(keys))
            columns = np.column_stack([columns[keys // count], keys % count])
        if known is None or length == longest:
            some = np.flatnonzero(seen)
            parts = [words.take(pa.array(columns[some, k])) for k in range(length)]
            out.append((pc.binary_join_element_wise(*parts, " ") if length > 1 else parts[0], seen[some]))
    return int((late & (codes >= 0)).sum()), out, tail


def _counted(texts: DataFrame, longest: int, bits: Broadcast | None = None) -> DataFrame:
    """(lang, phrase, n) of phrases in parts of the texts, and for each part a row of its words with the phrase ''.

    With the bits of a filter only phrases of the full length are counted, and no words.
    """
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

    def rows(lang: str, words: int, found: list[tuple[pa.Array, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for phrases, counts in found if bits else [(pa.array([""]), np.array([words])), *found]:
            for start in range(0, len(counts), 1 << 17):
                part = phrases[start : start + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), part, pa.array(counts[start : start + len(part)], pa.int64())], schema=schema)

    def whole(lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        head, start, known = [], 0, Filter(bits.value) if bits else None
        while start < len(text):
            gap = _GAP.search(text, start + CHUNK)  # a word longer than a chunk stays whole
            end = gap.start() if gap else len(text)
            words, found, head = phrase_counts(text[start:end], longest, head, known)
            yield from rows(lang, words, found)
            start = end

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text").cast(pa.binary()), strict=True):
                lang, text = lang.as_py(), text.as_py().lower()  # bytes: A-Z only
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= CHUNK:
                    for key, some in held.items():
                        yield from whole(key, b"\n".join(some))  # a line's end ends a piece
                    held, size = {}, 0
        for key, some in held.items():
            yield from whole(key, b"\n".join(some))

    return texts.mapInArrow(each, "lang string, phrase string, n long")


def _filter_bits(frequent: DataFrame, length: int) -> Broadcast:
    """The filter of the frequent phrases of a length: ``2 ** FILTER_BITS`` bits in all, in 1,024 pieces."""
    piece = FILTER_BITS - 10

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = [x.as_py().split(b" ") for x in batch.column("phrase").cast(pa.binary())]
            hashes = np.zeros(len(phrases), dtype=np.uint64)
            for k in range(length):
                hashes = Filter.joined(hashes, Filter.word_hashes([x[k] for x in phrases]))
            at = np.concatenate(Filter.places(hashes))
            yield pa.RecordBatch.from_arrays([pa.array(at >> piece, pa.int64()), pa.array(at & ((1 << piece) - 1), pa.int64())], ["piece", "at"])

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << piece, dtype=bool)
        bits[rows["at"].to_numpy()] = True
        return pd.DataFrame({"piece": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    some = frequent.where(F.size(F.split("phrase", " ")) == length).where("phrase <> ''").select("phrase")
    pieces = some.mapInArrow(places, "piece long, at long").distinct().groupBy("piece").applyInPandas(packed, "piece long, bits binary")
    out = Filter()
    for row in pieces.collect():  # 1,024 rows at most, of a fixed size together
        start = row.piece << (piece - 3)
        out.bits[start : start + (1 << (piece - 3))] = np.frombuffer(row.bits, dtype=np.uint8)
    return frequent.sparkSession.sparkContext.broadcast(out.bits)


def _frequent(texts: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, phrase, n) of all phrases with ``least`` occurrences, and the words of each language with the phrase ''.

    Words and pairs are counted first. A longer phrase is frequent only if both
    that are a word shorter are, which a filter of fixed size tells apart from
    nearly all that are not; then it is counted exactly, like the others. Parts
    of texts are counted before they are shuffled, so that a shuffle has a row
    for each phrase of a part.
    """
    out = None
    for length in range(2, longest + 1):
        parts = _counted(texts, length, None if out is None else _filter_bits(out, length - 1))
        # Dealt out first, as parts are counted already and would only fill a second table.
        counts = parts.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        found = stash(counts.where((F.col("n") >= least) | (F.col("phrase") == "")), "frequent")
        out = found if out is None else out.unionByName(found)
    return out


_WALKED = "lang string, phrase string, depth int, n long, given array<long>, wider long, part int, before array<long>, longer long, open boolean, heads array<long>"


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One pass over a range of the sorted stream: each row with the counts of its beginnings and of its longest extension.

    The stream is sorted by words, so the rows of all beginnings of a row come
    before it and are the ones that are still open. What a range cannot know,
    as it lies in the ranges before or after, is left null or open, and a
    last row (without a phrase) tells the other ranges what they need.
    """
    names = [x.split()[0] for x in _WALKED.split(", ")]
    stack: list[list | None] = []  # open rows: [lang, phrase, depth, n, given, wider, before, longer]
    heads: dict[int, int] = {}  # largest count of the first rows that extend a row of an earlier range, by its depth
    out, part = [], None

    def closed(row: list, is_open: bool) -> tuple:
        return *row[:6], part, *row[6:], is_open, None

    def frame() -> pd.DataFrame:
        made = pd.DataFrame(out, columns=names)
        out.clear()
        return made

    for batch in batches:
        for lang, phrase, depth, n, given, wider, part in batch[names[:7]].itertuples(index=False, name=None):
            out.extend(closed(row, False) for row in stack[depth:] if row)
            del stack[depth:]
            stack.extend([None] * (depth - len(stack)))
            before = [row[3] if row else None for row in stack]
            if depth and stack[-1]:
                stack[-1][7] = max(stack[-1][7], n)
            elif depth:
                heads[depth - 1] = max(heads.get(depth - 1, 0), n)
            stack.append([lang, phrase, depth, n, given, wider, before, 0])
        if out:
            yield frame()
    if part is not None:
        out.extend(closed(row, True) for row in stack if row)
        yield frame()
        widest = max([len(stack), *(k + 1 for k in heads)])
        out.append((*[None] * 6, part, [row[3] if row else None for row in stack], None, None, [heads.get(k, 0) for k in range(widest)]))
        yield frame()


def _stitched(ranges: list[tuple[int, list[int | None], list[int]]]) -> list[tuple[int, list[int | None], list[int]]]:
    """(range, counts of the rows open at its start, largest extensions that later ranges hold of those open at its end)."""
    before, after, state, carry = {}, {}, [], []
    for part, stack, _ in ranges:
        before[part] = state
        state = [x if x is not None else (state[k] if k < len(state) else None) for k, x in enumerate(stack)]
    for part, stack, heads in reversed(ranges):
        after[part] = carry
        through = [k < len(stack) and stack[k] is None for k in range(len(heads))]
        carry = [max(h, carry[k] if through[k] and k < len(carry) else 0) for k, h in enumerate(heads)]
    return [(part, before[part], after[part]) for part, _, _ in ranges]


def lockstep(rows: DataFrame, *, suffix: bool) -> DataFrame:
    """``rows`` (lang, phrase, depth, n, given, wider) with ``before`` and ``longer``.

    ``before`` holds the counts of the language's words and of the phrase's
    beginnings (with ``suffix``: of its ends), ``longer`` the largest count of
    a phrase that is a word longer. Rows are sorted by range, so that words of any
    frequency are spread over tasks, and every range is walked once, all counts
    in lockstep. One small row for each range goes through the driver; it
    stitches the ends.
    """
    words = F.when(F.col("depth") > 0, F.split("phrase", " ")).otherwise(F.array().cast("array<string>"))
    order = rows.withColumn("words", F.reverse(words) if suffix else words)
    spread = order.repartitionByRange("lang", "words").sortWithinPartitions("lang", "words").drop("words").withColumn("part", F.spark_partition_id())
    walked = stash(spread.mapInPandas(_walk, _WALKED), "walked")
    ends = walked.where("phrase is null").select("part", "before", "heads").orderBy("part").collect()  # one row for each range
    found = _stitched([(r.part, list(r.before), list(r.heads)) for r in ends])
    ends = F.broadcast(rows.sparkSession.createDataFrame(found, "part int, known array<long>, more array<long>"))
    longer = F.when(F.col("open"), F.greatest("longer", F.coalesce(F.get("more", F.col("depth")), F.lit(0)))).otherwise(F.col("longer"))
    before = F.transform("before", lambda x, k: F.coalesce(x, F.get("known", k)))
    out = walked.where("phrase is not null").join(ends, "part")
    return out.select("lang", "phrase", "depth", "n", "given", "wider", before.alias("before"), longer.alias("longer"))


def _first_of_each(rows: DataFrame, top: int) -> DataFrame:
    """The first rows of each language by score, count and phrase; a task passes on no more than that."""

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["lang", "score", "a", "phrase"], ascending=[True, False, False, True])
        return frame[frame.groupby("lang").cumcount() < top]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = best(batch if held is None else pd.concat([held, batch]))
        if held is not None:
            yield held

    return rows.mapInPandas(each, rows.schema)


def collocations(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10, covered: int = 50, top: int | None = 2000,
) -> DataFrame:
    """Phrases of 2 to ``longest`` words whose words belong together, for each language.

    Returns lang, rank (from 1), phrase, a (its count), l and r (counts of both
    sides of the cut), n (words of the language) and score: the least, over all
    cuts, of floor(1000000 * a * a / (l * r)); of equal cuts the first.

    * Words are lower-cased (A-Z), never span ``.,;:!?`` or a line's end, and
      are counted with all phrases in whole texts. A phrase needs ``least``
      occurrences; all its parts then have as many, so rarer ones are left out
      of the streams (``_frequent``).
    * One stream holds the counts of all lengths in the order of their words
      (prefix order): a walk gives each phrase the counts of its beginnings and
      its most frequent extension to the right. Sorted by the reversed words
      (suffix order) a second walk gives the counts of its ends and the
      extension to the left (``lockstep``). No table of counts is looked up.
    * A phrase goes if one that is a word longer, and frequent itself, has
      ``covered`` per cent of its count or more. (A still longer one has no
      more than the one between.)
    * ``top`` rows of each language stay, by score, count and phrase in byte
      order; None keeps all (in that order, ranked).

    Defined cases: a null text is empty, a null language ``und``; repeated rows
    count each time; a text without words adds nothing; other columns of the
    input are ignored; an empty table gives an empty result. Counts are exact
    below 10**15.
    """
    if longest < 2:
        raise ValueError("longest must be 2 or more")
    lang, text = (F.col(c).cast("string") for c in (lang_col, text_col))
    texts = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), text.alias("text")).where("text <> ''")
    depth = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))).alias("depth")
    none = [F.lit(None).cast("array<long>").alias("given"), F.lit(None).cast("long").alias("wider")]
    forth = lockstep(_frequent(texts, longest, least).select("lang", "phrase", depth, "n", *none), suffix=False)
    back = lockstep(forth.select("lang", "phrase", "depth", "n", F.col("before").alias("given"), F.col("longer").alias("wider")), suffix=True)

    whole = lambda c: c.cast("decimal(15,0)")
    phrases = back.where("depth > 1").where(100 * F.greatest("wider", "longer") < covered * F.col("n"))
    phrases = phrases.withColumns({"a": whole(F.col("n")), "size": F.col("depth")})
    cut = F.array_min(
        F.transform(
            F.sequence(F.lit(1), F.col("size") - 1),
            lambda k: F.struct(
                F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * F.col("a") * F.col("a"), whole(F.get("given", k)) * whole(F.get("before", F.col("size") - k)))
                .alias("score"), k.alias("k"), F.get("given", k).alias("l"), F.get("before", F.col("size") - k).alias("r"),
            ),
        )
    )
    found = phrases.select(
        "lang", "phrase", F.col("n").alias("a"), cut.alias("cut"), F.get("before", F.lit(0)).alias("n"),
    )
    found = found.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    return ranked(found if top is None else _first_of_each(found, top), top)


def ranked(found: DataFrame, top: int | None) -> DataFrame:
    """Ranks within each language, over sorted ranges."""
    order = numbered(found.withColumns({"down": -F.col("score"), "less": -F.col("a")}), ["lang"], ["down", "less", "phrase"], "place")
    out = order.select("lang", (F.col("place") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")
    return out if top is None else out.where(F.col("rank") <= top)
