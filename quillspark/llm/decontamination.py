"""Operator 9: benchmark decontamination by SimHash windows in a multi-index, verified exactly."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import is_small, stash
from quillspark.llm.shingles import WordHashes, rolling

#: Bits of a fingerprint, and the blocks that the multi-index cuts it into.
BITS, BLOCKS = 64, 4
#: Limits of one broadcast index: items, word counts of items, characters. A larger benchmark is searched in slices.
SLICE_ITEMS, SLICE_SIZES, SLICE_CHARS = 4_000, 64, 32_000_000
#: Items that share the words of one set of block tables.
_GROUP = 64
#: Windows fingerprinted at once, looked up at once, and words searched at once; only memory depends on them.
_STEP, _BATCH, _PIECE = 2048, 32_768, 1 << 18
_FILTER_BITS = 1 << 20
#: All values of a block, nearest to zero first, so that ``value ^ _NEAR[:k]`` is a ball around a value.
_NEAR = np.argsort(np.bitwise_count(np.arange(1 << (BITS // BLOCKS), dtype=np.uint32)), kind="stable")
_BALL = np.cumsum(np.bincount(np.bitwise_count(np.arange(1 << (BITS // BLOCKS), dtype=np.uint32))))


def _votes(shingles: np.ndarray) -> np.ndarray:
    """The bits of each shingle, one row per shingle."""
    return np.unpackbits(shingles.view(np.uint8).reshape(-1, BITS // 8), axis=1)


def fingerprint(shingles: np.ndarray) -> np.uint64:
    """SimHash of a bag of shingles: a bit is set where more than half of them have it."""
    ones = _votes(shingles).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(shingles)).view(np.uint64)[0]


def window_marks(shingles: np.ndarray, lengths: list[int], count: int) -> list[np.ndarray]:
    """Fingerprints of the windows of each length (in shingles) that start at the first ``count`` shingles.

    One table of running sums serves all lengths. The sums wrap around: a
    difference over a window is right as long as its length fits the type.
    """
    kind = np.uint8 if lengths[-1] < 1 << 8 else np.uint16 if lengths[-1] < 1 << 16 else np.uint32
    out = [np.empty(max(0, min(count, len(shingles) - m + 1)), dtype=np.uint64) for m in lengths]
    space, over = np.empty(_STEP * BITS, dtype=kind), np.empty(_STEP * BITS, dtype=bool)
    for first in range(0, min(count, len(shingles)), _STEP):
        part = shingles[first : first + _STEP + lengths[-1] - 1]
        sums = np.zeros((len(part) + 1, BITS), dtype=kind)
        np.cumsum(_votes(part), axis=0, dtype=kind, out=sums[1:])
        sums = sums.ravel()
        for m, marks in zip(lengths, out, strict=True):
            size = min(_STEP, len(marks) - first)
            if size > 0:
                ones = np.subtract(sums[m * BITS : (m + size) * BITS], sums[: size * BITS], out=space[: size * BITS])
                marks[first : first + size] = np.packbits(np.greater(ones, m // 2, out=over[: size * BITS])).view(np.uint64)
    return out


class HammingIndex:
    """Fingerprints in blocks of bits; ``within`` finds all pairs within the radius.

    The blocks' own radii ``r`` satisfy ``sum(r + 1) = radius + 1``, so two
    fingerprints within the radius lie within its own radius in a block at
    least. Each block has a table that gives, for every value of the block, the
    set of indexed fingerprints within that block's radius.
    """

    def __init__(self, marks: np.ndarray, radius: int):
        self.marks, self.radius = marks, radius
        whole, more = divmod(radius + 1, BLOCKS)
        self.radii = [whole - 1 + (b < more) for b in range(BLOCKS)]
        self.groups = []
        for first in range(0, len(marks), _GROUP):
            part = marks[first : first + _GROUP]
            kind = np.dtype(f"u{next(x for x in (1, 2, 4, 8) if len(part) <= 8 * x)}")
            tables = np.zeros((BLOCKS, 1 << (BITS // BLOCKS)), dtype=kind)
            for b, r in enumerate(self.radii):
                for k, value in enumerate(part.view(np.uint16)[b::BLOCKS].tolist()):
                    tables[b, value ^ _NEAR[: _BALL[r] if r >= 0 else 0]] |= kind.type(1 << k)
            self.groups.append((first, part, tables))

    def probe(self, marks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(positions in ``marks``, indexed fingerprints, distances) of all pairs that agree closely in some block."""
        values = np.empty((BLOCKS, len(marks)), dtype=np.intp)
        np.copyto(values, marks.view(np.uint16).reshape(-1, BLOCKS).T)
        for first, part, tables in self.groups:
            sets = tables[0].take(values[0], mode="clip")
            for b in range(1, BLOCKS):
                sets |= tables[b].take(values[b], mode="clip")
            at = np.flatnonzero(sets != 0)
            sets, near = sets[at], marks[at]
            one = sets.dtype.type(1)
            while len(at):  # one member of each set at a time
                less = sets - one
                member = np.bitwise_count(~sets & less)
                yield at, member + np.int64(first), np.bitwise_count(near ^ part[member])
                sets &= less
                left = np.flatnonzero(sets != 0)
                at, sets, near = at[left], sets[left], near[left]

    def within(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``marks``, indexed fingerprints) of all pairs within the radius."""
        found = [(at[close], member[close]) for at, member, far in self.probe(marks) if (close := far <= self.radius).any()]
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at, member = (np.concatenate(x) for x in zip(*found, strict=True))
        return at, member


def weighted_overlap(left: np.ndarray, right: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum over shingles of the smaller number of occurrences; ``right`` is counted already."""
    values, counts = np.unique(left, return_counts=True)
    _, i, j = np.intersect1d(values, right[0], assume_unique=True, return_indices=True)
    return int(np.minimum(counts[i], right[1][j]).sum())


class Lengths:
    """Items whose lengths in shingles lie within a tenth of the shortest: one fingerprint, of the leading ones, serves all."""

    def __init__(self, lead: int, members: list[tuple[int, np.ndarray]], radius: int):
        self.lead = lead
        self.index = HammingIndex(np.array([fingerprint(x[:lead]) for _, x in members], dtype=np.uint64), radius)
        self.sizes = np.array([len(x) for _, x in members])
        self.items = [(item_id, np.unique(x, return_counts=True)) for item_id, x in members]


class ItemIndex:
    """Benchmark items by shingle width and class of lengths, each class with its multi-index of fingerprints."""

    def __init__(self, items: Iterable[tuple[int, str]], width: int, percent: int, radius: int):
        self.percent = percent
        hashes, found = WordHashes(), defaultdict(list)
        for item_id, text in items:
            words = hashes(text)
            if len(words):
                found[min(width, len(words))].append((item_id, rolling(words, width)))
        self.by_width = {}
        for w, members in found.items():
            members.sort(key=lambda x: len(x[1]))
            known = np.zeros(_FILTER_BITS, dtype=bool)
            leads: dict[int, list] = {}
            for item_id, shingles in members:
                known[shingles & np.uint64(_FILTER_BITS - 1)] = True
                if not leads or 10 * len(shingles) > 11 * lead:
                    lead = len(shingles)
                leads.setdefault(lead, []).append((item_id, shingles))
            self.by_width[w] = (known, [Lengths(lead, some, radius) for lead, some in leads.items()])

    def least(self, length: int | np.ndarray, span: int | np.ndarray) -> int | np.ndarray:
        """Common shingles that windows of ``span`` shingles need with items of ``length``."""
        return -(-self.percent * (length + span) // (100 + self.percent))

    def search(self, texts: list[np.ndarray]) -> list[tuple]:
        """(text, item, start, words, common, total, distance) of each item's best window in each text (word hashes)."""
        out: list[tuple] = []
        for w, (known, table) in self.by_width.items():
            chosen = [k for k, words in enumerate(texts) if len(words) >= w]
            if chosen:
                out += self._search([rolling(texts[k], w) for k in chosen], chosen, w, known, table)
        return out

    def _search(self, parts: list[np.ndarray], names: list[int], w: int, known: np.ndarray, table: list[Lengths]) -> list[tuple]:
        every = np.concatenate(parts)
        sizes = np.array([len(x) for x in parts])
        ends = np.cumsum(sizes)
        inside = np.zeros(len(every) + 1, dtype=np.int64)
        np.cumsum(known[every & np.uint64(_FILTER_BITS - 1)], out=inside[1:])
        found: dict[tuple[int, int, int], list[int]] = defaultdict(list)

        def keep(c: int, starts: np.ndarray, members: np.ndarray) -> None:
            """Of what the index has found: windows that lie in one text and hold enough shingles of any items."""
            text = np.searchsorted(ends, starts, side="right")
            lengths = table[c].sizes[members]
            spans = np.minimum(lengths, sizes[text])
            stops = starts + spans
            good = np.flatnonzero(stops <= ends[text])
            good = good[inside[stops[good]] - inside[starts[good]] >= self.least(lengths[good], spans[good])]
            for t, member, start in zip(text[good].tolist(), members[good].tolist(), starts[good].tolist(), strict=True):
                found[t, c, member].append(start)

        leads = [x.lead for x in table]
        for first in range(0, len(every), _BATCH):
            for c, marks in enumerate(window_marks(every[first : first + _BATCH + leads[-1] - 1], leads, _BATCH)):
                at, members = table[c].index.within(marks)
                if len(at):
                    keep(c, first + at, members)
        # A text shorter than that is one window as a whole.
        short = np.flatnonzero(sizes < leads[-1])
        whole = np.array([fingerprint(parts[k]) for k in short.tolist()], dtype=np.uint64)
        for c, lead in enumerate(leads):
            near = np.flatnonzero((sizes[short] < lead) & (sizes[short] >= self.least(lead, sizes[short])))
            if len(near):
                at, members = table[c].index.within(whole[near])
                keep(c, (ends - sizes)[short[near[at]]], members)
        out = []
        for (t, c, member), starts in found.items():
            (item_id, bag), m = table[c].items[member], int(table[c].sizes[member])
            low, high, span = int(ends[t] - sizes[t]), int(ends[t]), min(m, int(sizes[t]))
            best = max((weighted_overlap(every[start : start + span], bag), -start) for start in starts)
            if best[0] < self.least(m, span):
                continue
            # A window next to one found may be better still, though its own fingerprint was too far away.
            around = {s for start in starts for s in range(max(low, start - m), min(high - span, start + m) + 1)} - set(starts)
            for start in sorted(around):
                if inside[start + span] - inside[start] >= best[0]:
                    best = max(best, (weighted_overlap(every[start : start + span], bag), -start))
            common, start = best[0], -best[1]
            mark = fingerprint(every[start : start + min(span, table[c].lead)])
            distance = int(np.bitwise_count(mark ^ table[c].index.marks[member]))
            out.append((names[t], item_id, start - low, span + w - 1, common, m + span - common, distance))
        return out


def _slices(items: DataFrame, slice_items: int) -> Iterator[DataFrame]:
    """The items in parts whose index is small: some word counts each, or some of the items of one word count."""
    sizes = items.groupBy("n").agg(F.count("*").alias("items"), F.sum(F.length("words")).alias("chars")).orderBy("n").collect()
    held: list[int] = []
    rows = chars = 0
    for n, more, length in sizes:
        parts = max(-(-more // slice_items), -(-length // SLICE_CHARS))
        if held and (parts > 1 or rows + more > slice_items or chars + length > SLICE_CHARS or len(held) == SLICE_SIZES):
            yield items.where(F.col("n").between(held[0], held[-1]))
            held, rows, chars = [], 0, 0
        if parts > 1:
            for k in range(parts):
                yield items.where((F.col("n") == n) & (F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == k))
        else:
            held, rows, chars = [*held, n], rows + more, chars + length
    if held:
        yield items.where(F.col("n").between(held[0], held[-1]))


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    radius: int = 19,
    slice_items: int = SLICE_ITEMS,
) -> DataFrame:
    """Benchmark items found in documents: one row per document and item with its best window.

    A window has as many words as the item (or is the whole document, if that
    is shorter). Windows and items are bags of ``width``-word shingles; their
    similarity is the sum of the smaller counts (``common``) over that of the
    larger ones (``total``), and ``percent`` is the least that counts. The best
    window has the largest ``common``, then the smallest start. Returns the id
    columns, ``start_word``, ``n_words``, ``common``, ``total`` and
    ``distance`` (differing bits of the two fingerprints).

    Every window of every item length has a SimHash of its shingles, from
    running sums over the text that all lengths share; lengths within a tenth
    of one another share the fingerprint of their leading shingles too. Each is
    looked up in the multi-index of the items of those lengths
    (``HammingIndex``), which finds all items within ``radius`` bits. What it
    finds is verified: the shingles that any item holds bound the overlap, then
    whole bags are compared, those of the windows next to a find too. At the
    default radius one or two in a thousand windows of similarity exactly 0.8
    (about 10 bits apart, standard deviation 3) lie beyond it, a true copy
    never.

    One index at a time is broadcast, of at most ``slice_items`` items, 64 word
    counts and 32 million characters; a larger benchmark is searched slice by
    slice, mostly by word count, so that no window is fingerprinted twice.
    Defined cases: an item of fewer words than ``width`` is one shingle; null
    and blank texts and items match nothing; rows with a null id are searched
    and keep it; repeated rows give repeated results; repeated items (equal id
    and text) count once; other columns are ignored; empty tables give an empty
    result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("words"))
    items = items.where("item is not null and words is not null").distinct()
    items = items.withColumn("n", F.size(F.array_remove(F.split("words", r"[\x20\x09-\x0D]+"), ""))).where("n > 0")
    schema = "id long, item long, start_word long, n_words long, common long, total long, distance int"
    found = spark.createDataFrame([], schema)
    for part in _slices(items, slice_items):
        held = spark.sparkContext.broadcast([tuple(x) for x in part.select("item", "words").collect()])  # of bounded size

        def each(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index, hashes = ItemIndex(held.value, width, percent, radius), WordHashes()
            kinds = [pa.int64()] * 6 + [pa.int32()]

            def flush(ids: list, words: list) -> pa.RecordBatch:
                rows = [(ids[k], *hit) for k, *hit in index.search(words)]
                columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
                return pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)],
                    ["id", "item", "start_word", "n_words", "common", "total", "distance"],
                )

            ids, words, size = [], [], 0
            for batch in batches:
                for doc_id, text in zip(batch.column("id"), batch.column("text"), strict=True):
                    ids.append(doc_id.as_py())
                    words.append(hashes(text.as_py()))
                    size += len(words[-1])
                    if size >= _PIECE:
                        yield flush(ids, words)
                        ids, words, size = [], [], 0
            yield flush(ids, words)

        found = found.unionByName(texts.mapInArrow(each, schema))
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Documents that hold no benchmark item; rows with a null id are judged by ``benchmark_hits`` but always stay.

    All columns are kept. See ``benchmark_hits`` for what counts as held.
    """
    hits = benchmark_hits(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    bad = stash(hits.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_bad")).distinct(), "contaminated")
    bad = F.broadcast(bad) if is_small(bad) else bad
    return docs.join(bad, docs[id_col].cast("long") == bad["_bad"], "left_anti")
