"""Operator 4: line dedup by a segment-partition edit join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import by_key, is_small, lookup, runs, stash, unused
from quillspark.llm.graph import components

#: Bins of the letter counts that are compared before two lines are aligned.
_BINS = 32
#: Where the edits grow with length: a window of as many grams as a run of ``SPAN`` characters holds gives one key.
SPAN, GRAM = 24, 12
#: Characters whose grams are hashed at once; some ten arrays of eight bytes each.
_LETTERS = 500_000


def within_edits(left: str, right: str, limit: int) -> bool:
    """Whether two strings are at most ``limit`` edits apart.

    Bit-parallel over a band: one machine-sized integer holds the differences
    of the 2 * limit + 1 cells of a column around the diagonal, and slides
    down by a cell with each column.
    """
    if len(left) > len(right):
        left, right = right, left
    short, long = len(left), len(right)
    if long - short > limit:
        return False
    if left == right or long <= limit:
        return True
    if limit == 0:
        return False
    if short <= limit:  # as many rows as edits: a small table
        row = list(range(long + 1))
        for i, x in enumerate(left, 1):
            above, row = row, [i]
            for j, y in enumerate(right, 1):
                row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        return row[-1] <= limit
    places: dict[str, int] = {}
    for i, letter in enumerate(left):
        places[letter] = places.get(letter, 0) | 1 << i
    mask, bottom = (1 << 2 * limit + 1) - 1, 1 << 2 * limit
    more, less, distance = (mask << limit) & mask, 0, limit
    for j, letter in enumerate(right):
        shift = j - limit
        same = places.get(letter, 0)
        same = (same >> shift if shift >= 0 else same << -shift) & mask
        level = ((((same & more) + more) ^ more) | same | less) & mask
        across_more, across_less = (less | ~(level | more)) & mask, level & more
        row = j + 1 + limit
        if row <= short:  # down the band's lower edge
            distance += not level & bottom
            if distance > 3 * limit + long - short:
                return False
        else:  # along the last row
            cell = 1 << short - (j + 1) + limit
            distance += bool(across_more & cell) - bool(across_less & cell)
        more, less = (across_less | ~((level >> 1) | across_more)) & mask, (level >> 1) & across_more
    return distance <= limit


def segments(length: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the ``limit + 1`` even segments of a string of that length, the longer ones last."""
    short, longer = divmod(length, limit + 1)
    sizes = [short] * (limit + 1 - longer) + [short + 1] * longer
    starts = np.cumsum([0, *sizes[:-1]]).tolist()
    return list(zip(starts, sizes, strict=True))


def probes(length: int, indexed: int, limit: int) -> Iterator[tuple[int, int, int]]:
    """(segment, start, length) of the substrings that a string probes the index of a shorter length with.

    If two strings are within ``limit`` edits, a segment of the shorter one is
    unchanged in the longer one. Of the places where segment i can lie, only
    those are probed that leave at most i edits before it and the rest after
    it; a match elsewhere implies another segment's match.
    """
    gap = length - indexed
    for i, (start, size) in enumerate(segments(indexed, limit)):
        low = max(start - i, start + gap - (limit - i), 0)
        high = min(start + i, start + gap + (limit - i), length - size)
        for at in range(low, high + 1):
            yield i, at, size


class Keys:
    """Index and probe keys of lines; the places to cut at are remembered by length."""

    def __init__(self, limit: int, least: int):
        self.limit, self.least = limit, least
        self.plans: dict[int, tuple[list, list]] = {}

    def _plan(self, size: int) -> tuple[list[tuple[int, int, int]], list[bool]]:
        """(seed, first byte, last byte) of each key of a line of that length, and whether it is an index key."""
        if (plan := self.plans.get(size)) is None:
            cuts = [((size << 8) | i, at, n, True) for i, (at, n) in enumerate(segments(size, self.limit))]
            for indexed in range(max(size - self.limit, self.least), size + 1):
                cuts += [((indexed << 8) | i, at, n, False) for i, at, n in probes(size, indexed, self.limit)]
            if len(self.plans) > 20_000:
                self.plans.clear()
            plan = self.plans[size] = [(seed, 4 * at, 4 * (at + n)) for seed, at, n, _ in cuts], [x[3] for x in cuts]
        return plan

    def digests(self, line: str) -> tuple[list[bytes], list[bool]]:
        """Eight bytes for each key of a line, and whether it is an index key; lines shorter than ``least`` have none."""
        if len(line) < self.least:
            return [], []
        plan, indexed = self._plan(len(line))
        letters = line.encode("utf-32-le", "surrogatepass")  # four bytes each, so that a substring is a slice
        return [xxhash.xxh3_64_digest(letters[a:b], seed=seed) for seed, a, b in plan], indexed

    def of(self, line: str) -> list[tuple[int, bool]]:
        """(64-bit key, whether it is an index key) for a line."""
        found, indexed = self.digests(line)
        return list(zip(np.frombuffer(b"".join(found), dtype=np.int64).tolist(), indexed, strict=True))


#: What makes a text differ from its lines with white space made single: spaces that are not alone, and any other white space.
_UNEVEN = ("  ", " \n", "\n ", *"\t\r\x0b\x0c\x1c\x1d\x1e\x1f")
_WIDE = (*"\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B)))


def lines_of(text: str | None) -> list[str]:
    """Lines of a whole text, white space made single and trimmed; blank lines stay as empty strings."""
    if not text:
        return []
    lines = text.split("\n")
    if text[0] == " " or text[-1] == " " or any(x in text for x in _UNEVEN) or not text.isascii() and any(x in text for x in _WIDE):
        return [" ".join(x.split()) for x in lines]
    return lines


def _hashes(lines: list[str]) -> np.ndarray:
    """Two 64-bit numbers for each line, which tell it from all others."""
    found = [xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines]
    return np.frombuffer(b"".join(found), dtype=np.int64).reshape(-1, 2)


def _occurrences(texts: DataFrame) -> DataFrame:
    """(id, t, line_no, h, h2): every line of every text; ``t`` tells texts of one id apart."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, lines = [], [], []
            for row, text in enumerate(batch.column("text")):
                for k, line in enumerate(lines_of(text.as_py())):
                    if line:
                        rows.append(row)
                        places.append(k)
                        lines.append(line)
            rows, hashes = pa.array(rows, pa.int64()), _hashes(lines)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(rows), batch.column("t").take(rows), pa.array(places, pa.int32()), pa.array(hashes[:, 0]), pa.array(hashes[:, 1])],
                ["id", "t", "line_no", "h", "h2"],
            )

    return texts.mapInArrow(each, "id long, t long, line_no int, h long, h2 long")


def _keys(texts: DataFrame, limit: int, least: int) -> DataFrame:
    """(key, h, index) of every line; ``h`` says which line."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Keys(limit, least)
        for batch in batches:
            found = list({x: None for text in batch.column("text") for x in lines_of(text.as_py()) if len(x) >= least})
            keys, indexed, counts = [], [], []
            for line in found:
                made, kinds = maker.digests(line)
                keys += made
                indexed += kinds
                counts.append(len(made))
            hashes = np.repeat(_hashes(found)[:, 0], counts)
            keys = np.frombuffer(b"".join(keys), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(hashes), pa.array(indexed, pa.bool_())], ["key", "h", "index"])

    return texts.mapInArrow(each, "key long, h long, index boolean")


def _texts_of(texts: DataFrame, least: int) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {x for text in batch.column("text") for x in lines_of(text.as_py()) if len(x) >= least}
            found = sorted(found)
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(found)[:, 0]), pa.array(found, pa.string())], ["h", "line"])

    return texts.mapInArrow(each, "h long, line string")


def allowed(size, limit: int, growing: bool):
    """Edits that a pair may be apart whose shorter line has that many characters (a number or an array)."""
    return np.maximum(limit, size // SPAN - 1) if growing else limit + 0 * size


def window_minima(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(line, key): for each run of ``SPAN`` characters of a line the least hash of its grams, each once.

    Lines with an equal run of ``SPAN`` characters share a key, wherever it lies.
    """
    letters = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    sizes = np.array([len(x) for x in lines], dtype=np.int64)
    starts, count = np.cumsum(sizes) - sizes, np.maximum(sizes - SPAN + 1, 0)
    if not count.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    odd = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
    one = (letters + odd[1]) * odd[0]
    one ^= one >> np.uint64(31)
    two = one[:-1] * odd[1] + one[1:]
    four = two[:-2] * odd[2] + two[2:]
    eight = four[:-4] * odd[3] + four[4:]
    gram = eight[:-4] * odd[4] + four[8:]
    gram ^= gram >> np.uint64(32)
    gram *= odd[1]
    gram ^= gram >> np.uint64(29)
    least, width, wanted = gram, 1, SPAN - GRAM + 1
    while width < wanted:
        step = min(width, wanted - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    owner = np.repeat(np.arange(len(lines)), count)
    least = least[np.arange(len(owner)) + np.repeat(starts - (np.cumsum(count) - count), count)].view(np.int64)
    changed = np.flatnonzero((least[1:] != least[:-1]) | (owner[1:] != owner[:-1])) + 1
    first = np.concatenate([[0], changed])
    return owner[first], least[first]


def _minima(texts: DataFrame, least: int) -> DataFrame:
    """(key, h) of every line of at least that many characters."""

    def keyed(found: list[str]) -> pa.RecordBatch:
        owner, keys = window_minima(found)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(_hashes(found)[owner, 0])], ["key", "h"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held, done = [], 0, set()
            for text in batch.column("text"):
                for line in lines_of(text.as_py()):
                    if len(line) >= least and line not in done:
                        done.add(line)
                        found.append(line)
                        held += len(line)
                if held > _LETTERS:
                    yield keyed(found)
                    found, held = [], 0
            yield keyed(found)

    return texts.mapInArrow(each, "key long, h long")


def _counts(lines: list[str]) -> np.ndarray:
    table = np.zeros((len(lines), _BINS), dtype=np.int16)
    for k, line in enumerate(lines):
        table[k] = np.minimum(np.bincount(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) % _BINS, minlength=_BINS), 32000)
    return table


def _signed(lines: DataFrame) -> DataFrame:
    """(h, size, counts) of lines: what rules pairs out before their texts are moved."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("line").to_pylist()
            table = np.minimum(_counts(found), 255).astype(np.uint8)
            sizes = pa.array([len(x) for x in found], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("h"), sizes, pa.array([x.tobytes() for x in table], pa.binary())], ["h", "size", "counts"])

    return lines.select("h", "line").mapInArrow(each, "h long, size int, counts binary")


def _possible(members: DataFrame, limit: int) -> DataFrame:
    """(key, h) of the members that lengths and letter counts leave a partner in their key."""
    order = ["key", "low", "high"]

    def partners(rows: pd.DataFrame) -> pd.DataFrame:
        keys, sizes, part = rows[order].to_numpy(), rows["size"].to_numpy().astype(np.int64), rows.block.to_numpy()
        table = np.frombuffer(b"".join(rows.counts), dtype=np.uint8).reshape(-1, _BINS).astype(np.int16)
        tau, kept = allowed(sizes, limit, True), np.zeros(len(rows), dtype=bool)
        at, step = np.arange(len(rows)), 0
        while len(at):  # rows are sorted by size: a row is done once the next one is too long or of another group
            step += 1
            at = at[at + step < len(rows)]
            at = at[(keys[at] == keys[at + step]).all(axis=1) & (sizes[at + step] - sizes[at] <= tau[at])]
            pair = at[(keys[at, 1] == keys[at, 2]) | (part[at] != part[at + step])]
            pair = pair[np.abs(table[pair] - table[pair + step]).sum(axis=1) <= 2 * tau[pair]]
            kept[pair] = kept[pair + step] = True
        return rows.loc[kept, ["key", "h"]]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if batch.empty:
                continue
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = (held[order] != held[order].iloc[-1]).any(axis=1).to_numpy().nonzero()[0]
            if len(last):  # the last group may go on in the next batch
                yield partners(held.iloc[: last[-1] + 1])
                held = held.iloc[last[-1] + 1 :].reset_index(drop=True)
        if held is not None:
            yield partners(held)

    dealt = members.repartition(*order).sortWithinPartitions(*order, "size")
    return dealt.mapInPandas(each, "key long, h long").distinct()


def _verified(members: DataFrame, limit: int, growing: bool = False) -> DataFrame:
    """Links within each key's members, block against block: enough to connect what is connected.

    Lengths and letter counts rule pairs out at once; two lines that earlier
    links of the block connect are not compared.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, ["key", "low", "high"]):
            group = group.drop_duplicates("h")
            ids, lines, part = group.h.tolist(), group.line.tolist(), group.block.to_numpy()
            sizes, table = np.array([len(x) for x in lines]), _counts(lines)
            root = list(range(len(ids)))

            def find(x: int, root: list[int] = root) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            links = []
            for i in range(len(ids) - 1):
                tau = allowed(np.minimum(sizes[i + 1 :], sizes[i]), limit, growing)
                near = np.abs(sizes[i + 1 :] - sizes[i]) <= tau
                if group.low.iat[0] != group.high.iat[0]:
                    near &= part[i + 1 :] != part[i]
                others = i + 1 + np.flatnonzero(near)
                # An edit changes the counts by two at most.
                others = others[np.abs(table[others].astype(np.int32) - table[i]).sum(axis=1) <= 2 * tau[others - i - 1]]
                for j in others.tolist():
                    x, y = find(i), find(j)
                    if x != y and within_edits(lines[i], lines[j], int(tau[j - i - 1])):
                        root[y] = x
                        links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
            yield pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return by_key(members, ["key", "low", "high"]).mapInPandas(each, "a long, b long")


def _dealt(members: DataFrame, block: int) -> DataFrame:
    """(key, low, high, block, h): the members of each key in pairs of blocks."""
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("parts"))
    cells = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(F.least("block", other).alias("low"), F.greatest("block", other).alias("high")),
    )
    return (
        members.join(sizes, "key")
        .withColumn("block", F.pmod(F.xxhash64("h"), "parts").cast("int"))
        .withColumn("cell", F.explode(cells))
        .select("key", "cell.low", "cell.high", "block", "h")
    )


def line_links(texts: DataFrame, limit: int, least: int, block: int = 1024) -> DataFrame:
    """Links between different lines of a table (``id``, ``text``), as pairs of line hashes."""
    keys = _keys(texts, limit, least)
    low32 = F.shiftright("h", 32).cast("int")
    met = keys.groupBy("key").agg(F.min(low32).alias("x"), F.max(low32).alias("y"), F.max("index").alias("i"))
    crowded = stash(met.where("x <> y and i").select("key"), "crowded")
    members = stash(keys.join(F.broadcast(crowded) if is_small(crowded) else crowded, "key", "left_semi").select("key", "h").distinct(), "members")
    wanted = members.select("h").distinct()
    wanted = F.broadcast(wanted) if is_small(wanted) else wanted
    lines = _texts_of(texts, least).join(wanted, "h", "left_semi").groupBy("h").agg(F.min("line").alias("line"))
    return _verified(_dealt(members, block).join(stash(lines, "lines"), "h"), limit)


def grown_links(texts: DataFrame, limit: int, least: int, block: int = 1024) -> DataFrame:
    """Links between lines that are long enough to be more than ``limit`` edits apart.

    ``allowed`` edits leave a run of ``SPAN`` characters of the shorter line
    unchanged, so the two share a window's least gram; keys grow with the
    characters and not with the edits. Texts are moved only for members that
    lengths and letter counts leave a partner.
    """
    least = max(least, SPAN * (limit + 2))
    low32 = F.shiftright("h", 32).cast("int")
    keys = _minima(texts, least)
    met = keys.groupBy("key").agg(F.min(low32).alias("x"), F.max(low32).alias("y"))
    crowded = stash(met.where("x <> y").select("key"), "grown_crowded")
    members = stash(keys.join(F.broadcast(crowded) if is_small(crowded) else crowded, "key", "left_semi").distinct(), "grown_members")
    lines = lambda wanted: (
        _texts_of(texts, least).join(F.broadcast(wanted) if is_small(wanted) else wanted, "h", "left_semi").groupBy("h").agg(F.min("line").alias("line"))
    )
    signed = stash(_signed(lines(members.select("h").distinct())), "grown_signed")
    possible = stash(_possible(_dealt(members, block).join(signed, "h"), limit), "grown_possible")
    return _verified(_dealt(possible, block).join(stash(lines(possible.select("h").distinct()), "grown_lines"), "h"), limit, growing=True)


def duplicate_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", edits: int = 1, least: int = 16, growing: bool = False, hashed: bool = False
) -> DataFrame:
    """Per document: its lines and those that repeat an earlier line, of its own or another document.

    Lines are split at line feeds; white space in them is made single and
    trimmed. Lines are alike if equal, or, from ``least`` characters on, if at
    most ``edits`` edits apart; classes are what chains of alike lines connect.
    Of each class the first line by id and place stays, all others are
    dropped. With ``growing``, the shorter line of a pair also allows one edit
    for every ``SPAN`` characters it has, less one. Blank lines are never dropped. Returns one row per input row: the
    id column, ``n_lines``, ``n_dropped`` and ``dropped`` (line numbers from 0,
    ascending).

    Index keys are the ``edits + 1`` segments of a line with its length, probe
    keys the substrings at which a segment of an equally long or shorter line
    can lie. Keys are first counted without their lines; only lines that meet
    in a key are brought together, in blocks, and verified. Where edits grow,
    longer lines meet in window minima as well (``grown_links``).

    Defined cases: a null or empty text has no lines. Rows with a null id sort
    first. Repeated rows are one document: they get the same numbers. Different
    texts under one id, or without one, are documents of their own; of lines at
    one place the smaller hash of the text comes first. With ``hashed`` a column
    ``text_hash`` tells them apart. Other columns are ignored; an empty table
    gives an empty result.
    """
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("t"))
    seen = stash(_occurrences(texts), "occurrences")
    first = F.min(F.struct("id", "line_no", "t")).alias("first")
    single = stash(seen.groupBy("h", "h2").agg(first, F.count("*").alias("n")), "distinct")
    links = line_links(texts, edits, least)
    if growing:
        links = links.unionByName(grown_links(texts, edits, least)).distinct()
    owners = components(stash(links, "line_links")).withColumnRenamed("id", "h")
    owned = single.join(owners, "h", "left")
    alike = owned.where("component is not null").groupBy("component").agg(F.min("first").alias("first"))
    linked = owned.where("component is not null").drop("first").join(alike, "component").select("h", "h2", "first")
    known = linked.unionByName(owned.where("component is null and n > 1").select("h", "h2", "first"))
    placed = lookup(seen, stash(known, "repeated"), ["h", "h2"]).where("first is not null")
    gone = placed.where(~F.struct("id", "line_no", "t").eqNullSafe(F.col("first"))).groupBy("id", "t")
    gone = gone.agg(F.array_sort(F.collect_set("line_no")).alias("dropped")).withColumnsRenamed({"id": "_id", "t": "_t"})
    sized = texts.select("id", "t", F.when(F.length("text") > 0, F.size(F.split("text", "\n"))).otherwise(0).alias("n_lines"))
    joined = sized.join(stash(gone, "dropped"), sized["id"].eqNullSafe(F.col("_id")) & (sized["t"] == F.col("_t")), "left")
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    more = [F.col("t").alias("text_hash")] if hashed else []
    return joined.select(F.col("id").alias(id_col), "n_lines", F.size(dropped).alias("n_dropped"), dropped.alias("dropped"), *more)


def drop_lines(docs: DataFrame, found: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without the lines that ``duplicate_lines`` found; all columns are kept, untouched lines unchanged.

    Without the column ``text_hash`` (see ``hashed`` there), texts of an id that
    has several different results cannot be told apart and stay as they are.
    """
    key, mark, gone, many = unused(docs, "_id", "_hash", "_dropped", "_many")
    hashed = "text_hash" in found.columns
    own = F.xxhash64(F.col(text_col).cast("string")) if hashed else F.lit(0).cast("long")
    marked = found.select(F.col(id_col).alias(key), (F.col("text_hash") if hashed else F.lit(0).cast("long")).alias(mark), F.struct("n_lines", "dropped").alias(gone))
    marked = marked.groupBy(key, mark).agg(F.min(gone).alias(gone), F.max(gone).alias(many)).where(F.col(gone) == F.col(many))
    marked = marked.select(key, mark, F.col(f"{gone}.dropped").alias(gone)).where(F.size(gone) > 0)
    joined = docs.join(marked, docs[id_col].cast("long").eqNullSafe(marked[key]) & (own == marked[mark]), "left")
    kept = F.filter(F.split(text_col, "\n"), lambda line, k: ~F.array_contains(gone, k))
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn(text_col, text).select(*docs.columns)
