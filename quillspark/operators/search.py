"""Exact filtered top-k search over dense and sparse vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.joins import small
from quillspark.operators.visibility import visible
from quillspark.sources.store import stage

#: Queries that are broadcast together; more meet blocks of points of so many rows in a shuffle.
QUERY_BLOCK, POINT_BLOCK = 8192, 16384
#: Texts whose largest weights are kept together: a query scores all of such a block or none.
TEXT_BLOCK = 64
#: Indices that queries use and tasks know, to leave out all other terms before texts are written (memory only).
KNOWN_TERMS = 1 << 20


def _meet(points: DataFrame, queries: DataFrame, each: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], kinds: str) -> DataFrame:
    """``each(points, queries)`` for blocks of both, so that every point meets every query once.

    Up to ``QUERY_BLOCK`` queries are broadcast to the points, which are read
    once and not shuffled. More queries and the points are dealt into blocks
    that meet pairwise, in one plan of constant size.
    """
    blocks = -(-queries.count() // QUERY_BLOCK)
    if blocks <= 1:
        rows = queries.toPandas()  # one block
        held = points.sparkSession.sparkContext.broadcast(rows if len(rows) else None)

        def some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch) and held.value is not None:
                    yield each(batch, held.value)

        return points.mapInPandas(some, kinds)
    parts = max(1, -(-points.count() // POINT_BLOCK))

    def pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({x.split()[0]: [] for x in kinds.split(", ")}) if left.empty or right.empty else each(left, right)

    dealt = lambda ident, own, n, other, m: [
        F.pmod(F.xxhash64(ident), F.lit(n)).alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(other)
    ]
    left = points.select("*", *dealt("id", "_p", parts, "_q", blocks))
    right = queries.select("*", *dealt("query_id", "_q", blocks, "_p", parts))
    # Columns of their own on either side, as both may come from one table.
    left, right = (x.select([F.col(c).alias(c) for c in x.columns]).groupBy("_p", "_q") for x in (left, right))
    return left.cogroup(right).applyInPandas(pair, kinds)


def _kinds(points: DataFrame, queries: DataFrame) -> str:
    return f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {points.schema['id'].dataType.simpleString()}, score double"


def _ranked(found: DataFrame, k: int, digits: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", digits)), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _table(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _best(points: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of these points that each query may see, by cosine, ties to the smaller id."""
    names, ids, out = queries.query_id.to_numpy(), points.id.to_numpy(), {"query_id": [], "id": [], "score": []}
    asked, table = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) for x in (_table(queries.dense), _table(points.dense)))
    marked = "marks" in queries.columns
    for start in range(0, len(names), 256):
        some = slice(start, start + 256)
        scores = np.round(asked[some] @ table.T, 12)
        if marked:
            scores[~visible(points.marks.tolist(), queries.marks.iloc[some].tolist())] = -np.inf
        for name, row in zip(names[some], scores, strict=True):
            few = min(k, int((row > -np.inf).sum()))
            if not few:
                continue
            rows = np.flatnonzero(row >= np.partition(row, len(row) - few)[len(row) - few])
            rows = rows[np.lexsort((ids[rows], -row[rows]))[:few]]
            out["query_id"].append(np.full(few, name))
            out["id"].append(ids[rows])
            out["score"].append(row[rows])
    return pd.DataFrame({name: np.concatenate(x) if x else [] for name, x in out.items()})


def dense_search(points: DataFrame, queries: DataFrame, *, k: int = 20, where: Column | None = None) -> DataFrame:
    """Cosine top k of ``points(id, dense)`` for each of ``queries(query_id, dense)``; filters come before ranking.

    ``where`` is a condition for all queries (as that points are not deleted).
    If ``queries`` has ``marks`` (``visibility.query_marks``), so must
    ``points`` (``point_marks``), and each query ranks only what it may see.

    Points and queries meet in blocks (``_meet``), where filters are bit sets
    beside the product; a block keeps its own k best per query, so that only
    those are ranked over all. Ties go to the smaller id; zero vectors score 0.
    """
    names = ["dense", "marks"] if "marks" in queries.columns else ["dense"]
    kept = (points if where is None else points.where(where)).select("id", *names)
    asked = queries.select("query_id", *names)
    found = _meet(kept, asked, lambda left, right: _best(left, right, k), _kinds(points, queries))
    return _ranked(found, k, 12)


def idf(df: Column, total: Column) -> Column:
    """The BM25 form of inverse document frequency."""
    return F.log1p((total - df + 0.5) / (df + 0.5))


class TextBlocks:
    """An inverted list of some texts in blocks, with the largest weight of each index in each block.

    Texts come heaviest first, so that a block's weights are alike and the
    blocks of light texts have low bounds.
    """

    def __init__(self, indices: list[np.ndarray], weights: list[np.ndarray], size: int | None = None):
        size = size or TEXT_BLOCK
        self.rows = np.argsort([-w.sum() for w in weights], kind="stable")
        count = np.array([len(indices[k]) for k in self.rows], dtype=np.int64)
        row = np.repeat(np.arange(len(count)), count)
        index = np.concatenate([indices[k] for k in self.rows])
        order = np.lexsort((row, index))
        self.row, self.weight, index = row[order], np.concatenate([weights[k] for k in self.rows])[order], index[order]
        block = self.row // size
        self.starts = np.flatnonzero(np.r_[True, (np.diff(index) != 0) | (np.diff(block) != 0)]) if len(index) else np.zeros(0, np.int64)
        self.ends = np.r_[self.starts[1:], len(index)]
        self.index, self.block = index[self.starts], block[self.starts]
        self.top = np.maximum.reduceat(self.weight, self.starts) if len(index) else np.zeros(0)
        self.count, self.blocks = len(count), -(-len(count) // size)

    @staticmethod
    def _spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all numbers from each low to its high, which span each comes from)."""
        size = high - low
        span = np.repeat(np.arange(len(size)), size)
        return np.arange(len(span)) - np.repeat(np.cumsum(size) - size, size) + low[span], span

    def search(self, indices: np.ndarray, weights: np.ndarray, allowed: np.ndarray | None, k: int, least: float, ids: np.ndarray, most: int | None = None):
        """(rows, scores) of the k best texts, and how many blocks were scored.

        Blocks are scored by falling bound, until the next one's is below
        ``least`` or the k-th best score so far (or ``most`` blocks are).
        ``allowed`` and ``ids`` go by the given order of the texts.
        """
        entry, which = self._spans(np.searchsorted(self.index, indices), np.searchsorted(self.index, indices, side="right"))
        value = weights[which]
        bound = np.bincount(self.block[entry], value * self.top[entry], minlength=self.blocks)
        order, group = np.argsort(-bound, kind="stable"), np.argsort(self.block[entry], kind="stable")
        edges = np.searchsorted(self.block[entry][group], np.arange(self.blocks + 1))
        rows, scores, scored = np.zeros(0, np.int64), np.zeros(0), 0
        for block in order[: most if most is not None else len(order)]:
            if bound[block] <= 0 or bound[block] < least - 1e-8:
                break
            scored += 1
            mine = group[edges[block] : edges[block + 1]]
            at, span = self._spans(self.starts[entry[mine]], self.ends[entry[mine]])
            low = int(self.row[at].min())
            sums = np.bincount(self.row[at] - low, self.weight[at] * value[mine][span])
            some = np.flatnonzero(sums > 0)
            texts = self.rows[some + low]
            if allowed is not None:
                some, texts = some[allowed[texts]], texts[allowed[texts]]
            rows, scores = np.r_[rows, texts], np.r_[scores, sums[some]]
            if len(rows) >= k:
                keep = np.lexsort((ids[rows], -np.round(scores, 9)))[:k]
                rows, scores = rows[keep], scores[keep]
                least = max(least, scores[-1])
        keep = np.lexsort((ids[rows], -np.round(scores, 9)))[:k]
        return rows[keep], scores[keep], scored


def _scored(texts: pd.DataFrame, queries: pd.DataFrame, k: int, most: int | None = None) -> pd.DataFrame:
    """The k best of these texts for each query, or those among the ``most`` blocks with the largest bounds."""
    arrays = lambda column, kind: [np.asarray(x, dtype=kind) for x in column]
    blocks, ids, out = TextBlocks(arrays(texts.idx, np.int64), arrays(texts.w, np.float64)), texts.id.to_numpy(), {"query_id": [], "id": [], "score": []}
    marked = "marks" in queries.columns
    for start in range(0, len(queries), 256):
        some = queries.iloc[start : start + 256]
        allowed = visible(texts.marks.tolist(), some.marks.tolist()) if marked else [None] * len(some)
        for name, indices, weights, least, may in zip(some.query_id, arrays(some.idx, np.int64), arrays(some.w, np.float64), some.least, allowed, strict=True):
            rows, scores, _ = blocks.search(indices, weights, may, k, least, ids, most)
            out["query_id"].append(np.full(len(rows), name))
            out["id"].append(ids[rows])
            out["score"].append(scores)
    return pd.DataFrame({name: np.concatenate(x) if x else [] for name, x in out.items()})


def asked_indices(queries: DataFrame) -> Broadcast:
    """The indices that queries use, sorted, for ``reports.term_vectors``; None if there are more than ``KNOWN_TERMS``."""
    asked = queries.select(F.col("idx").cast("long")).where("idx is not null").distinct().limit(KNOWN_TERMS + 1).toPandas().idx.to_numpy(np.int64)
    return queries.sparkSession.sparkContext.broadcast(np.sort(asked) if len(asked) <= KNOWN_TERMS else None)


def sparse_search(
    terms: DataFrame, queries: DataFrame, *, k: int = 20, total: int | None = None, about: DataFrame | None = None, asking: DataFrame | None = None
) -> DataFrame:
    """Top k of the IDF-weighted dot product over shared indices; filters come before ranking.

    ``terms`` and ``queries`` hold one row per text and index: (id, idx, tf) and
    (query_id, idx, tf), without negative weights. A query without terms has no
    rows. Frequencies count all texts. With ``about`` (id, and ``marks`` if
    queries are filtered) only those texts are ranked, so deleted ones are left
    out of it; ``asking`` (query_id, marks) gives each query's own filter, as
    in ``dense_search``.

    ``terms`` may also hold one row per text (``reports.term_vectors``): (id,
    said, terms), an array of (idx, tf) and whether the text has any term, as
    those that no query uses may be left out. Such rows are read once and not
    shuffled; they need not be staged.

    Each text is one row with those of its terms that any query uses, each
    query one row with its weights; they meet as in ``dense_search``. Within a
    block of rows an inverted list knows the largest weight of each index in
    every ``TEXT_BLOCK`` texts. That bounds what a query can score there, and
    such a block is skipped if the bound is below the query's k-th best score:
    a first pass over each row block's best place gives every query a score to
    beat, a second one scores what may beat it (``TextBlocks``). Pairs of
    queries and texts are never rows before they are among a block's k best.
    """
    pack = lambda frame, key, weight: frame.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("idx", weight.cast("double").alias("w")))).alias("t"))
    lists = [F.col("t.idx").cast("array<long>").alias("idx"), F.col("t.w").alias("w")]
    if "terms" in terms.columns:
        held = stage(terms.select("id", "said", F.col("terms.idx").cast("array<long>").alias("idx"), F.col("terms.tf").cast("array<double>").alias("w")), "used")
        count = held.where("said").count() if total is None else total
        rows = held.where(F.size("idx") > 0).drop("said")
        df = rows.select(F.explode("idx").alias("idx")).groupBy("idx").agg(F.count("*").alias("df"))
    else:
        count = terms.select("id").distinct().count() if total is None else total
        used = terms.join(small(queries.select("idx").distinct()), "idx", "left_semi")
        df = used.groupBy("idx").agg(F.count("*").alias("df"))
        rows = pack(used, "id", F.col("tf")).select("id", *lists)
    weighed = pack(queries.join(df, "idx"), "query_id", F.col("tf") * idf(F.col("df"), F.lit(float(count)))).select("query_id", *lists)
    if asking is not None:
        weighed = weighed.join(asking.select("query_id", "marks"), "query_id")
    weighed = stage(weighed, "asked")
    if about is not None:
        rows = rows.join(about.select("id", *(["marks"] if asking is not None else [])), "id")
    if about is not None or "terms" not in terms.columns:
        rows = stage(rows, "texts")
    kinds = _kinds(terms, queries)
    first = _meet(rows, weighed.withColumn("least", F.lit(0.0)), lambda left, right: _scored(left, right, k, 1), kinds)
    beat = _ranked(first, k, 9).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    asked = stage(weighed.join(beat, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(0.0))), "bounded")
    return _ranked(_meet(rows, asked, lambda left, right: _scored(left, right, k), kinds), k, 9)
