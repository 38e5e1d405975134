"""Which points a query may see: a filter of its own for each query, compared as bit sets."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the group that everybody belongs to.
EVERYBODY = "*"
#: Queries whose bits are compared with the points at once (memory only).
AT_ONCE = 256


def _tagged(names: Column, tag: str) -> Column:
    empty = F.array().cast("array<string>")
    return F.coalesce(F.transform(F.filter(names, lambda x: x.isNotNull()), lambda x: F.concat(F.lit(tag), x.cast("string"))), empty)


def point_marks(fields: Sequence[str] = (), *, arrays: Sequence[str] = ()) -> Column:
    """What a point shows to filters: first its groups and users, then the values of each field (``arrays`` have several)."""
    who = F.concat(_tagged(F.col("allowed_groups"), "g"), _tagged(F.col("allowed_users"), "u"))
    return F.array(who, *(_tagged(F.col(f) if f in arrays else F.array(F.col(f)), "=") for f in fields))


def query_marks(fields: Sequence[str] = ()) -> Column:
    """What a query asks for: its ``groups`` and ``user``, then the values that ``filters`` (a map of arrays) names for each field.

    A field that the map does not name is no condition (null); one that it
    names without values matches nothing.
    """
    who = F.concat(_tagged(F.concat(F.coalesce("groups", F.array().cast("array<string>")), F.array(F.lit(EVERYBODY))), "g"), _tagged(F.array("user"), "u"))
    asked = (F.try_element_at("filters", F.lit(f)) for f in fields)
    return F.array(who, *(F.when(values.isNotNull(), _tagged(values, "=")) for values in asked))


def _bits(lists: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(lists), max(1, -(-width // 64))), dtype=np.uint64)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    bit = np.array([b for x in lists for b in x], dtype=np.int64)
    np.bitwise_or.at(out, (row, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
    return out


def visible(points: Sequence, queries: Sequence) -> np.ndarray:
    """Whether each query (rows) may see each point (columns), by the marks of both.

    Every condition of a query must share a mark with the point. The marks
    that ``AT_ONCE`` queries name become bits, so that a pair costs a few
    words, however many groups, users and values there are.
    """
    out = np.ones((len(queries), len(points)), dtype=bool)
    for start in range(0, len(queries), AT_ONCE):
        asked = queries[start : start + AT_ONCE]
        for k in range(len(asked[0]) if len(asked) else 0):
            number: dict[str, int] = {}
            wanted = [[number.setdefault(m, len(number)) for m in ([] if q[k] is None else q[k])] for q in asked]
            free = np.array([q[k] is None for q in asked])
            shown = _bits([[number[m] for m in p[k] if m in number] for p in points], len(number))
            wanted = _bits(wanted, len(number))
            met = np.zeros((len(asked), len(points)), dtype=bool)
            for word in range(wanted.shape[1]):
                met |= (wanted[:, word, None] & shown[None, :, word]) != 0
            out[start : start + AT_ONCE] &= met | free[:, None]
    return out
