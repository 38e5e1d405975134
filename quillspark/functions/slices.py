"""Arrow batches worked on in slices, so that what Python holds goes with a slice and not with the rows of a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of input that are Python objects at a time; a longer value is alone.
SLICE_BYTES = 1 << 20


def row_bytes(values: pa.Array) -> np.ndarray:
    """About how many bytes each value takes, those of nested ones included."""
    if pa.types.is_string(values.type) or pa.types.is_large_string(values.type) or pa.types.is_binary(values.type):
        return pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 8
    if pa.types.is_list(values.type):
        ends = np.cumsum(pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        sums = np.r_[0, np.cumsum(row_bytes(values.flatten()))]
        return np.diff(sums[np.r_[0, ends]]) + 8
    if pa.types.is_struct(values.type):
        return sum(map(row_bytes, values.flatten()), np.full(len(values), 8, np.int64))
    return np.full(len(values), 8, np.int64)


def spans(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of rows that take ``limit`` bytes together, or are one row."""
    sums, start = np.cumsum(sizes), 0
    while start < len(sizes):
        held = int(sums[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(sums, held + limit, side="right")))
        yield start, end
        start = end


def sliced(each: Callable[..., pa.Array], kind: str, *columns: Column) -> Column:
    """``each`` over Arrow arrays of the columns, called for slices of a batch; it gives a value (of type ``kind``) for each row."""

    def parts(arrays: tuple[pa.Array, ...]) -> Iterator[pa.Array]:
        for start, end in spans(sum(map(row_bytes, arrays)), SLICE_BYTES):
            yield each(*(x.slice(start, end - start) for x in arrays))

    if len(columns) == 1:

        def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                yield from parts((batch,))

        return F.arrow_udf(one, kind)(*columns)

    def some(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            yield from parts(batch)

    return F.arrow_udf(some, kind)(*columns)


def lists(rows: list[list[tuple]], **fields: pa.DataType) -> pa.Array:
    """Lists of structs, from lists of tuples of the fields' values."""
    flat = [x for row in rows for x in row]
    parts = list(zip(*flat, strict=True)) if flat else [()] * len(fields)
    items = pa.StructArray.from_arrays([pa.array(p, kind) for p, kind in zip(parts, fields.values(), strict=True)], names=list(fields))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in rows])], pa.int32()), items)
