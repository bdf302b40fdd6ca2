"""Signals of an Arrow batch in small parts, as NumPy arrays, and results as Arrow lists without a Python object for each value.

Spark puts up to 10,000 rows or 64 MB in a batch; what is made of a signal may be
many times its size, so a worker makes and returns the results of a part at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Samples of a part; a longer signal is a part of its own.
PART_VALUES = 1 << 17


def parts(signals: pa.Array, most: int = PART_VALUES) -> Iterator[tuple[int, int]]:
    """First row and number of rows of each part; every row is in one."""
    first, values = 0, 0
    for i, n in enumerate(pc.fill_null(pc.list_value_length(signals), 0).to_pylist()):
        if i > first and values + n + 1 > most:
            yield first, i - first
            first, values = i, 0
        values += n + 1
    if first < len(signals):
        yield first, len(signals) - first


def arrays(signals: pa.Array) -> list[np.ndarray | None]:
    """Each signal as doubles, null samples as NaN; null stays null."""
    return [None if s.values is None else s.values.to_numpy(zero_copy_only=False).astype(float, copy=False) for s in signals]


def lists(values: pa.Array | np.ndarray, sizes: list[int | None]) -> pa.ListArray:
    """Values that follow each other, cut into lists of these sizes; no size is a null list."""
    ends = np.cumsum([0, *(n or 0 for n in sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values) if isinstance(values, np.ndarray) else values, mask=pa.array([n is None for n in sizes], pa.bool_()))


def rows(found: list[np.ndarray | None]) -> pa.ListArray:
    """An array for each row."""
    return lists(np.concatenate([np.zeros(0), *(x for x in found if x is not None)]), [None if x is None else len(x) for x in found])
