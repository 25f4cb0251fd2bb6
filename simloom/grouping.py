"""Arrow processing of whole groups without one Python call per row or per batch.

``map_groups`` shuffles by a key, sorts inside the partitions and streams the
partition through one Python worker; a group is handed over as an Arrow table
as soon as the key changes.  Compared with ``applyInPandas`` there is no pandas
conversion and no JVM-side group iterator, so thousands of small groups cost
little.  Memory is bounded by the largest group: callers salt or block keys
that may be large before they come here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _rows(batches: list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(batches).combine_chunks()


def iter_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of equal ``key`` out of batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1, [len(keys)]])
        for lo, hi in zip(starts[:-1], starts[1:]):
            if held and keys[lo] != last:
                yield _rows(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = keys[lo]
    if held:
        yield _rows(held)


def map_groups(
    df: DataFrame,
    key: str,
    fn: Callable[[pa.Table], Iterable[pa.RecordBatch]],
    schema: str | T.StructType,
    partitions: int,
) -> DataFrame:
    """``fn`` over every group of rows with equal (integral, non-null) ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in iter_groups(batches, key):
            yield from fn(group)

    return df.repartition(partitions, key).sortWithinPartitions(key).mapInArrow(run, schema)


def fixed_binary(column: pa.Array, dtype: object, width: int) -> np.ndarray:
    """A binary column whose values all have ``width`` items, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    if len(column) == 0:
        return np.empty((0, width), dtype)
    offsets = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_binary(column.type) else np.int64)
    first = offsets[column.offset]
    size = len(column) * width * np.dtype(dtype).itemsize
    return np.frombuffer(column.buffers()[2], np.uint8, size, first).view(dtype).reshape(len(column), width)


def to_binary(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as a binary column."""
    matrix = np.ascontiguousarray(matrix)
    width = matrix.shape[1] * matrix.itemsize
    offsets = np.arange(len(matrix) + 1, dtype=np.int64) * width
    if offsets[-1] >= 1 << 31:
        raise ValueError("batch too large for a binary column")
    return pa.Array.from_buffers(
        pa.binary(), len(matrix), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(matrix)]
    )
