"""A Bloom filter in front of a join, sized by its keys.

A join of a large table with a set of keys that is neither small nor bounded
shuffles the whole large table.  Here the keys set bits, ``PER_KEY`` for every key
but ``MOST`` bits (64 MB) at most; rows whose bits are not set are dropped in the
scan, and the join shuffles what is left.  Keys too many for ``MOST`` bits would pass
nearly every row: then the table is left as it is, and the join alone decides.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import grouping, runtime

LEAST, MOST, PER_KEY = 1 << 20, 1 << 29, 10
#: The bits are built in so many parts, each by one task.
PARTS = 64
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each integer key; ``bits`` is a power of two."""
    with np.errstate(over="ignore"):
        mixed = keys.astype(np.int64).view(np.uint64) * _ONE
        mixed ^= mixed >> np.uint64(31)
        mixed *= _TWO
    mask = np.uint64(bits - 1)
    return (mixed & mask).astype(np.int64), ((mixed >> np.uint64(32)) & mask).astype(np.int64)


def size_for(keys: int) -> int:
    """Bits for so many keys; 0 if they are too many."""
    bits = LEAST
    while bits < keys * PER_KEY and bits < MOST:
        bits *= 2
    return bits if keys * PER_KEY <= 2 * bits else 0


def likely(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be in the one-column table ``keys``: all that are, few that are not.

    Rows with a null key are dropped.  ``keys`` is read twice: it should be a written table.
    """
    bits = size_for(keys.count())
    if bits == 0:
        return df.filter(df[key].isNotNull())
    width = bits // PARTS

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(places(batch.column(0).drop_null().to_numpy(), bits)))
            yield pa.record_batch([pa.array(at // width), pa.array((at % width).astype(np.int32))], ["part", "at"])

    def build(group: pa.Table) -> Iterable[pa.RecordBatch]:
        held = np.zeros(width, bool)
        held[group["at"].to_numpy()] = True
        yield pa.record_batch(
            [group["part"].combine_chunks()[:1], pa.array([np.packbits(held).tobytes()], pa.binary())], ["part", "bits"]
        )

    partial = keys.mapInArrow(spread, "part long, at int")
    tasks = min(PARTS, runtime.shuffle_partitions(df.sparkSession))
    merged = np.zeros(bits // 8, np.uint8)
    for row in grouping.map_groups(partial, "part", build, "part long, bits binary", tasks).collect():
        lo = row["part"] * (width // 8)
        merged[lo : lo + width // 8] = np.frombuffer(row["bits"], np.uint8)
    shared = df.sparkSession.sparkContext.broadcast(merged.tobytes())
    at = df.columns.index(key)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(shared.value, np.uint8)

        def among(place: np.ndarray) -> np.ndarray:
            return (held[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1

        for batch in batches:
            known = batch.filter(batch.column(at).is_valid())
            one, two = places(known.column(at).to_numpy(), bits)
            yield known.filter(pa.array(among(one) & among(two)))

    return df.mapInArrow(choose, df.schema)
