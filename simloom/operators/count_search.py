"""Exact lists of the nearest of count vectors (words of a text), at or above a threshold.

``exact_topk`` sends dense vectors to every block pair and looks at each product; here

* a vector travels as its non-zero counts, three bytes each, once to every pair of
  blocks its own is in: a pair is searched for both directions at once;
* tiles whose pairs all lie below the threshold are left out by an upper bound: a
  product of unit vectors is at most the product of their parts in ``BASIS``
  directions plus that of the lengths of what is left;
* the other tiles are one BLAS product of whole numbers, which float32 adds up exactly
  as long as the lengths' product is below 2 ** 24; longer rows are multiplied in float64.

So similarities are those of the formula, dot / (length * length), without a rounding
of the vectors.  Every task keeps the best ``k`` of a vector, however many are alike.  Still
quadratic: the bound saves tiles, not pairs of every kind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import grouping
from ..functions import vectors
from .knn import first_columns, ranked

#: Vectors of a block, vectors below which a block is not cut to keep all cores busy, rows and columns of a tile.
BLOCK, LEAST, ROWS, COLUMNS = 32768, 2048, 512, 2048
#: Directions of the upper bound; what its float32 may be wrong by; what float32 holds exactly.
BASIS, SLACK, WHOLE = 31, 1e-4, float(1 << 24)
#: Hits of the second side that are held before they are pruned.
HELD = 1 << 21

ENTRY = np.dtype([("place", "<u2"), ("count", "u1")])

Hits = tuple[np.ndarray, np.ndarray, np.ndarray]


def packed(row: np.ndarray, place: np.ndarray, count: np.ndarray, rows: int) -> pa.Array:
    """``rows`` binaries out of entries in the order of ``row``; a count beyond 255 is several entries, which add up."""
    parts = -(-count // 255)
    row, place = np.repeat(row, parts), np.repeat(place, parts)
    entry = np.empty(len(row), ENTRY)
    entry["place"], entry["count"] = place, 255
    entry["count"][np.cumsum(parts) - 1] = count - 255 * (parts - 1)
    size = np.bincount(row, minlength=rows) * ENTRY.itemsize
    offsets = np.concatenate([[0], np.cumsum(size)])
    if offsets[-1] >= 1 << 31:
        raise ValueError("batch too large for a binary column")
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(entry)])


def word_counts(df: DataFrame, id_col: str, words: Column, dim: int) -> DataFrame:
    """(id, code): how many of a row's words fall to each of ``dim`` places, by the first six hex digits of their MD5.

    A row without words has no vector.  Every word of a batch is hashed once, and nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                some = batch.slice(lo, 1024)
                size = pc.list_value_length(some.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
                coded = some.column(1).flatten().dictionary_encode()
                place = np.array([int(hashlib.md5(w.encode()).hexdigest()[:6], 16) % dim for w in coded.dictionary.to_pylist()], np.int64)
                row = np.repeat(np.arange(len(size)), size)
                total = np.bincount(row * dim + place[coded.indices.to_numpy()], minlength=len(size) * dim)
                cell = np.nonzero(total)[0]
                yield pa.record_batch([some.column(0), packed(cell // dim, cell % dim, total[cell], len(size))], ["id", "code"])

    listed = df.select(F.col(id_col).cast("long").alias("id"), words.alias("w")).filter(F.size("w") > 0)
    return listed.mapInArrow(run, "id long, code binary")


class Side(NamedTuple):
    """Vectors of a block: ids, counts, lengths, and of each tile their parts in the directions of the bound."""

    ids: np.ndarray
    counts: np.ndarray
    length: np.ndarray
    part: np.ndarray


def dense(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts): ids ascending; rows of one id are added up."""
    ids, row = np.unique(table["id"].to_numpy(), return_inverse=True)
    code = table["code"].cast(pa.large_binary()).combine_chunks()
    code = pa.concat_arrays(code.chunks) if isinstance(code, pa.ChunkedArray) else code
    offsets = np.frombuffer(code.buffers()[1], np.int64, len(code) + 1, code.offset * 8)
    entry = np.frombuffer(code.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].view(ENTRY)
    starts = (offsets - offsets[0]) // ENTRY.itemsize
    by_id = np.argsort(row, kind="stable")
    out = np.empty((len(ids), dim), np.float32)
    step = 4096
    for lo in range(0, len(ids), step):
        some = by_id[np.searchsorted(row[by_id], lo) : np.searchsorted(row[by_id], lo + step)]
        size = starts[some + 1] - starts[some]
        at = np.repeat(starts[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        cell = np.repeat(row[some] - lo, size) * dim + entry["place"][at]
        high = min(step, len(ids) - lo)
        total = np.bincount(cell, entry["count"][at], high * dim).reshape(high, dim)
        if out.dtype == np.float32 and total.max(initial=0) >= WHOLE:
            out = out.astype(np.float64)
        out[lo : lo + high] = total
    return ids, out


def directions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean, basis): the directions in which unit vectors of the block differ most; any others were as right."""
    some = counts[:: max(1, len(counts) // 4096)].astype(np.float64)
    some /= np.sqrt((some * some).sum(1, keepdims=True)) + vectors.EPS
    mean = some.mean(0)
    _, basis = np.linalg.eigh((some - mean).T @ (some - mean))
    return mean, basis[:, ::-1][:, :BASIS]


def side(ids: np.ndarray, counts: np.ndarray, mean: np.ndarray, basis: np.ndarray, tile: int) -> Side:
    """The block in tiles of vectors that lie on one side of the three main directions, by id in a tile."""
    length = np.sqrt(np.concatenate([(c.astype(np.float64) ** 2).sum(1) for c in np.array_split(counts, -(-len(counts) // 4096))]))
    length += vectors.EPS
    part = np.concatenate(
        [(c / n[:, None]) @ basis for c, n in zip(*(np.array_split(x, -(-len(counts) // 4096)) for x in (counts, length)))]
    )
    sign = (part[:, :3] > (mean @ basis)[:3]) @ (1 << np.arange(min(3, part.shape[1])))
    order = np.argsort(sign, kind="stable")
    for lo in range(0, len(order), tile):
        order[lo : lo + tile].sort()
    # a little too long is safe; zero vectors are similar to none
    rest = np.sqrt(np.maximum(0, 1 - (part * part).sum(1)) + SLACK * 0.01)
    part = np.concatenate([part, rest[:, None]], axis=1).astype(np.float32)
    return Side(ids[order], counts[order], length[order], part[order])


def best_of(hits: list[Hits], k: int) -> Hits:
    """The ``k`` best of every query by similarity, then id."""
    q, n, sim = (np.concatenate(x) for x in zip(*hits))
    order = np.lexsort((n, -sim, q))
    q, n, sim = q[order], n[order], sim[order]
    start = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.zeros(0, bool)
    place = np.arange(len(q)) - np.nonzero(start)[0][np.cumsum(start) - 1]
    keep = place < k
    return q[keep], n[keep], sim[keep]


def tile_hits(one: Side, two: Side, rows: np.ndarray, columns: np.ndarray, least: float, k: int, upper: bool) -> tuple[Hits, Hits] | None:
    """Hits of the rows and of the columns; with ``upper`` only pairs whose column comes after the row."""
    a, b = one.length[rows], two.length[columns]
    whole = a.max() * b.max() < WHOLE and one.counts.dtype == two.counts.dtype == np.float32
    left, right = (x.counts[at].astype(np.float32 if whole else np.float64, copy=False) for x, at in ((one, rows), (two, columns)))
    dot = left @ right.T
    close = dot >= np.multiply.outer((a * (least - 1e-5)).astype(dot.dtype), b.astype(dot.dtype))
    if upper:
        close &= columns[None, :] > rows[:, None]
    i, j = np.nonzero(close)
    # half away from zero, as in SQL
    sim = np.floor(dot[i, j].astype(np.float64) / (a[i] * b[j]) * 1e6 + 0.5) / 1e6
    sure = sim >= least
    i, j, sim = i[sure], j[sure], sim[sure]
    if len(i) == 0:
        return None
    ids, others = one.ids[rows], two.ids[columns]
    if len(i) <= k * (len(rows) + len(columns)):
        return (ids[i], others[j], sim), (others[j], ids[i], sim)
    grid = np.full(close.shape, -np.inf)
    grid[i, j] = sim

    def first(grid: np.ndarray, q: np.ndarray, n: np.ndarray) -> Hits:
        best = first_columns(grid, min(k, grid.shape[1]))  # ids ascend in a tile
        value = np.take_along_axis(grid, best, 1)
        row, place = np.nonzero(value > -np.inf)
        return q[row], n[best[row, place]], value[row, place]

    return first(grid, ids, others), first(np.ascontiguousarray(grid.T), others, ids)


def block_pair(first: pa.Table, second: pa.Table | None, dim: int, k: int, least: float) -> Iterator[Hits]:
    """Hits of two blocks in each other, or of one in itself; at most ``k`` of a vector at a time."""
    ids, counts = dense(first, dim)
    mean, basis = directions(counts)
    one = side(ids, counts, mean, basis, ROWS)
    same = second is None
    two = one if same else side(*dense(second, dim), mean, basis, COLUMNS)
    if same:
        own = one.length - vectors.EPS
        sim = np.floor(own * own / (one.length * one.length) * 1e6 + 0.5) / 1e6
        yield tuple(x[sim >= least] for x in (one.ids, one.ids, sim))
    width = ROWS if same else COLUMNS  # ids ascend in these
    held: list[Hits] = []
    size, limit = 0, HELD
    for lo in range(0, len(one.ids), ROWS):
        found = []
        for at in range(lo if same else 0, len(two.ids), width):
            near = one.part[lo : lo + ROWS] @ two.part[at : at + width].T >= least - SLACK
            rows, columns = np.nonzero(near.any(1))[0] + lo, np.nonzero(near.any(0))[0] + at
            if len(rows) == 0:
                continue
            hits = tile_hits(one, two, rows, columns, least, k, same and lo == at)
            if hits is None:
                continue
            found.append(hits[0])
            held.append(hits[1])
            size += len(hits[1][0])
            if size > limit:
                held = [best_of(held, k)]
                size = len(held[0][0])
                limit = 2 * size + HELD
        if found:
            yield best_of(found, k)
    if held:
        yield best_of(held, k)


def block_count(rows: int, cores: int, block: int | None = None) -> int:
    """Blocks of ``block`` vectors; of a smaller table as many as give every core three pairs of them."""
    spread = 1 if block else min(-(-rows // LEAST), int(np.ceil((6 * cores) ** 0.5)))
    return max(1, -(-rows // (block or BLOCK)), spread)


def counted_topk(df: DataFrame, k: int, least: float, dim: int, block: int | None = None) -> DataFrame:
    """(q, rk, n, sim): the exact ``k`` nearest of every vector, itself first, without those below ``least``.

    ``df`` has (id long, code binary), codes as :func:`packed` makes them, places below ``dim``; it
    is read twice.  Rows of one id add up.  Similarity is dot / (length * length), each length
    1e-12 longer, rounded to 6 decimals.  ``least`` is above zero.  Null ids raise.
    """
    if least <= 0 or not 0 < dim <= 1 << 16:
        raise ValueError("least is above zero, dim at most 65536")
    bounds = df.agg(F.count("*").alias("rows"), F.count_if(F.col("id").isNull() | F.col("code").isNull()).alias("bad")).first()
    if bounds["bad"]:
        raise ValueError(f"{bounds['bad']} null ids or vectors")
    spark = df.sparkSession
    if bounds["rows"] == 0:
        return spark.createDataFrame([], "q long, rk int, n long, sim double")
    blocks = block_count(bounds["rows"], spark.sparkContext.defaultParallelism, block)
    pairs = [(i, j) for j in range(blocks) for i in range(j)] + [(i, i) for i in range(blocks)]
    placed = df.select("id", "code", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("own"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other"))
    i, j = F.least("own", "other").cast("int"), F.greatest("own", "other").cast("int")
    number = F.when(i < j, F.expr("high * (high - 1) div 2") + F.col("low")).otherwise(F.col("low") + (len(pairs) - blocks))
    both = placed.withColumns({"low": i, "high": j}).select(
        number.cast("int").alias("grp"), (F.col("own") > F.col("other")).alias("second"), "id", "code"
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouping.iter_groups(batches, "grp"):
            i, j = pairs[group["grp"][0].as_py()]
            parts = [group.filter(pc.equal(group["second"], x)).combine_chunks() for x in (False, True)]
            if parts[0].num_rows == 0 or (i != j and parts[1].num_rows == 0):
                continue
            for hits in block_pair(parts[0], None if i == j else parts[1], dim, k, least):
                yield pa.record_batch(list(hits), ["q", "n", "sim"])

    # a task a pair, blocks in themselves, which are half the work, last
    found = both.repartitionById(len(pairs), "grp").mapInArrow(search, "q long, n long, sim double")
    return ranked(found, k)
