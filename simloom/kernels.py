"""Vector kernels over Arrow batches: parsing, normalising, coding, nearest pivots."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def list_matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Usable rows of a list-of-float column.

    Returns their positions and their values as a float64 matrix.  A row is
    usable if it is not null, has exactly ``dim`` numbers, all finite, and not
    all of them zero.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    good = np.diff(offsets) == dim
    if column.null_count:
        good &= column.is_valid().to_numpy(zero_copy_only=False)
    rows = np.nonzero(good)[0]
    if len(rows) == 0:
        return rows, np.empty((0, dim))
    matrix = values[offsets[rows][:, None] + np.arange(dim)]
    keep = np.isfinite(matrix).all(1) & (matrix != 0).any(1)
    return rows[keep], matrix[keep]


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest entry first, so that nothing overflows."""
    top = np.abs(matrix).max(axis=1, keepdims=True, initial=0.0)
    matrix = matrix / np.where(top > 0, top, 1)
    norm = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(norm > 0, norm, 1)


def codes(units: np.ndarray, dtype: type = np.int16) -> np.ndarray:
    """Directions as integers, each row scaled to the full range of ``dtype``.

    With int16 the cosine of two coded rows is within about 1e-5 of the true
    one, with int8 within about 0.004.
    """
    limit = np.iinfo(dtype).max
    top = np.abs(units).max(axis=1, keepdims=True, initial=0.0)
    return np.rint(units * (limit / np.where(top > 0, top, 1))).astype(dtype)


def decode(coded: np.ndarray) -> np.ndarray:
    """Coded rows as float32 unit vectors."""
    rows = coded.astype(np.float64)
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return (rows / np.where(norm > 0, norm, 1)).astype(np.float32)


def nearest(
    units: np.ndarray, pivots: np.ndarray, k: int, block: int = 2048, within: float | None = None
) -> np.ndarray:
    """Positions of the ``k`` pivots of largest inner product, best first, ties by position.

    With ``within``, pivots whose product is lower than the best one's by more
    than that are -1.
    """
    k = min(k, len(pivots))
    out = np.empty((len(units), k), np.int64)
    lhs = units.astype(np.float32, copy=False)
    for lo in range(0, len(lhs), block):
        score = lhs[lo : lo + block] @ pivots.T
        if k < len(pivots):
            part = np.argpartition(-score, k - 1, axis=1)[:, :k]
        else:
            part = np.broadcast_to(np.arange(k), score.shape).copy()
        part.sort(axis=1)
        value = np.take_along_axis(score, part, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        best = np.take_along_axis(part, order, 1)
        if within is not None:
            value = np.take_along_axis(value, order, 1)
            best[value < value[:, :1] - within] = -1
        out[lo : lo + block] = best
    return out


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest linked node of each of ``n`` local nodes, by vectorised hooking and jumping."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return label
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        high, low = np.maximum(la, lb), np.minimum(la, lb)
        np.minimum.at(label, high, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped


def pack12(values: np.ndarray) -> np.ndarray:
    """Rows of whole numbers from -2048 to 2047 as bytes, two in three; the width is even."""
    low = (values.astype(np.int16) + 2048).astype(np.uint16)
    one, two = low[:, 0::2], low[:, 1::2]
    out = np.empty((len(low), one.shape[1], 3), np.uint8)
    out[:, :, 0] = one & 0xFF
    out[:, :, 1] = (one >> 8) | ((two & 0xF) << 4)
    out[:, :, 2] = two >> 4
    return out.reshape(len(low), -1)


def unpack12(packed: np.ndarray) -> np.ndarray:
    """The rows that :func:`pack12` was given, as int16."""
    part = packed.reshape(len(packed), -1, 3).astype(np.uint16)
    out = np.empty((len(packed), part.shape[1], 2), np.int16)
    out[:, :, 0] = part[:, :, 0] | ((part[:, :, 1] & 0xF) << 8)
    out[:, :, 1] = (part[:, :, 1] >> 4) | (part[:, :, 2] << 4)
    return out.reshape(len(packed), -1) - np.int16(2048)


class Pivots:
    """Search of the nearest among a bounded number of pivots (or centres).

    Up to ``FLAT`` pivots are all compared.  More are put into about sqrt(n)
    cells of a few rounds of k-means; a search looks into the ``PROBE`` part of the
    cells whose centres are nearest, so its cost grows with a fraction of the
    pivots.  The same vector always gets the same answer.
    """

    FLAT, PROBE = 16384, 0.4

    def __init__(self, pivots: np.ndarray, flat: int | None = None):
        self.table = pivots.astype(np.float32)
        self.cells: list[np.ndarray] = []
        if len(pivots) <= (self.FLAT if flat is None else flat):
            return
        centres = self.table[:: max(1, len(pivots) // int(len(pivots) ** 0.5))].copy()
        for _ in range(4):
            cell = np.concatenate([(p @ centres.T).argmax(1) for p in np.array_split(self.table, -(-len(pivots) // 8192))])
            total = np.zeros_like(centres)
            np.add.at(total, cell, self.table)
            norm = np.linalg.norm(total, axis=1, keepdims=True)
            centres = np.where(norm > 0, total / np.where(norm > 0, norm, 1), centres)
        kept = [c for c in range(len(centres)) if (cell == c).any()]
        self.centres = centres[kept]
        self.cells = [np.nonzero(cell == c)[0] for c in kept]

    def __len__(self) -> int:
        return len(self.table)

    def nearest(self, units: np.ndarray, k: int, within: float | None = None, block: int = 4096) -> np.ndarray:
        """Positions of the ``k`` nearest, best first, ties by position; -1 beyond ``within`` of the best."""
        k = min(k, len(self.table))
        if not self.cells:
            return nearest(units, self.table, k, within=within)
        out = np.empty((len(units), k), np.int64)
        probes = max(1, int(np.ceil(len(self.cells) * self.PROBE)))
        for lo in range(0, len(units), block):
            part = units[lo : lo + block].astype(np.float32, copy=False)
            score = part @ self.centres.T
            limit = -np.partition(-score, probes - 1, axis=1)[:, probes - 1 : probes]
            looked = score >= limit
            best = np.full((len(part), k), -np.inf, np.float32)
            place = np.full((len(part), k), -1, np.int64)
            for number, members in enumerate(self.cells):
                rows = np.nonzero(looked[:, number])[0]
                if len(rows) == 0:
                    continue
                found = part[rows] @ self.table[members].T
                better = (found > best[rows, -1:]).any(1)
                if not better.any():
                    continue
                some, found = rows[better], found[better]
                value = np.concatenate([best[some], found], axis=1)
                where = np.concatenate([place[some], np.broadcast_to(members, found.shape)], axis=1)
                order = np.argpartition(-value, k - 1, axis=1)[:, :k]
                best[some] = np.take_along_axis(value, order, 1)
                place[some] = np.take_along_axis(where, order, 1)
                # the last column is the worst kept, the bound of the next cells
                worst = best[some].argmin(1)
                at = np.arange(len(some))
                for grid in (best, place):
                    held = grid[some]
                    held[at, worst], held[:, -1] = held[:, -1].copy(), held[at, worst].copy()
                    grid[some] = held
            order = np.lexsort((place, -best), axis=1)  # by value from above, then position
            place, best = np.take_along_axis(place, order, 1), np.take_along_axis(best, order, 1)
            if within is not None:
                place[best < best[:, :1] - within] = -1
            place[best == -np.inf] = -1
            out[lo : lo + block] = place
        return out
