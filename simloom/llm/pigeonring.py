"""Near-duplicate vectors by pigeonring filtering of bit sketches.

A vector becomes a ring of sign bits (one per random direction); two vectors at
angle t differ in a share t/pi of them.  The bits form a ring of segments.  If
two sketches differ in at most ``budget`` bits in all, then some chain of
consecutive segments, from its start on, stays within its proportional part of
the budget (the pigeonring principle).  The operator

1. indexes chains: a vector is posted once per window, a window being the first
   bits of a chain, and two vectors meet where these agree bit for bit;
2. follows the chain around the ring segment by segment, requiring every prefix
   of it to stay within its proportional budget plus ``SLACK`` bits.  The prefix of
   ``HEAD`` is tested first, for a block of pairs at once by a product of signs;
3. checks the full Hamming distance of the survivors;
4. checks the cosine of what is left: int8 codes decide the clear cases, the
   exact vectors the few near the threshold.

Starting chains only where the window agrees exactly is stricter than the
principle, which would allow the start its share of errors; the loss is a matter
of probability.  Larger collections start with more bits, and get as many windows,
on as long a ring, as keep it (``layout``): 11 for up to a million rows, 39 for fifty
million.  It is measured in the README.  A pair is emitted only at its first window
that agrees and whose chain passes, so candidates need no distinct.

Large groups of exact copies go through this once, as one vector, and get their
pairs at the end.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import bloom, grouping, kernels, runtime
from ..operators.listing import clean_path
from .permutation_index import distinct_units, draw, without_copies

#: Bits of the shortest sketch, and the lengths that a sketch may have.
RING = 256
RINGS = tuple(RING << k for k in range(5))
#: Share of the pairs at cosine 0.9 of which some window agrees.
MEET = 0.97
#: Windows start at multiples of so many bits; a chain is tested at the end of each segment.
STEP, SEGMENT = 2, 8
#: Part of the ring that the first test of a chain covers.
HEAD = 3 / 8
#: Standard deviations above the expected distance that the budget allows.
MARGIN = 2.4
#: Bits that a chain prefix may exceed its proportional budget by, on the shortest ring.
SLACK = 4
#: int8 codes decide a cosine that is further than this from the threshold.
CODE_ERROR = 0.006
#: Rows of one window value that one group holds, and of the sample that shows hot values.
BLOCK, SAMPLE = 8192, 16384


def budget(threshold: float, ring: int = RING, margin: float = MARGIN) -> int:
    """Bits that two vectors at the threshold may differ in."""
    share = np.arccos(threshold) / np.pi
    return int(np.ceil(ring * share + margin * np.sqrt(ring * share * (1 - share))))


def window_bits(rows: int) -> int:
    """Bits that must agree at a chain's start: a few thousand rows share a window's value by chance."""
    want = max(8, int(np.ceil(np.log2(max(rows, 1)))) - 12)
    return min(28, -(-want // STEP) * STEP)


def window_starts(count: int, ring: int = RING) -> np.ndarray:
    """Where ``count`` windows start, evenly on the ring."""
    return (np.arange(count) * (ring // STEP) // count) * STEP


def meeting(starts: np.ndarray, bits: int, ring: int, cosine: float = 0.9) -> float:
    """Probability that two vectors at ``cosine`` agree in a whole window.

    Windows that overlap are counted jointly, by the length of the run of agreeing
    bits from position to position.  Those that wrap around are left out.
    """
    agree = 1 - np.arccos(cosine) / np.pi
    ends = set((starts + bits - 1).tolist())
    run = np.zeros(bits + 1)  # chance of each run length (the last: this or more) with no window so far
    run[0] = 1
    for place in range(ring):
        longer = run * agree
        run[0] = run.sum() * (1 - agree)
        run[1:] = longer[:-1]
        run[-1] = 0 if place in ends else run[-1] + longer[-1]
    return 1 - float(run.sum())


@functools.lru_cache
def layout(bits: int) -> tuple[int, np.ndarray]:
    """(ring, window starts) with the fewest posted words of which ``MEET`` of the pairs at 0.9 have an agreeing window."""
    agree = (1 - np.arccos(0.9) / np.pi) ** bits
    apart = int(np.ceil(np.log(1 - MEET) / np.log(1 - agree)))  # windows that don't overlap need so many
    found = []
    for ring in RINGS:
        for count in range(apart, min(ring // STEP, (1 << _WINDOW) - 1) + 1):
            starts = window_starts(count, ring)
            if meeting(starts, bits, ring) >= MEET:
                found.append((count * (2 + ring // 64), ring, starts))
                break
    return min(found, key=lambda x: x[:2])[1:]


def directions(dim: int, ring: int = RING, seed: int = 7) -> np.ndarray:
    """Random directions, orthogonal in runs of ``dim``, which lowers the sketch's variance."""
    rng = np.random.default_rng(seed)
    runs = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-ring // dim))]
    return np.concatenate(runs)[:ring].astype(np.float32)


def sketches(units: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Sign bits as rows of 64-bit words, bit 0 first."""
    bits = (units.astype(np.float32) @ planes.T) > 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def window(words: np.ndarray, start: int, bits: int) -> np.ndarray:
    """The ``bits`` ring bits from ``start`` on, as an integer per row."""
    word, shift = divmod(start, 64)
    value = words[:, word] >> np.uint64(shift)
    if shift + bits > 64:
        value = value | (words[:, (word + 1) % words.shape[1]] << np.uint64(64 - shift))
    return value & np.uint64((1 << bits) - 1)


def chain(words: np.ndarray, start: int) -> np.ndarray:
    """Rows of words turned so that the bit ``start`` of the ring comes first."""
    word, shift = divmod(start, 64)
    turned = np.roll(words, -word, axis=1)
    if shift == 0:
        return turned
    return (turned >> np.uint64(shift)) | (np.roll(turned, -1, axis=1) << np.uint64(64 - shift))


def chain_passes(differ: np.ndarray, start: int, bits: int, most: int) -> np.ndarray:
    """Row by row, whether the chain of differing bits from ``start`` keeps every prefix within its budget.

    Prefixes end with each segment; the first ``bits`` bits, the window, must agree.
    """
    ring = differ.shape[1] * 64
    turned = np.ascontiguousarray(chain(differ, start))
    upto = np.cumsum(np.bitwise_count(turned.view(np.uint8)), axis=1, dtype=np.int16)
    limit = most * SEGMENT * np.arange(1, ring // SEGMENT + 1) / ring + SLACK * (ring / RING) ** 0.5
    return (upto <= limit).all(1) & (window(differ, start, bits) == 0)


def _candidates(
    ids: np.ndarray, words: np.ndarray, side: np.ndarray | None, start_no: int, starts: np.ndarray, bits: int, most: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a < b; ``ids`` ascend) of one window value that pass the chain and the full Hamming check."""
    ring = words.shape[1] * 64
    head = int(ring * HEAD)
    start = int(starts[start_no])
    flags = np.unpackbits(np.ascontiguousarray(chain(words, start)).view(np.uint8), axis=1, count=head, bitorder="little")
    signs = flags.astype(np.float32) * 2 - 1
    limit = most * head / ring + SLACK * (ring / RING) ** 0.5
    step = max(1, (1 << 21) // len(ids))
    for lo in range(0, len(ids), step):
        # the product of signs is the bits less twice those that differ
        i, j = np.nonzero(signs[lo : lo + step] @ signs[lo:].T >= head - 2 * limit)
        keep = i < j
        i, j = i[keep] + lo, j[keep] + lo
        if side is not None:
            keep = side[i] != side[j]
            i, j = i[keep], j[keep]
        differ = words[i] ^ words[j]
        keep = chain_passes(differ, start, bits, most)
        i, j, differ = i[keep], j[keep], differ[keep]
        keep = np.bitwise_count(differ).sum(1, dtype=np.int16) <= most
        i, j, differ = i[keep], j[keep], differ[keep]
        fresh = np.ones(len(i), bool)
        for earlier in range(start_no):
            met = np.nonzero(fresh & (window(differ, int(starts[earlier]), bits) == 0))[0]
            fresh[met] = ~chain_passes(differ[met], int(starts[earlier]), bits, most)
        yield i[fresh], j[fresh]


#: A posting's group is (window number, window value, two blocks), from the top bit down.
_WINDOW, _VALUE, _BLOCK = 9, 28, 13


def hot_windows(sample: np.ndarray, starts: np.ndarray, bits: int, rows: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, blocks) of the window values that hold more than ``block`` rows, judging by the sample's sketches.

    The estimate decides only how even the work is, never the result.
    """
    keys = [window(sample, int(s), bits).astype(np.int64) + (no << _VALUE) for no, s in enumerate(starts)]
    found, held = np.unique(np.concatenate(keys), return_counts=True)
    count = np.ceil(held * (rows / max(len(sample), 1)) / block).astype(np.int64)
    # a value that one row of the sample shows is no sign of a hot one
    hot = (count > 1) & (held > 1)
    return found[hot], np.minimum(count[hot], (1 << _BLOCK) - 1)


def own_block(ids: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(33)).astype(np.int64) % blocks


def candidate_pairs(
    coded: DataFrame, dim: int, threshold: float, rows: int, partitions: int, sample: np.ndarray | None = None
) -> DataFrame:
    """(a, b): pairs of ids within the Hamming budget that some chain brings together, each once.

    ``sample``, some of the vectors, shows which window values are hot.  These
    are cut into blocks by a hash of the id, and every pair of blocks is a group.
    """
    bits = window_bits(rows)
    ring, starts = layout(bits)
    planes = directions(dim, ring)
    most = budget(threshold, ring)
    words_count = ring // 64
    words_ = sketches(sample, planes) if sample is not None and len(sample) else np.empty((0, words_count), np.uint64)
    hot, hot_blocks = hot_windows(words_, starts, bits, rows, BLOCK)
    blocks_of = dict(zip(hot.tolist(), hot_blocks.tolist()))

    def grouped(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(group, position) of each posting; of one in a hot window, its groups."""
        place = np.searchsorted(hot, keys)
        is_hot = place < len(hot)
        is_hot[is_hot] = hot[place[is_hot]] == keys[is_hot]
        position = np.arange(len(keys))
        if not is_hot.any():
            return keys << (2 * _BLOCK), position
        count = np.ones(len(keys), np.int64)
        count[is_hot] = hot_blocks[place[is_hot]]
        position = np.repeat(position, count)
        other = np.arange(len(position)) - np.repeat(np.cumsum(count) - count, count)
        own = own_block(ids[position], count[position])
        pair = (np.minimum(own, other) << _BLOCK) + np.maximum(own, other)
        return (keys[position] << (2 * _BLOCK)) + pair, position

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            words = sketches(kernels.decode(grouping.fixed_binary(batch.column(1), np.int8, dim)), planes)
            for lo in range(0, len(ids), 8192):
                part = words[lo : lo + 8192]
                keys = [window(part, int(s), bits).astype(np.int64) + (no << _VALUE) for no, s in enumerate(starts)]
                some = np.tile(ids[lo : lo + 8192], len(starts))
                group, position = grouped(np.concatenate(keys), some)
                row = position % len(part)
                yield pa.record_batch(
                    [
                        pa.array(group),
                        pa.array(some[position]),
                        *(pa.array(part[row, w].view(np.int64)) for w in range(words_count)),
                    ],
                    ["grp", "id", *(f"w{w}" for w in range(words_count))],
                )

    def meet(group: pa.Table) -> Iterable[pa.RecordBatch]:
        if group.num_rows < 2:
            return
        ids = group["id"].to_numpy()
        ids, first = np.unique(ids, return_index=True)
        words = np.stack([group[f"w{w}"].to_numpy().view(np.uint64)[first] for w in range(words_count)], axis=1)
        number = int(group["grp"][0].as_py())
        key, low, high = number >> (2 * _BLOCK), number >> _BLOCK & ((1 << _BLOCK) - 1), number & ((1 << _BLOCK) - 1)
        side = None if low == high else own_block(ids, blocks_of[key])
        for i, j in _candidates(ids, words, side, key >> _VALUE, starts, bits, most):
            if len(i):
                yield pa.record_batch([ids[i], ids[j]], ["a", "b"])

    fields = ", ".join(f"w{w} long" for w in range(words_count))
    postings = coded.mapInArrow(post, f"grp long, id long, {fields}")
    return grouping.map_groups(postings, "grp", meet, "a long, b long", partitions)


def scored(
    pairs: DataFrame, vectors: DataFrame, dim: int, dtype: type
) -> DataFrame:
    """(a, b, cosine): pairs with the cosine of their codes."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = kernels.unit(grouping.fixed_binary(batch.column(2), dtype, dim).astype(np.float64))
            right = kernels.unit(grouping.fixed_binary(batch.column(3), dtype, dim).astype(np.float64))
            cosine = np.einsum("ij,ij->i", left, right)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(cosine)], ["a", "b", "cosine"])

    left = vectors.select(F.col("id").alias("a"), F.col("code").alias("x"))
    right = vectors.select(F.col("id").alias("b"), F.col("code").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(score, "a long, b long, cosine double")


def exact_units(df: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    """(id, code) with the vector's own float32 values as the code, for exact checks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = kernels.list_matrix(batch.column(1), dim)
            yield pa.record_batch(
                [batch.column(0).take(pa.array(rows)), grouping.to_binary(values.astype(np.float32))], ["id", "code"]
            )

    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v"))
    return source.filter("id IS NOT NULL AND v IS NOT NULL").mapInArrow(run, "id long, code binary")


def near_duplicate_vectors(
    df: DataFrame,
    id_col: str = "data_index",
    vector_col: str = "embs",
    dim: int = 128,
    threshold: float = 0.9,
) -> DataFrame:
    """(a, b): pairs of ids, a < b, of cosine at least ``threshold`` (rounded to 6 decimals).

    Every pair returned is checked; a pair is missed if no window of its two
    sketches agrees or their distance is beyond the budget.

    Null, short, long, zero and non-finite vectors and null ids have no pairs.
    An id that comes several times counts once.  An empty table gives an empty
    result.  Other columns are ignored.
    """
    rows = df.count()
    drawn = draw(df, id_col, vector_col, dim, min(SAMPLE, max(1024, rows // 60)), rows)
    coded, copies = without_copies(df, id_col, vector_col, dim, drawn, rows, np.int8)
    windows = len(layout(window_bits(rows))[1])
    pairs = candidate_pairs(coded, dim, threshold, rows, runtime.fan_out(df, copies=windows / 11), distinct_units(drawn))
    pairs = runtime.written(pairs, "candidates")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    met = bloom.likely(coded, "id", runtime.written(ends.distinct(), "candidate-ends"))
    close = scored(pairs, met, dim, np.int8).filter(F.col("cosine") >= threshold - CODE_ERROR)
    close = close.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    close = runtime.written(close, "close")
    sure = close.filter(F.col("cosine") >= threshold + CODE_ERROR).select("a", "b")
    unsure = close.filter(F.col("cosine") < threshold + CODE_ERROR).select("a", "b")
    ends = unsure.select(F.explode(F.array("a", "b")).alias("id"))
    needed = bloom.likely(exact_units(df, id_col, vector_col, dim), "id", ends)
    exact = scored(unsure, needed, dim, np.float32)
    exact = exact.filter(F.round("cosine", 6) >= threshold).select("a", "b")
    return _with_copies(sure.unionByName(exact), copies)


def _with_copies(pairs: DataFrame, copies: DataFrame | None) -> DataFrame:
    """Pairs of representatives and pairs inside their groups, for all copies."""
    if copies is None:
        return pairs.distinct()
    own = copies.select("rep").distinct().select("rep", F.col("rep").alias("id"))
    members = own.unionByName(copies.select("rep", "id"))
    base = pairs.unionByName(own.select(F.col("rep").alias("a"), F.col("id").alias("b")))
    left = members.select(F.col("rep").alias("ra"), F.col("id").alias("ia"))
    right = members.select(F.col("rep").alias("rb"), F.col("id").alias("ib"))
    wide = base.join(left, base["a"] == left["ra"], "left").join(right, base["b"] == right["rb"], "left")
    ends = wide.select(F.coalesce("ia", "a").alias("x"), F.coalesce("ib", "b").alias("y")).filter("x <> y")
    return ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def changed_copies(
    df: DataFrame,
    paths: DataFrame,
    id_col: str = "data_index",
    vector_col: str = "embs",
    path_col: str = "fpaths",
    dim: int = 128,
    threshold: float = 0.9,
) -> DataFrame:
    """(index_a, index_b): near-duplicate vectors, without one file listed twice.

    A pair is left out if the clean paths of both sides are present and equal.
    An id with several path rows is the same file if any of them agree.
    """
    pairs = near_duplicate_vectors(df, id_col, vector_col, dim, threshold)
    clean = (
        paths.select(F.col(id_col).cast("long").alias("id"), clean_path(path_col).alias("p"))
        .filter("id IS NOT NULL AND p IS NOT NULL")
        .distinct()
    )
    left, right = (clean.select(F.col("id").alias(x), F.col("p").alias("p" + x)) for x in "ab")
    same = pairs.join(left, "a").join(right, "b").filter("pa = pb").select("a", "b").distinct()
    return pairs.join(same, ["a", "b"], "left_anti").select(
        F.col("a").alias("index_a"), F.col("b").alias("index_b")
    )


def copy_groups(pairs: DataFrame) -> DataFrame:
    """(data_index, group_id, links): every id with a changed copy, its group and its number of copies."""
    from .min_label import connected

    ends = pairs.select(F.explode(F.array("index_a", "index_b")).alias("node"))
    links = ends.groupBy("node").agg(F.count("*").alias("links"))
    return connected(pairs, "index_a", "index_b").join(links, "node").select(
        F.col("node").alias("data_index"), F.col("label").alias("group_id"), "links"
    )
