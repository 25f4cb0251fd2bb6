"""Most similar vectors for every vector, by a permutation index.

Every vector is represented by its nearest pivots in order of nearness (a
permutation prefix) and posted in the inverted files of those pivots.  In an
inverted file the candidates of a vector are ranked by the footrule distance of
their prefixes; the ``RERANK`` best, or half of the list if that is more (with all that
tie with the last) are reranked by cosine.

Layout
    pivots      a bounded sample of the data, one for ``PER_PIVOT`` rows up to
                ``MAX_PIVOTS``, sent to all workers: 32 MB at most whatever the
                size of the collection.  Many pivots are searched in two levels
    postings    (list, id ++ prefix ++ 12-bit code): one shuffle, ``prefix`` copies at
                most; a vector close to a pivot is spared the lists of far ones
    lists       footrule and cosines by blocks of rows.  A list beyond ``block``
                postings is cut into blocks and its pairs of blocks become separate
                groups, so no task holds a hot list
    merge       a pair is emitted only by the smallest pivot both sides share,
                so every pair comes out once; each list returns its best ``k``
                per query and a window keeps the best ``k`` of those

Large groups of exact copies are searched once, through the copy with the
smallest id, and get their rows back at the end.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import grouping, kernels, runtime

#: Bounds of the number of pivots, and the number of vectors one pivot stands for.
MIN_PIVOTS, MAX_PIVOTS, PER_PIVOT = 16, 65535, 40
#: Length of the permutation prefix.
PREFIX = 10
#: A vector is not posted under pivots that are less similar than its nearest by more than this.
WITHIN = 0.15
#: Candidates of a vector in one list that go on from the footrule ranking to the cosines.
RERANK = 256
#: In a longer list this part of it goes on, so that long lists lose no more than short ones.
SHARE = 0.5
#: Stands for no pivot in a prefix.
_NONE = 0xFFFF
#: Rows from which a group of equal vectors is searched once only.
COPIES = 16
#: Postings of one list that one group holds.
BLOCK = 8192


def pivot_count(rows: int) -> int:
    """In proportion to the collection, within the fixed bounds."""
    return int(min(MAX_PIVOTS, max(MIN_PIVOTS, rows // PER_PIVOT)))


def encoded(df: DataFrame, id_col: str, vector_col: str, dim: int, dtype: type = np.int16) -> DataFrame:
    """(id, code) of the usable vectors; rows with a null id are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = kernels.list_matrix(batch.column(1), dim)
            yield pa.record_batch(
                [batch.column(0).take(pa.array(rows)), grouping.to_binary(kernels.codes(kernels.unit(values), dtype))],
                ["id", "code"],
            )

    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v"))
    return source.filter("id IS NOT NULL AND v IS NOT NULL").mapInArrow(run, "id long, code binary")


def draw(df: DataFrame, id_col: str, vector_col: str, dim: int, size: int, rows: int) -> np.ndarray:
    """int16 codes of at most ``size`` usable vectors, one per id, in the order of a hash of the id."""
    share = min(1.0, 1.3 * size / max(rows, 1) + 0.001)
    hashed = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.lit(17)), F.lit(1 << 20))
    part = df if share >= 1 else df.filter(hashed < int(share * (1 << 20)) + 1)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # an id that comes again and again fills no more than a row a batch
            _, first = np.unique(batch.column(0).to_numpy(), return_index=True)
            yield batch.take(pa.array(np.sort(first)))

    some = encoded(part, id_col, vector_col, dim).mapInArrow(once, "id long, code binary")
    got = some.orderBy(F.xxhash64("id", F.lit(17)), "id").limit(size).toArrow()
    if got.num_rows == 0:
        return np.empty((0, dim), np.int16)
    _, first = np.unique(got["id"].to_numpy(), return_index=True)
    return grouping.fixed_binary(got["code"], np.int16, dim)[np.sort(first)]


def distinct_units(sample: np.ndarray) -> np.ndarray:
    """The sample's different vectors, in its order."""
    _, first = np.unique(sample, axis=0, return_index=True)
    return kernels.decode(sample[np.sort(first)])


def without_copies(
    df: DataFrame, id_col: str, vector_col: str, dim: int, sample: np.ndarray, rows: int, dtype: type = np.int16
) -> tuple[DataFrame, DataFrame | None]:
    """(id, code) of the vectors, with large groups of equal ones once; and (id, rep) of the others of these groups.

    The sample shows which vectors come very often (it holds at least three of
    them); that decides how much is saved, never the result.  A group is stood
    for by its smallest id.  Groups the sample does not show stay as they are.
    """
    many, count = np.unique(sample, axis=0, return_counts=True)
    hot = many[(count >= 3) & (count * (rows / max(len(sample), 1)) >= COPIES)]
    if len(hot) == 0:
        return encoded(df, id_col, vector_col, dim, dtype), None
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast({row.tobytes(): k for k, row in enumerate(hot)})

    def run(inside: bool):
        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                code = grouping.fixed_binary(batch.column(1), np.int16, dim)
                number = np.array([known.get(row.tobytes(), -1) for row in code], np.int64)
                at = np.nonzero((number >= 0) == inside)[0]
                kept = batch.column(0).take(pa.array(at))
                if inside:
                    yield pa.record_batch([kept, pa.array(number[at])], ["id", "k"])
                else:
                    yield pa.record_batch([kept, grouping.to_binary(code[at])], ["id", "code"])

        return go

    exact = encoded(df, id_col, vector_col, dim)
    members = runtime.written(exact.mapInArrow(run(True), "id long, k long"), "copies")
    first = {r["k"]: r["id"] for r in members.groupBy("k").agg(F.min("id").alias("id")).collect()}  # one row a hot vector
    stand = spark.createDataFrame([(i, hot[k].tobytes()) for k, i in first.items()], "id long, code binary")
    reps = F.broadcast(spark.createDataFrame(list(first.items()), "k long, rep long"))
    copies = members.join(reps, "k").filter("id <> rep").select("id", "rep").distinct()
    coded = exact.mapInArrow(run(False), "id long, code binary").unionByName(stand)
    if dtype is not np.int16:
        coded = coded.mapInArrow(_recode(dim, dtype), "id long, code binary")
    return coded, runtime.written(copies, "copies")


def _recode(dim: int, dtype: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = kernels.decode(grouping.fixed_binary(batch.column(1), np.int16, dim)).astype(np.float64)
            yield pa.record_batch([batch.column(0), grouping.to_binary(kernels.codes(units, dtype))], ["id", "code"])

    return run


def block_counts(
    sample: np.ndarray, pivots: kernels.Pivots, prefix: int, rows: int, block: int = BLOCK, within: float | None = None
) -> np.ndarray:
    """Into how many blocks each list is cut, from the share of the sample it holds.

    The estimate decides only how even the work is, never the result.
    """
    lists = pivots.nearest(sample, prefix, within=within).ravel()
    held = np.bincount(lists[lists >= 0], minlength=len(pivots))
    return np.maximum(1, np.ceil(held * (rows / max(len(sample), 1)) / block)).astype(np.int64)


#: Pairs of blocks of one list are numbered below this.
_PAIRS = 1 << 30


def expand_blocks(lists: np.ndarray, ids: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, side, position in the input) of every posting.

    A list of one block is one group.  Of a list of R blocks, the posting goes
    to the R groups of the pairs of blocks that its own block is in.
    """
    count = blocks[lists]
    position = np.arange(len(lists))
    if (count == 1).all():
        return lists * _PAIRS, np.zeros(len(lists), np.int8), position
    position = np.repeat(position, count)
    other = np.arange(len(position)) - np.repeat(np.cumsum(count) - count, count)
    own = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)[position] % count[position]
    low, high = np.minimum(own, other), np.maximum(own, other)
    side = np.where(low == high, 0, np.where(own == low, 1, 2)).astype(np.int8)
    return lists[position] * _PAIRS + low * count[position] + high, side, position


def _postings(
    source: DataFrame, pivots: kernels.Pivots, blocks: np.ndarray, dim: int, prefix: int, within: float | None
) -> DataFrame:
    """(grp, entry): entry is the id, the side, the prefix as uint16 and the code in 12 bits a number."""
    shared = source.sparkSession.sparkContext.broadcast((pivots, blocks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, count = shared.value
        for batch in batches:
            code = grouping.fixed_binary(batch.column(1), np.int16, dim)
            ids = batch.column(0).to_numpy()
            for lo in range(0, len(ids), 4096):
                part = code[lo : lo + 4096]
                order = table.nearest(kernels.decode(part), prefix, within=within)
                short = kernels.pack12(np.rint(part * (2047 / 32767)))
                own = ids[lo : lo + 4096]
                none = np.zeros((len(part), 2), np.uint8)
                entry = np.concatenate(
                    [own.astype(np.int64).view(np.uint8).reshape(-1, 8), none, order.astype(np.uint16).view(np.uint8), short], axis=1
                )
                who, place = np.nonzero(order >= 0)
                group, side, position = expand_blocks(order[who, place], own[who], count)
                entry = entry[who[position]]
                entry[:, 8] = side
                yield pa.record_batch([pa.array(group), grouping.to_binary(entry)], ["grp", "entry"])

    return source.mapInArrow(run, "grp long, entry binary")


def footrule(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Footrule distance of pairs of prefixes, row by row.

    A pivot that one prefix of length l lacks is placed at l+1 there.  So the
    distance is l(l+1), less 2 min(l+1-i, l+1-j) for every common pivot, i and j
    being its places.
    """
    length = left.shape[1]
    common = (left[:, :, None] == right[:, None, :]) & (left != _NONE)[:, :, None]
    place = np.arange(length)
    gain = length - np.maximum(place[:, None], place[None, :])
    return length * (length + 1) - 2 * (common * gain).sum((1, 2))


def _smaller_common(pa_: np.ndarray, pb_: np.ndarray, pivot: int) -> np.ndarray:
    """Row-wise: whether the two prefixes share a pivot smaller than ``pivot``."""
    same = pa_[:, :, None] == pb_[:, None, :]
    return (same & (pa_ < pivot)[:, :, None]).any((1, 2))  # no pivot is never below one


def footrule_gains(order: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """What the common pivots take off the footrule distance, halved: rows ``lo`` to ``hi`` against all.

    The distance of two prefixes of length l is l(l+1) less twice this, so the
    ranking by it from above is the ranking by the distance from below.
    """
    length = order.shape[1]
    own = order[lo:hi]
    known = np.unique(own[own != _NONE])
    place = np.full(1 << 16, len(known), np.int64)  # the last row stands for the pivots that no query has
    place[known] = np.arange(len(known))
    weight = np.zeros((len(known) + 1, len(order)), np.uint8)
    columns = np.arange(len(order))
    for t in range(length):
        weight[place[order[:, t]], columns] = length - t
    weight[-1] = 0
    gain = np.zeros((hi - lo, len(order)), np.uint8)
    for t in range(length):
        gain += np.minimum(weight[place[own[:, t]]], np.uint8(length - t))
    return gain


def list_pairs(
    table: pa.Table, dim: int, prefix: int, threshold: float, rerank: int, share: float = 0.0, rows: int = 256
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, i, j, cosine) per block of rows of one inverted file.

    Every row's candidates are ranked by footrule distance; the best ``rerank``, or ``share``
    of the list if that is more, and those as near as the last of them are reranked by cosine.  Pairs at the cosine
    or above come out, in both directions, that no smaller common pivot brings.
    """
    entry = grouping.fixed_binary(table["entry"], np.uint8, 10 + 2 * prefix + dim // 2 * 3)
    ids = np.ascontiguousarray(entry[:, :8]).view(np.int64)[:, 0]
    ids, first = np.unique(ids, return_index=True)
    entry = entry[first]
    side = entry[:, 8]
    order = np.ascontiguousarray(entry[:, 10 : 10 + 2 * prefix]).view(np.uint16)
    vectors = kernels.decode(kernels.unpack12(np.ascontiguousarray(entry[:, 10 + 2 * prefix :])))
    pivot = table["grp"][0].as_py() // _PAIRS
    rerank = max(rerank, int(len(ids) * share))
    for lo in range(0, len(ids), rows):
        hi = min(lo + rows, len(ids))
        score = vectors[lo:hi] @ vectors.T
        near = score >= threshold - 1e-5
        if len(ids) > rerank + 1:
            gain = footrule_gains(order, lo, hi)
            at = len(ids) - rerank - 1  # the row itself is one of those above
            near &= gain >= np.partition(gain, at, axis=1)[:, at : at + 1]
        i, j = np.nonzero(near)
        cosine = np.round(np.minimum(score[i, j], 1.0).astype(np.float64), 6)
        i = i + lo
        keep = (i != j) & (cosine >= threshold) & ((side[i] == 0) | (side[i] != side[j]))
        i, j, cosine = i[keep], j[keep], cosine[keep]
        keep = ~_smaller_common(order[i], order[j], pivot)
        yield ids, i[keep], j[keep], cosine[keep]


def _best(ids: np.ndarray, i: np.ndarray, j: np.ndarray, cosine: np.ndarray, k: int) -> list[np.ndarray]:
    """The first ``k`` per query by cosine descending, then id."""
    order = np.lexsort((ids[j], -cosine, i))
    i, j, cosine = i[order], j[order], cosine[order]
    if len(i) == 0:
        return [ids[i], ids[j], cosine]
    starts = np.concatenate([[0], np.nonzero(np.diff(i))[0] + 1])
    place = np.arange(len(i)) - np.repeat(starts, np.diff(np.append(starts, len(i))))
    keep = place < k
    return [ids[i[keep]], ids[j[keep]], cosine[keep]]


def similar_vectors(
    df: DataFrame,
    id_col: str = "data_index",
    vector_col: str = "embs",
    dim: int = 128,
    k: int = 5,
    threshold: float = 0.7,
    prefix: int = PREFIX,
    within: float | None = WITHIN,
    rerank: int = RERANK,
    pivots: int | None = None,
    exact: bool = False,
) -> DataFrame:
    """(q, rk, n, cosine): up to ``k`` most similar other vectors of every vector.

    ``cosine`` is rounded to 6 decimals; it comes from codes of 12 bits a number,
    within about 3e-4 of the true one, or, with ``exact``, from the vectors themselves
    (the members of the lists stay, their order and the threshold are exact then).
    Rank is by cosine descending, then id ascending.

    Approximate: a neighbour is missed if the two share none of their ``prefix``
    nearest pivots (those within ``within`` of the nearest one's similarity), or if,
    in the list where they meet, ``rerank`` others, and half of the list, are nearer by
    footrule distance.

    Null, short, long, zero and non-finite vectors and null ids have no rows and
    are nobody's neighbour.  An id that comes several times counts once.  An
    empty table gives an empty result.  Other columns are ignored, whatever
    their names.  ``dim`` is even.
    """
    spark = df.sparkSession
    rows = df.count()
    count = pivots or pivot_count(rows)
    drawn = draw(df, id_col, vector_col, dim, count + count // 2, rows)
    if len(drawn) == 0:
        return spark.createDataFrame([], "q long, rk int, n long, cosine double")
    sample = distinct_units(drawn)
    table = kernels.Pivots(sample[:count])
    prefix = min(prefix, len(table))
    blocks = block_counts(sample, table, prefix, rows, within=within)
    single, copies = without_copies(df, id_col, vector_col, dim, drawn, rows)

    def search(group: pa.Table) -> Iterable[pa.RecordBatch]:
        parts = [_best(*found, k) for found in list_pairs(group, dim, prefix, threshold, rerank, SHARE)]
        if sum(len(p[0]) for p in parts):
            q, n, cosine = (np.concatenate(x) for x in zip(*parts))
            yield pa.record_batch([q, n, np.rint(cosine * 1e6).astype(np.int32)], ["q", "n", "millionths"])

    postings = _postings(single, table, blocks, dim, prefix, within)
    found = grouping.map_groups(
        postings, "grp", search, "q long, n long, millionths int", runtime.fan_out(df, copies=prefix * 0.4)
    )
    ranked = Window.partitionBy("q").orderBy(F.col("millionths").desc(), "n")
    top = found.withColumn("rk", F.row_number().over(ranked)).filter(F.col("rk") <= k)
    top = top.select("q", "rk", "n", (F.col("millionths") / F.lit(1e6)).alias("cosine"))
    top = _with_copies(top, copies, k)
    return _exactly(top, df, id_col, vector_col, dim, threshold) if exact else top


def _exactly(top: DataFrame, df: DataFrame, id_col: str, vector_col: str, dim: int, threshold: float) -> DataFrame:
    """The lists with cosines of the vectors themselves, each unordered pair computed once."""
    from .pigeonring import exact_units, scored

    top = runtime.written(top.select("q", "n"), "neighbours")
    pairs = top.select(F.least("q", "n").alias("a"), F.greatest("q", "n").alias("b")).distinct()
    units = exact_units(df, id_col, vector_col, dim).dropDuplicates(["id"])
    true = scored(pairs, units, dim, np.float32).select("a", "b", F.round("cosine", 6).alias("cosine"))
    both = true.select(F.col("a").alias("q"), F.col("b").alias("n"), "cosine").unionByName(
        true.select(F.col("b").alias("q"), F.col("a").alias("n"), "cosine")
    )
    ranked = Window.partitionBy("q").orderBy(F.col("cosine").desc(), "n")
    return (
        top.join(both, ["q", "n"])
        .filter(F.col("cosine") >= threshold)
        .withColumn("rk", F.row_number().over(ranked))
        .select("q", "rk", "n", "cosine")
    )


def _with_copies(top: DataFrame, copies: DataFrame | None, k: int) -> DataFrame:
    """Neighbour lists of representatives carried over to all copies.

    A list needs only the ``k`` smallest ids of a group of copies (and one more
    for members of the group itself), so a group of any size adds ``k`` rows a
    list at most.
    """
    if copies is None:
        return top
    order = Window.partitionBy("rep").orderBy("id")
    firsts = copies.withColumn("o", F.row_number().over(order)).filter(F.col("o") <= k)
    grouped = firsts.groupBy("rep").agg(F.array_sort(F.collect_list("id")).alias("more"))
    grouped = grouped.select("rep", F.array_insert("more", 1, F.col("rep")).alias("ids"))
    # neighbours: a representative stands for the first ids of its group
    wide = top.join(grouped, top["n"] == grouped["rep"], "left").select(
        "q", F.explode(F.coalesce("ids", F.array("n"))).alias("n"), "cosine"
    )
    # a member's own group comes at cosine 1
    own = grouped.select(F.col("rep").alias("q"), F.explode("ids").alias("n"), F.lit(1.0).alias("cosine"))
    lists = wide.unionByName(own)
    members = copies.select(F.col("id").alias("m"), "rep")
    also = lists.join(members, lists["q"] == members["rep"]).select(F.col("m").alias("q"), "n", "cosine")
    ranked = Window.partitionBy("q").orderBy(F.col("cosine").desc(), "n")
    return (
        lists.unionByName(also)
        .filter("q <> n")
        .withColumn("rk", F.row_number().over(ranked))
        .filter(F.col("rk") <= k)
        .select("q", "rk", "n", "cosine")
    )


def neighbour_pairs(neighbours: DataFrame) -> DataFrame:
    """(index_a, index_b): pairs of which at least one is in the other's list."""
    return neighbours.select(
        F.least("q", "n").alias("index_a"), F.greatest("q", "n").alias("index_b")
    ).distinct()
