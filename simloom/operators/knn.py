"""Exact top-k neighbours by inner product of unit vectors.

``exact_topk`` works in blocks: the corpus is cut into blocks by a hash of the
id, every query meets every block (one BLAS product per pair of query batch and
block), each task keeps the best k per query, and a window merges the blocks'
lists.  The global top k is among the blocks' top k, so the result is exact and
no task ever holds more than one block and one batch of queries.  The work is
quadratic by definition; the llm package has an approximate search.

``exact_topk_sql`` is the same in plain expressions, for small inputs.

Order: the query itself first, then similarity (rounded to 6 decimals)
descending, then id.  No padding rows if there are fewer than k vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import grouping, kernels, runtime
from ..functions import vectors

#: Bytes of the vectors of a block: a vector is sent to as many tasks as there are blocks.
BLOCK_BYTES = 64 << 20
#: Vectors below which a block is not cut to keep all cores busy, and entries of the scores held at a time.
LEAST, SCORES = 2048, 1 << 22


def block_count(rows: int, dim: int, cores: int, block: int | None = None) -> int:
    """Blocks of ``block`` vectors or ``BLOCK_BYTES``; of a smaller table as many as give every core a pair of them."""
    most = block or max(1, BLOCK_BYTES // (8 * dim))
    spread = 1 if block else min(-(-rows // LEAST), int(np.ceil(cores**0.5)))
    return max(1, -(-rows // most), spread)


def ranked(df: DataFrame, k: int, *by: str) -> DataFrame:
    """(q, rk, n, sim) with the best ``k`` per query (and ``by``) out of candidate rows (q, n, sim)."""
    order = Window.partitionBy(*by, "q").orderBy((F.col("q") != F.col("n")).cast("int"), F.col("sim").desc(), "n")
    return df.withColumn("rk", F.row_number().over(order)).filter(F.col("rk") <= k).select(*by, "q", "rk", "n", "sim")


def first_columns(key: np.ndarray, take: int) -> np.ndarray:
    """Row by row, the columns of the ``take`` largest entries, largest first, ties by column."""
    count = key.shape[1]
    if take >= count:
        return np.argsort(-key, axis=1, kind="stable")
    least = np.partition(key, count - take, axis=1)[:, count - take]
    i, j = np.nonzero(key >= least[:, None])  # columns ascend, so a stable sort settles ties
    order = np.lexsort((-key[i, j], i))
    i, j = i[order], j[order]
    place = np.arange(len(i)) - np.searchsorted(i, np.arange(len(key)))[i]
    return j[place < take].reshape(len(key), take)


def exact_topk_sql(
    df: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The search as a cross join of expressions; quadratic rows, for small inputs and as a reference."""
    unit = df.filter(F.col(vector_col).isNotNull()).select(
        F.col(id_col).alias("id"), vectors.l2_normalize(vector_col).alias("v")
    )
    left = unit.select(F.col("id").alias("q"), F.col("v").alias("x"))
    right = unit.select(F.col("id").alias("n"), F.col("v").alias("y"))
    pairs = left.crossJoin(right).select("q", "n", F.round(vectors.inner_product("x", "y"), 6).alias("sim"))
    return ranked(pairs, k)


def exact_topk(
    df: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int | None = None,
    least: float | None = None,
    corpus: Column | None = None,
    shard_size: int | None = None,
) -> DataFrame:
    """(q, rk, n, sim): the exact ``k`` nearest of every vector, itself included.

    ``least`` leaves out hits below it, after ranking.  ``corpus``, a condition on
    the column id, limits what is searched, not what searches.  With ``shard_size``
    every vector has ``k`` hits in each shard (column ``shard``) of so many ids, all of
    one pass.  Zero vectors have
    similarity 0 to all and are kept.  Null, non-finite and empty vectors and
    null ids raise; so do vectors of unlike lengths: a search that silently
    skips rows would shift every index that follows.
    """
    checked = df.select(F.col(id_col).cast("long").alias("id"), vectors.as_double(vector_col).alias("v"))
    bounds = checked.agg(
        F.count("*").alias("rows"),
        F.min(F.size("v")).alias("lo"),
        F.max(F.size("v")).alias("hi"),
        F.count_if(
            F.col("id").isNull()
            | F.col("v").isNull()
            | F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
        ).alias("bad"),
    ).first()
    schema = "q long, n long, sim double" + (", shard int" if shard_size else "")
    if bounds["rows"] == 0:
        return df.sparkSession.createDataFrame([], ("shard int, " if shard_size else "") + "q long, rk int, n long, sim double")
    if bounds["bad"] or bounds["lo"] != bounds["hi"] or bounds["lo"] < 1:
        raise ValueError(f"vectors must be finite and of one length: {bounds['bad']} bad rows, lengths {bounds['lo']} to {bounds['hi']}")
    dim = bounds["lo"]
    blocks = block_count(bounds["rows"], dim, df.sparkSession.sparkContext.defaultParallelism, block)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
            norm = np.sqrt((flat * flat).sum(1, keepdims=True))
            yield pa.record_batch([batch.column(0), grouping.to_binary(flat / (norm + vectors.EPS))], ["id", "code"])

    unit = checked.mapInArrow(coded, "id long, code binary")
    part = F.pmod(F.xxhash64("id"), F.lit(blocks))
    # group (i, j): queries of block i against the corpus of block j
    pair = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = unit.withColumn("i", part).withColumn("j", pair).withColumn("role", F.lit(0).cast("byte"))
    searched = unit if corpus is None else unit.filter(corpus)
    corpus = searched.withColumn("j", part).withColumn("i", pair).withColumn("role", F.lit(1).cast("byte"))
    both = queries.select("i", "j", "role", "id", "code").unionByName(corpus.select("i", "j", "role", "id", "code"))
    both = both.select((F.col("i") * blocks + F.col("j")).alias("grp"), "role", "id", "code")

    def search(group: pa.Table) -> Iterator[pa.RecordBatch]:
        role, ids = group["role"].to_numpy(), group["id"].to_numpy()
        vec = grouping.fixed_binary(group["code"], np.float64, dim)
        order = np.argsort(ids, kind="stable")
        q, n = order[role[order] == 0], order[role[order] == 1]
        if len(q) == 0 or len(n) == 0:
            return
        shard = ids[n] // shard_size if shard_size else np.zeros(len(n), np.int64)
        for part in np.unique(shard):
            some = n[shard == part]
            take = min(k, len(some))
            step = max(1, SCORES // len(some))
            for lo in range(0, len(q), step):
                at = q[lo : lo + step]
                score = np.round(vec[at] @ vec[some].T, 6)
                # ids ascend along the row
                best = first_columns(np.where(ids[at][:, None] == ids[some][None, :], np.inf, score), take)
                hits = [np.repeat(ids[at], take), ids[some][best].ravel(), np.take_along_axis(score, best, 1).ravel() + 0.0]
                if shard_size:
                    hits.append(np.full(len(hits[0]), part, np.int32))
                yield pa.record_batch(hits, ["q", "n", "sim", "shard"][: len(hits)])

    found = grouping.map_groups(both, "grp", search, schema, max(runtime.shuffle_partitions(df.sparkSession), blocks * blocks))
    top = ranked(found, k, *(["shard"] if shard_size else []))
    return top if least is None else top.filter(F.col("sim") >= least)


def preceded(
    old: DataFrame, new: DataFrame, threshold: float, id_col: str = "id", vector_col: str = "embedding", block: int | None = None
) -> DataFrame:
    """(id): vectors of ``new`` with a smaller id, in ``old`` or ``new``, more similar than ``threshold``.

    Exact, in blocks, as :func:`exact_topk`, but by existence and not by lists: however many
    partners a vector has, none is left out.  Raises on the same unusable rows.
    """
    schema = "id long, code binary"
    make = lambda df: df.select(F.col(id_col).cast("long").alias("id"), vectors.as_double(vector_col).alias("v"))
    new, every = make(new), make(old).unionByName(make(new))
    bad = F.col("id").isNull() | F.col("v").isNull() | F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    bounds = every.agg(
        F.count("*").alias("rows"), F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi"), F.count_if(bad).alias("bad")
    ).first()
    if bounds["rows"] == 0:
        return new.select("id")
    if bounds["bad"] or bounds["lo"] != bounds["hi"] or bounds["lo"] < 1:
        raise ValueError(f"vectors must be finite and of one length: {bounds['bad']} bad rows, lengths {bounds['lo']} to {bounds['hi']}")
    dim = bounds["lo"]
    blocks = block_count(bounds["rows"], dim, new.sparkSession.sparkContext.defaultParallelism, block)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)
            norm = np.sqrt((flat * flat).sum(1, keepdims=True))
            yield pa.record_batch([batch.column(0), grouping.to_binary(flat / (norm + vectors.EPS))], ["id", "code"])

    part = F.pmod(F.xxhash64("id"), F.lit(blocks))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    place = lambda df, i, j, role: (
        df.mapInArrow(coded, schema).withColumn("i", i).withColumn("j", j)
        .select((F.col("i") * blocks + F.col("j")).alias("grp"), F.lit(role).cast("byte").alias("role"), "id", "code")
    )
    both = place(new, part, other, 0).unionByName(place(every, other, part, 1))

    def search(group: pa.Table) -> Iterator[pa.RecordBatch]:
        role, ids = group["role"].to_numpy(), group["id"].to_numpy()
        vec = grouping.fixed_binary(group["code"], np.float64, dim)
        q, n = np.nonzero(role == 0)[0], np.nonzero(role == 1)[0]
        step = max(1, SCORES // max(len(n), 1))
        for lo in range(0, len(q), step):
            at = q[lo : lo + step]
            close = (np.round(vec[at] @ vec[n].T, 6) > threshold) & (ids[n][None, :] < ids[at][:, None])
            yield pa.record_batch([ids[at][close.any(1)]], ["id"])

    partitions = max(runtime.shuffle_partitions(new.sparkSession), blocks * blocks)
    return grouping.map_groups(both, "grp", search, "id long", partitions).distinct()


def merge_shards(knn: DataFrame, k: int) -> DataFrame:
    """The best ``k`` per query out of the hit lists of several shards; a hit listed twice counts once."""
    return ranked(knn.groupBy("q", "n").agg(F.max("sim").alias("sim")), k)


def sharded_topk(
    df: DataFrame, k: int, shards: int, shard_size: int, id_col: str = "vec_id", vector_col: str = "embedding", first: int = 0
) -> DataFrame:
    """(shard, q, rk, n, sim): every vector's top ``k`` in each shard of the corpus.

    Shard s holds the ids from s * shard_size on; the ids of a shard's hits are
    those of the whole collection.  Only the shards from ``first`` on are searched.  Exact, in blocks, as :func:`exact_topk`.
    """
    inside = (F.col("id") >= first * shard_size) & (F.col("id") < shards * shard_size)
    return exact_topk(df, k, id_col, vector_col, corpus=inside, shard_size=shard_size)


def to_long(knn: DataFrame, q: str, scores: str, indices: str, offset: int = 0) -> DataFrame:
    """Wide hit lists (one array of scores and one of indices per query) as rows (q, rk, n, sim).

    Ranks are from 1; padding (negative indices) is left out; ``offset`` is
    added to the indices of a shard's list.
    """
    zipped = F.posexplode(F.arrays_zip(F.col(scores).alias("s"), F.col(indices).alias("i"))).alias("rk", "z")
    return (
        knn.select(F.col(q).alias("q"), zipped)
        .filter("z.i >= 0")
        .select("q", (F.col("rk") + 1).alias("rk"), (F.col("z.i") + offset).cast("long").alias("n"), F.col("z.s").cast("double").alias("sim"))
    )

