"""Class centroids and how far members diverge from them.

Means are sums per (class, position): the vectors are exploded by position only
after a partial sum per task and class, made in Arrow batches, so the shuffle
carries one row a class and task however many members a class has.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import grouping, runtime
from ..functions import vectors

#: Classes whose sums a task holds before it sends them on.
HELD = 4096


def _sums(held: dict[object, list]) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array(list(held), pa.int64()),
            pa.array([v[0] for v in held.values()], pa.string()),
            pa.array([v[1] for v in held.values()], pa.int64()),
            pa.array([v[2].tolist() for v in held.values()], pa.list_(pa.float64())),
        ],
        ["k", "class", "n", "total"],
    )


def centroids(df: DataFrame, class_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(class, n, centroid): mean vector and number of members of every class.

    Null classes are a class of their own; null vectors are left out; vectors of
    unlike lengths in one class raise.
    """
    kind = df.schema[class_col].dataType
    source = df.select(F.col(class_col).alias("class"), vectors.as_double(vector_col).alias("v")).filter("v IS NOT NULL")
    keyed = source.select(F.xxhash64("class").alias("k"), F.col("class").cast("string").alias("class"), "v")
    schema = "k long, class string, n long, total array<double>"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[object, list] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            name, key, column = batch.column(1), batch.column(0).to_numpy(), batch.column(2)
            lengths = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False)
            if (lengths != lengths[0]).any():
                raise ValueError("vectors of one class must be of one length")
            matrix = flat.reshape(len(lengths), lengths[0])
            found, first, place = np.unique(key, return_index=True, return_inverse=True)
            total = np.zeros((len(found), matrix.shape[1]))
            np.add.at(total, place, matrix)
            count = np.bincount(place, minlength=len(found))
            for i, k in enumerate(found.tolist()):
                if k in held:
                    held[k][1] += int(count[i])
                    held[k][2] = held[k][2] + total[i]
                else:
                    held[k] = [name[int(first[i])].as_py(), int(count[i]), total[i]]
            if len(held) >= HELD:
                yield _sums(held)
                held = {}
        if held:
            yield _sums(held)

    def merge(group: pa.Table) -> Iterable[pa.RecordBatch]:
        totals = [np.array(t) for t in group["total"].to_pylist()]
        if len({len(t) for t in totals}) > 1:
            raise ValueError("vectors of one class must be of one length")
        n = int(np.sum(group["n"].to_numpy()))
        mean = np.sum(totals, axis=0) / n
        yield pa.record_batch(
            [
                group["k"].combine_chunks()[:1],
                group["class"].combine_chunks()[:1],
                pa.array([n], pa.int64()),
                pa.array([mean.tolist()], pa.list_(pa.float64())),
            ],
            ["k", "class", "n", "centroid"],
        )

    partial = keyed.mapInArrow(sums, schema)
    merged = grouping.map_groups(
        partial, "k", merge, "k long, class string, n long, centroid array<double>", runtime.shuffle_partitions(df.sparkSession)
    )
    return merged.select(F.col("class").cast(kind).alias("class"), "n", "centroid")


def divergence(
    df: DataFrame, class_col: str = "label", vector_col: str = "embedding", id_col: str = "vec_id", decimals: int = 6
) -> DataFrame:
    """(class, id, score): cosine of every member to its class's centroid."""
    centre = centroids(df, class_col, vector_col).select("class", "centroid")
    rows = df.filter(F.col(vector_col).isNotNull()).select(
        F.col(class_col).alias("class"), F.col(id_col).alias("id"), F.col(vector_col).alias("v")
    )
    joined = rows.alias("r").join(centre.alias("c"), F.col("r.class").eqNullSafe(F.col("c.class")))
    score = F.round(vectors.cosine("v", "centroid"), decimals) + F.lit(0.0)
    return joined.select(F.col("r.class").alias("class"), "id", score.alias("score"))


def condition_vector(mid: str, final: str) -> F.Column:
    """``mid`` followed by the normalised ``final``: what conditioned centroids average."""
    return F.concat(vectors.as_double(mid), vectors.l2_normalize_guarded(final))


def condition_centroids(
    df: DataFrame, class_col: str, mid: str | None = None, final: str | None = None, joint: str | None = None
) -> DataFrame:
    """(class, n, centroid) of the concatenated vectors.

    Two policies: from ``mid`` and the raw ``final`` (normalised here), or from
    ``joint`` vectors, concatenated and normalised earlier.
    """
    vector = vectors.as_double(joint) if joint else condition_vector(mid, final)
    return centroids(df.select(F.col(class_col).alias("class"), vector.alias("v")), "class", "v")


def flush_groups(df: DataFrame, folder: str, order: str) -> DataFrame:
    """Numbers the runs of equal ``folder`` along ``order`` (column ``run``, from 1).

    A scan of sorted shards closes a folder where the next begins; a folder that
    comes back later is a run of its own.  Null folders are equal to each other; the
    values of ``order`` differ.  Rows are cut into range slices, each is numbered by
    itself, and the number of runs that begin before it is added: no task orders all rows.
    """
    placed = runtime.written(df.repartitionByRange(order).withColumn("_slice", F.spark_partition_id()), "runs")
    inside = Window.partitionBy("_slice").orderBy(order)
    begins = ~F.col(folder).eqNullSafe(F.lag(folder).over(inside)) & F.lag("_slice").over(inside).isNotNull()
    marked = placed.withColumn("_more", F.sum(begins.cast("long")).over(inside))  # runs begun after the slice's first
    sides = placed.groupBy("_slice").agg(F.min_by(folder, order).alias("_head"), F.max_by(folder, order).alias("_tail"))
    ends = marked.groupBy("_slice").agg(F.max("_more").alias("_inner")).join(sides, "_slice")
    along = Window.orderBy("_slice")  # one row a slice
    fresh = F.lag("_slice").over(along).isNull() | ~F.col("_head").eqNullSafe(F.lag("_tail").over(along))
    base = ends.withColumn("_fresh", fresh.cast("long")).select(
        "_slice",
        (
            F.sum("_fresh").over(along)
            + F.coalesce(F.sum("_inner").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ).alias("_base"),
    )
    return marked.join(F.broadcast(base), "_slice").withColumn("run", F.col("_base") + F.col("_more")).drop("_slice", "_base", "_more")
