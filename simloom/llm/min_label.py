"""Connected groups of pairwise matches: minimum labels with pointer jumping.

Each round every node takes the smallest label among its own and its
neighbours' (one map-side combined aggregation), the labels jump along
themselves (label of the label), and the links are rewritten to labels: links
inside a group vanish, repeated ones merge, so every round works on a smaller
graph.  The round's tables are written to the shared checkpoint folder; the
loop ends when no link is left, that is when no label would change.

Before the first shuffle each partition replaces its own links by a spanning
star per local group, at most one link per node it has seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import kernels, runtime

#: Links one partition holds before it reduces them.
CHUNK = 1 << 20


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def reduced(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = nodes[kernels.forest(place[: len(a)], place[len(a) :], len(nodes))]
        keep = root != nodes
        return pa.record_batch([root[keep], nodes[keep]], ["a", "b"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CHUNK:
            table = pa.Table.from_batches(held)
            star = reduced(table["a"].to_numpy(), table["b"].to_numpy())
            yield_now = star.num_rows > CHUNK // 2
            if yield_now:
                yield star
            held, size = ([], 0) if yield_now else ([star], star.num_rows)
    if size:
        table = pa.Table.from_batches(held)
        yield reduced(table["a"].to_numpy(), table["b"].to_numpy())


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node with a link to another node.

    ``label`` is the smallest node linked directly or indirectly, the node
    itself included.  Links with a null end and links of a node to itself say
    nothing and are left out; repeated links count once; an empty table gives an
    empty result.  Other columns are ignored.  Every round merges the larger end of
    every link left with a smaller node, so the rounds end by themselves, in about the
    logarithm of the longest path.
    """
    pairs = links.select(
        F.least(F.col(a), F.col(b)).cast("long").alias("a"), F.greatest(F.col(a), F.col(b)).cast("long").alias("b")
    ).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") < F.col("b")))
    edges = runtime.written(pairs.mapInArrow(_stars, "a long, b long").distinct(), "links")
    spark = links.sparkSession
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        jump = least.select(F.col("a").alias("x"), F.col("m").alias("y"))
        once = least.join(jump, F.col("m") == F.col("x")).select("a", F.col("y").alias("m"))
        step = runtime.written(once, "step")
        ends = step.select(F.col("a").alias("x"), F.col("m").alias("y"))
        left = edges.join(ends, F.col("a") == F.col("x")).select(F.col("y").alias("a"), "b")
        moved = left.join(ends, F.col("b") == F.col("x")).select("a", F.col("y").alias("b"))
        fewer = (
            moved.filter("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )
        fewer = runtime.written(fewer, "links")
        if labels is None:
            after = step.select(F.col("a").alias("node"), F.col("m").alias("label"))
        else:
            joined = labels.join(ends, F.col("label") == F.col("x"), "left")
            after = runtime.written(joined.select("node", F.coalesce("y", "label").alias("label")), "labels")
            runtime.discard(spark, step)
            runtime.discard(spark, labels)
        labels = after
        runtime.discard(spark, edges)
        edges = fewer
        if edges.isEmpty():
            return labels


def match_groups(
    hits: DataFrame,
    catalog: DataFrame,
    threshold: float = 0.9,
    q: str = "q",
    n: str = "hit_index",
    score: str = "cosine",
    key: str = "data_index",
) -> DataFrame:
    """(data_index, group_id): items with at least one match, by connected group.

    Two different catalog items match if some hit has one as ``q``, the other as
    ``n`` and a score of at least ``threshold``.  Null and NaN scores (Spark
    orders NaN above all numbers, so it is excluded by name), null ends, self
    hits, and hits outside the catalog are no match.
    """
    strong = hits.filter(
        (F.col(score) >= threshold) & ~F.isnan(F.col(score).cast("double")) & (F.col(q) != F.col(n))
    ).select(F.col(q).cast("long").alias("a"), F.col(n).cast("long").alias("b"))
    known = catalog.select(F.col(key).cast("long").alias("k")).filter("k IS NOT NULL").distinct()
    inside = strong.join(known, F.col("b") == F.col("k"), "left_semi").join(
        known.withColumnRenamed("k", "k2"), F.col("a") == F.col("k2"), "left_semi"
    )
    return connected(inside).select(F.col("node").alias(key), F.col("label").alias("group_id"))
