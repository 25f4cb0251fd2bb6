"""Connected components of link tables, labelled by the smallest member.

Partitions first reduce their own links to spanning stars (at most one link per
node seen).  The rest is the alternating large-star / small-star scheme (Kiveris
et al., 2014): every round is two grouped aggregations with map-side combining,
written to the shared checkpoint folder so that plans and their size estimates
stay small.  The loop ends when a round changes nothing, compared by the
number of links and a sum of hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import kernels, runtime

#: Links a partition reduces at a time.
CHUNK = 1 << 20


def local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of a partition as stars of their local components."""
    held: list[pa.RecordBatch] = []
    size = 0

    def reduced() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        a, b = table["a"].to_numpy(), table["b"].to_numpy()
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = nodes[kernels.forest(place[: len(a)], place[len(a) :], len(nodes))]
        keep = root != nodes
        return pa.record_batch([root[keep], nodes[keep]], ["a", "b"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CHUNK:
            yield reduced()
            held, size = [], 0
    if size:
        yield reduced()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, label) for every node with a link to another node; the label is the smallest node.

    Links with a null end and links of a node to itself are left out.  An empty
    table gives an empty result.
    """
    pairs = links.select(
        F.least(F.col(a), F.col(b)).cast("long").alias("a"), F.greatest(F.col(a), F.col(b)).cast("long").alias("b")
    ).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") < F.col("b")))
    edges = runtime.written(pairs.mapInArrow(local_stars, "a long, b long").distinct(), "cc")
    spark = links.sparkSession
    before = _mark(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: every larger neighbour moves to the smallest of the neighbourhood
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, F.col("a") == F.col("x")).select(F.col("m").alias("a"), "b").distinct()
        # small star: every node and its smaller neighbours move to the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("x"), "m")
        moved = large.join(least, F.col("b") == F.col("x")).select("m", "a", "b")
        small = moved.select(F.col("m").alias("a"), "b").unionByName(
            moved.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        )
        after = runtime.written(small.distinct(), "cc")
        mark = _mark(after)
        runtime.discard(spark, edges)
        edges = after
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    roots = edges.select("a").distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(
        roots.select(F.col("a").alias("node"), F.col("a").alias("label"))
    )


def labelled(nodes: DataFrame, links: DataFrame, key: str = "id") -> DataFrame:
    """(id, label) for all ``nodes``; those without a link are their own label."""
    found = connected_components(links)
    ids = nodes.select(F.col(key).cast("long").alias("id")).distinct()
    return ids.join(found, ids["id"] == found["node"], "left").select("id", F.coalesce("label", "id").alias("label"))
