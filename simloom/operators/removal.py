"""Links out of hit lists, and the removal of near-duplicates by named policies.

Hit lists are (q, rk, n, sim) rows, self first.  Thresholds are applied after
ranking: a filter under the top-k would change which hits the lists hold.

``component_removed``  keeps one member (smallest, largest) of every connected
                       component of the duplicate links, sim >= threshold
``greedy_removed``     the order-dependent scan in closed form, sim > threshold
``sharded_removed``    the same scan over per-shard lists, shard by shard
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import runtime
from .components import connected_components


def links(knn: DataFrame, threshold: float, strict: bool = False) -> DataFrame:
    """Distinct (a, b), a < b, of hits at the threshold (``strict``: above it).

    A link needs one of its ends to list the other, not both.
    """
    close = F.col("sim") > threshold if strict else F.col("sim") >= threshold
    return (
        knn.filter(close & (F.col("q") != F.col("n")))
        .select(F.least("q", "n").alias("a"), F.greatest("q", "n").alias("b"))
        .distinct()
    )


def component_removed(knn: DataFrame, threshold: float, keep: str = "min", strict: bool = False) -> DataFrame:
    """(id, kept): removed ids, and the member of their component that stays.

    ``keep`` is min, max or first (first is min: members are in ascending order).
    """
    if keep not in ("min", "max", "first"):
        raise ValueError("keep is min, max or first")
    found = connected_components(links(knn, threshold, strict))
    if keep == "max":
        top = found.groupBy("label").agg(F.max("node").alias("kept"))
        found = found.join(top, "label").select("node", "kept")
    else:
        found = found.select("node", F.col("label").alias("kept"))
    return found.filter("node <> kept").select(F.col("node").alias("id"), "kept")


def greedy_removed(knn: DataFrame, threshold: float) -> DataFrame:
    """(id): ids removed by the greedy scan.

    The scan goes through the ids in ascending order; an id not yet removed stays
    and removes its hits above the threshold that do not stay already.  With
    self first in every list this is: an id goes if any smaller id lists it above
    the threshold, removed or not.
    """
    return knn.filter((F.col("sim") > threshold) & (F.col("n") > F.col("q"))).select(F.col("n").alias("id")).distinct()


def sharded_removed(sharded: DataFrame, threshold: float, shards: int, shard_size: int) -> DataFrame:
    """(id): ids removed by the greedy scan over per-shard lists, shards in ascending order.

    ``sharded`` has (shard, q, n, sim).  An id of a shard goes if a smaller id
    lists it in that shard; or if it lists, in an earlier shard, an id that stays
    there.  The second rule needs the earlier shards' result, so shards are
    evaluated one after the other.
    """
    close = sharded.filter((F.col("sim") > threshold) & (F.col("n") != F.col("q"))).select("shard", "q", "n")
    close = runtime.written(close, "shard-hits")
    home = lambda c: F.floor(F.col(c) / shard_size)
    removed = None
    for shard in range(shards):
        own = close.filter((F.col("shard") == shard) & (home("n") == shard) & (F.col("q") < F.col("n"))).select(
            F.col("n").alias("id")
        )
        if removed is not None:
            earlier = close.filter((F.col("shard") < shard) & (home("q") == shard) & (home("n") == F.col("shard")))
            staying = earlier.join(removed.withColumnRenamed("id", "n"), "n", "left_anti")
            own = own.unionByName(staying.select(F.col("q").alias("id")))
        now = own.distinct()
        removed = runtime.written(now if removed is None else removed.unionByName(now).distinct(), "removed")
    return removed
