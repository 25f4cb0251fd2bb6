"""Groups of hit lists by named policies, and what is reported of them.

``wall``    removed ids cut all their links; ids that stay without a link are
            groups of one (sim >= threshold)
``plain``   no removal: every id is in a group (sim >= threshold)
``bridge``  a removed id still joins those of its hits that stay; ids without any
            hit above the threshold are in no group (sim > threshold)

Groups are (group_id, member): members ascending, groups numbered from 0 in the
order of their smallest member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import runtime
from .components import connected_components, labelled
from .removal import links


def numbered(labels: DataFrame) -> DataFrame:
    """(group_id, member) out of (id, label).

    Labels are numbered by ranges: sorted in slices whose sizes are summed up, so
    no task sorts them all.
    """
    roots = labels.select("label").distinct()
    sliced = runtime.written(roots.repartitionByRange("label").withColumn("slice", F.spark_partition_id()), "roots")
    sizes = sliced.groupBy("slice").agg(F.count("*").alias("c"))
    upto = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("slice", F.coalesce(F.sum("c").over(upto), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("slice").orderBy("label")) - 1
    ids = sliced.withColumn("place", inside).join(F.broadcast(base), "slice")
    ids = ids.select("label", (F.col("base") + F.col("place")).cast("long").alias("group_id"))
    return labels.join(ids, "label").select("group_id", F.col("id").alias("member"))


def wall_groups(knn: DataFrame, nodes: DataFrame, removed: DataFrame, threshold: float, key: str = "id") -> DataFrame:
    """Groups of the ids that stay, with removed ids as walls."""
    gone = removed.select("id")
    edges = links(knn, threshold)
    edges = edges.join(gone.withColumnRenamed("id", "a"), "a", "left_anti")
    edges = edges.join(gone.withColumnRenamed("id", "b"), "b", "left_anti").select("a", "b")
    stay = nodes.select(F.col(key).cast("long").alias("id")).join(gone, "id", "left_anti")
    return numbered(labelled(stay, edges))


def plain_groups(knn: DataFrame, nodes: DataFrame, threshold: float, key: str = "id") -> DataFrame:
    """Groups of all ids."""
    return numbered(labelled(nodes.select(F.col(key).alias("id")), links(knn, threshold)))


def star_rows(knn: DataFrame, removed: DataFrame, threshold: float) -> DataFrame:
    """(q, member): per query its hits above the threshold that stay, and the query if it stays and has any."""
    stay = knn.filter(F.col("sim") > threshold).select("q", "n")
    stay = stay.join(removed.select(F.col("id").alias("n")), "n", "left_anti").select("q", "n")
    own = stay.select("q").distinct().join(removed.select(F.col("id").alias("q")), "q", "left_anti")
    return stay.select("q", F.col("n").alias("member")).unionByName(own.select("q", F.col("q").alias("member"))).distinct()


def merge_lists(rows: DataFrame) -> DataFrame:
    """Lists (q, member) that share a member, merged into groups (group_id, member)."""
    first = rows.groupBy("q").agg(F.min("member").alias("a"))
    edges = rows.join(first, "q").select("a", F.col("member").alias("b"))
    members = rows.select(F.col("member").alias("id")).distinct()
    return numbered(labelled(members, edges))


def bridge_groups(knn: DataFrame, removed: DataFrame, threshold: float) -> DataFrame:
    """Groups of the ids that stay, with removed ids as bridges."""
    return merge_lists(star_rows(knn, removed, threshold))


def sizes(groups: DataFrame) -> DataFrame:
    """(group_id, size)."""
    return groups.groupBy("group_id").agg(F.count("*").alias("size"))


def size_histogram(groups: DataFrame) -> DataFrame:
    """(size, groups): how many groups there are of each size."""
    return sizes(groups).groupBy("size").agg(F.count("*").alias("groups"))


def size_band(groups: DataFrame, low: int, high: int) -> DataFrame:
    """Members of groups of ``low`` to ``high`` members."""
    band = sizes(groups).filter(F.col("size").between(low, high)).select("group_id")
    return groups.join(band, "group_id", "left_semi").select("group_id", "member")


def representatives(groups: DataFrame) -> DataFrame:
    """(group_id, member): the first member of every group."""
    return groups.groupBy("group_id").agg(F.min("member").alias("member"))


def preview(groups: DataFrame, top: int = 50, per_group: int | None = 10) -> DataFrame:
    """(rank, group_id, pos, member): the first members of the largest groups.

    Groups rank from 0 by size descending, then group id; ``top`` 0 gives nothing; without
    ``per_group`` all members of these groups come.  The largest groups are found by a top-n, not a sort of all.
    """
    order = sizes(groups).orderBy(F.col("size").desc(), "group_id").limit(top)
    rank = F.row_number().over(Window.orderBy(F.col("size").desc(), "group_id")) - 1  # over ``top`` rows
    chosen = order.withColumn("rank", rank).select("group_id", "rank")
    place = F.row_number().over(Window.partitionBy("group_id").orderBy("member")) - 1
    rows = groups.join(F.broadcast(chosen), "group_id").withColumn("pos", place)
    rows = rows if per_group is None else rows.filter(F.col("pos") < per_group)
    return rows.select("rank", "group_id", "pos", "member")


def summary(nodes: DataFrame, removed: DataFrame, groups: DataFrame) -> DataFrame:
    """One row (original, removed, groups, members, largest)."""
    total = nodes.agg(F.count("*").alias("original"))
    gone = removed.agg(F.count("*").alias("removed"))
    size = sizes(groups).agg(
        F.count("*").alias("groups"), F.coalesce(F.sum("size"), F.lit(0)).alias("members"), F.max("size").alias("largest")
    )
    return total.crossJoin(gone).crossJoin(size)


def nested(groups: DataFrame) -> DataFrame:
    """(group_id, members): ascending arrays.  One row per group: for groups that fit one row."""
    return groups.groupBy("group_id").agg(F.array_sort(F.collect_list("member")).alias("members"))


def components_of(edges: DataFrame) -> DataFrame:
    """(node, label) of a link table; see :mod:`simloom.operators.components`."""
    return connected_components(edges)
