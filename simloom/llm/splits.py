"""Splits that keep related records together, by random-mate contraction.

Folders that hold listings of one subject must stay together.  The links
between folders are contracted round by round: every vertex tosses a coin (a
hash of the vertex and the round); a vertex with tails joins its smallest
neighbour with heads; the links are rewritten to the joined vertices; loops and
repeats vanish.  In expectation a constant share of the linked vertices vanishes
per round, so rounds grow with the logarithm of the graph.  Each round is a few
SQL joins whose results are written to the shared checkpoint folder.  Unwinding
the rounds from the last to the first gives every vertex its component.

Components are then laid out in the order of a hash, and cut by their cumulative
number of listings at the split borders.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import runtime
from ..operators.listing import clean_listing

#: Share of all listings below which a component is placed by its hash order.
HEAVY = 0.001


def contract(links: DataFrame, seed: int = 11) -> DataFrame:
    """(node, component) for every end of a link; ``component`` is one node of the component.

    ``links`` has long columns a and b; rows with a null end or equal ends are
    left out; an empty table gives an empty result.  Rounds go on until no link is left.
    """
    spark = links.sparkSession
    edges = runtime.written(
        links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "mates",
    )
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = runtime.written(nodes, "vertices")
    moves: list[DataFrame] = []
    for number in itertools.count():
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        coin = lambda c: F.xxhash64(F.col(c), F.lit(seed + number)) % 2 == 0
        # a tails vertex takes its smallest heads neighbour
        moved = both.filter(~coin("a") & coin("b")).groupBy("a").agg(F.min("b").alias("mate"))
        moved = runtime.written(moved, "moves")
        moves.append(moved)
        one = moved.select(F.col("a").alias("x"), F.col("mate").alias("mx"))
        two = moved.select(F.col("a").alias("y"), F.col("mate").alias("my"))
        joined = (
            edges.join(one, edges["a"] == one["x"], "left")
            .join(two, edges["b"] == two["y"], "left")
            .select(F.coalesce("mx", "a").alias("a"), F.coalesce("my", "b").alias("b"))
            .filter("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )
        fewer = runtime.written(joined, "mates")
        runtime.discard(spark, edges)
        edges = fewer
    # unwind: from the last round back, every moved vertex takes the label of its mate
    where = None
    for moved in reversed(moves):
        if where is None:
            where = moved.select(F.col("a").alias("node"), F.col("mate").alias("component"))
        else:
            later = where.select(F.col("node").alias("m"), "component")
            here = moved.join(later, moved["mate"] == later["m"], "left").select(
                F.col("a").alias("node"), F.coalesce("component", "mate").alias("component")
            )
            where = runtime.written(where.unionByName(here), "unwound")
    if where is None:
        return nodes.select("node", F.col("node").alias("component"))
    return nodes.join(where, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def folder_components(listing: DataFrame) -> DataFrame:
    """(folder, component, n): every clean folder, its component and its number of listings.

    ``component`` is a row position of the component's folders.  Each distinct
    folder-subject pair counts once; the folders of one subject are linked in a
    star around its first folder, so a subject of any size adds one link a folder.
    """
    clean = clean_listing(listing)
    pairs = clean.groupBy("folder", "subject").agg(F.count("*").alias("n"), F.min("list_pos").alias("pos"))
    pairs = runtime.written(pairs, "folder-subjects")
    folders = pairs.groupBy("folder").agg(F.sum("n").alias("n"), F.min("pos").alias("fid"))
    folders = runtime.written(folders, "folders")
    coded = pairs.select("folder", "subject").join(folders.select("folder", "fid"), "folder").select("subject", "fid")
    first = coded.groupBy("subject").agg(F.min("fid").alias("a"), F.max("fid").alias("z")).filter("a < z")
    links = coded.join(first, "subject").select("a", F.col("fid").alias("b")).filter("a <> b")
    found = contract(links)
    return folders.join(found, folders["fid"] == found["node"], "left").select(
        "folder", F.coalesce("component", "fid").alias("component"), "n"
    )


def together(components: DataFrame) -> DataFrame:
    """(folder_a, folder_b): pairs of different folders in one component, a before b in byte order."""
    left = components.select("component", F.col("folder").alias("folder_a"))
    right = components.select("component", F.col("folder").alias("folder_b"))
    return left.join(right, "component").filter("folder_a < folder_b").select("folder_a", "folder_b")


def assign_splits(components: DataFrame, shares: DataFrame) -> DataFrame:
    """(folder, component, split_name): components given to splits in about the given fractions.

    Components are laid end to end on the unit interval by their share of all
    listings, the heaviest first (largest-first keeps the cut error below the
    weight of the component at a border), then by hash; a component belongs to
    the split its middle falls in.  The cumulative weight is taken in two levels:
    sums per slice of the order, then inside the slices, so no task sees the
    whole order.  Fractions are normalised to sum to one; splits without a
    positive fraction get nothing; without any split the result is empty.
    """
    total = components.agg(F.sum("n").alias("all"))
    weights = components.groupBy("component").agg(F.sum("n").alias("w")).crossJoin(F.broadcast(total))
    # slices of the order: heavier powers of two first, then hash buckets
    weights = weights.withColumn("level", F.floor(F.log2(F.col("all") / F.col("w")))).withColumn(
        "slice", F.when(F.col("w") < F.col("all") * HEAVY, F.pmod(F.xxhash64("component"), F.lit(64))).otherwise(0)
    )
    slices = weights.groupBy("level", "slice").agg(F.sum("w").alias("sw"))
    before = Window.orderBy("level", "slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("base", F.coalesce(F.sum("sw").over(before), F.lit(0))).drop("sw")
    inside = Window.partitionBy("level", "slice").orderBy(F.xxhash64("component"), "component")
    middle = (
        weights.join(slices, ["level", "slice"])
        .withColumn("upto", F.sum("w").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .select("component", ((F.col("base") + F.col("upto") - F.col("w") / 2) / F.col("all")).alias("x"))
    )
    good = shares.filter("fraction > 0 AND split_name IS NOT NULL").select("split_name", "fraction")
    order = Window.orderBy(F.col("fraction").desc(), "split_name").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cut = (
        good.withColumn("share", F.col("fraction") / F.sum("fraction").over(whole))
        .withColumn("hi", F.sum("share").over(order))
        .withColumn("lo", F.col("hi") - F.col("share"))
    )
    last = F.max("hi").over(whole)
    cut = cut.withColumn("hi", F.when(F.col("hi") == last, F.lit(2.0)).otherwise(F.col("hi"))).select(
        "split_name", "lo", "hi"
    )
    placed = middle.join(F.broadcast(cut), (F.col("x") >= F.col("lo")) & (F.col("x") < F.col("hi")))
    return components.join(placed.select("component", "split_name"), "component").select(
        "folder", "component", "split_name"
    )


def checked(listing: DataFrame, given: DataFrame, components: DataFrame, shares: DataFrame) -> DataFrame:
    """(split_name, fraction, near, folders, torn_folders, torn_subjects) of an assignment.

    ``near`` tells whether the split's share of the listings is off its fraction by no more
    than the heaviest component, which cannot be cut; ``folders`` counts the assigned
    folders, the torn ones stand in two splits.
    """
    placed = listing.join(given.select("folder", "split_name"), "folder")
    total = components.agg(F.sum("n").alias("all"))
    heaviest = components.groupBy("component").agg(F.sum("n").alias("w")).agg(F.max("w").alias("heaviest"))
    held = placed.groupBy("split_name").agg(F.count("*").alias("held"))
    torn = lambda by: (
        placed.select(by, "split_name").distinct().groupBy(by).agg(F.count("*").alias("c")).agg(F.count_if(F.col("c") > 1).alias(f"torn_{by}s"))
    )
    folders = given.agg(F.countDistinct("folder").alias("folders"))
    one = total.crossJoin(heaviest).crossJoin(folders).crossJoin(torn("folder")).crossJoin(torn("subject"))  # one row
    rows = shares.filter("fraction > 0").join(held, "split_name", "left").crossJoin(F.broadcast(one))
    off = F.abs(F.coalesce("held", F.lit(0)) - F.col("fraction") * F.col("all"))
    return rows.select(
        "split_name", "fraction", (off <= F.col("heaviest")).alias("near"), "folders", "torn_folders", "torn_subjects"
    )
