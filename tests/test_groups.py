"""Search, removal and groups on hand-checked fixtures and against plain Python."""

import math
import random

import numpy as np
import pytest

from simloom.operators import clusters, components, knn, removal

DEG = math.pi / 180


def plane(spark, *degrees):
    data = [(i, [math.cos(d * DEG), math.sin(d * DEG)] if d is not None else [0.0, 0.0]) for i, d in enumerate(degrees)]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>")


def hits(spark, degrees, k):
    df = plane(spark, *degrees)
    return df.selectExpr("vec_id AS id"), knn.exact_topk(df, k)


def nested(groups):
    return [r["members"] for r in clusters.nested(groups).orderBy("group_id").collect()]


def wall(spark, degrees, k, dup, thr):
    nodes, found = hits(spark, degrees, k)
    gone = removal.component_removed(found, dup).select("id")
    return sorted(r[0] for r in gone.collect()), nested(clusters.wall_groups(found, nodes, gone, thr))


def bridge(spark, degrees, k, dup, thr):
    _, found = hits(spark, degrees, k)
    gone = removal.greedy_removed(found, dup)
    return sorted(r[0] for r in gone.collect()), nested(clusters.bridge_groups(found, gone, thr))


def test_removed_node_is_a_wall_or_a_bridge(spark):
    assert wall(spark, (0, 40, 20), 3, 0.9, 0.8) == ([1, 2], [[0]])
    assert bridge(spark, (0, 40, 20), 3, 0.9, 0.8) == ([2], [[0, 1]])


def test_removal_does_not_free_places_in_lists(spark):
    assert wall(spark, (0, 1, 30), 2, 0.9, 0.7) == ([1], [[0], [2]])


def test_zero_vectors_stay_alone_or_vanish(spark):
    assert wall(spark, (0, None, 90), 3, 0.9, 0.7) == ([], [[0], [1], [2]])
    assert bridge(spark, (0, None, 90), 3, 0.9, 0.7) == ([], [[0], [2]])


def test_one_of_exact_copies_stays(spark):
    assert wall(spark, (0, 0, 90), 3, 0.9, 0.7) == ([1], [[0], [2]])
    assert bridge(spark, (0, 0, 90), 3, 0.9, 0.7) == ([1], [[0], [2]])


def test_fewer_vectors_than_k_gives_no_padding(spark):
    assert knn.exact_topk(plane(spark, 0, 10, 20), 100).count() == 9


def test_threshold_itself(spark, rows):
    found = spark.createDataFrame([(0, 1, 0, 1.0), (0, 2, 1, 0.9)], "q long, rk int, n long, sim double")
    assert rows(removal.links(found, 0.9)) == [(0, 1)]
    assert rows(removal.links(found, 0.9, strict=True)) == []


def test_lists_of_blocks_equal_expressions(spark, rows):
    rng = np.random.default_rng(1)
    data = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(60)] + [(60, [0.0] * 8)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    want = rows(knn.exact_topk_sql(df, 4).selectExpr("q", "rk", "n", "sim + 0D"))
    assert rows(knn.exact_topk(df, 4)) == want
    assert rows(knn.exact_topk(df, 4, block=7)) == want


@pytest.mark.parametrize("vector", [None, [1.0], [1.0, float("nan")], [1.0, float("inf")]])
def test_search_refuses_bad_vectors(spark, vector):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, vector)], "vec_id long, embedding array<float>")
    with pytest.raises(ValueError):
        knn.exact_topk(df, 2)


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    found = knn.exact_topk(empty, 5)
    assert found.count() == 0
    assert removal.component_removed(found, 0.5).count() == 0
    assert removal.greedy_removed(found, 0.5).count() == 0
    assert clusters.plain_groups(found, empty.selectExpr("vec_id AS id"), 0.5).count() == 0


def scan(lists, thr, n):
    """The order-dependent scan, as a loop."""
    white, black = set(), set()
    for i in range(n):
        if i not in black:
            white.add(i)
        for j, s in lists[i]:
            if j == i or s <= thr:
                continue
            if j in white:
                if i not in white:
                    black.add(i)
            else:
                black.add(j)
    return black


def test_greedy_removal_is_the_scan(spark):
    rnd = random.Random(4)
    for _ in range(4):
        n = 30
        sim = [[0.0] * n for _ in range(n)]
        for i in range(n):
            for j in range(i):
                sim[i][j] = sim[j][i] = round(rnd.random(), 3)
        data, lists = [], []
        for i in range(n):
            order = sorted(range(n), key=lambda j: (j != i, -sim[i][j], j))[:6]
            lists.append([(j, 1.0 if i == j else sim[i][j]) for j in order])
            data += [(i, r + 1, j, s) for r, (j, s) in enumerate(lists[-1])]
        df = spark.createDataFrame(data, "q long, rk int, n long, sim double")
        assert {r[0] for r in removal.greedy_removed(df, 0.8).collect()} == scan(lists, 0.8, n)


def sharded_scan(lists, thr, n, shards, size):
    white, black = set(), set()
    for s in range(shards):
        for i in range(n):
            hits_ = lists[s][i]
            if hits_ and hits_[0][0] == i:
                if i not in black:
                    white.add(i)
                hits_ = hits_[1:]
            for j, v in hits_:
                if v <= thr:
                    continue
                if j in white:
                    if i not in white:
                        black.add(i)
                else:
                    black.add(j)
    return black


def test_sharded_removal_is_the_sharded_scan(spark):
    rnd = random.Random(9)
    for _ in range(3):
        n, shards, size = 24, 3, 8
        sim = [[0.0] * n for _ in range(n)]
        for i in range(n):
            for j in range(i):
                sim[i][j] = sim[j][i] = round(rnd.random(), 3)
        data, lists = [], []
        for s in range(shards):
            per = []
            for i in range(n):
                inside = range(s * size, (s + 1) * size)
                order = sorted(inside, key=lambda j: (j != i, -sim[i][j], j))[:4]
                per.append([(j, 1.0 if i == j else sim[i][j]) for j in order])
                data += [(s, i, r + 1, j, v) for r, (j, v) in enumerate(per[-1])]
            lists.append(per)
        df = spark.createDataFrame(data, "shard int, q long, rk int, n long, sim double")
        got = {r[0] for r in removal.sharded_removed(df, 0.85, shards, size).collect()}
        assert got == sharded_scan(lists, 0.85, n, shards, size)


def groups_of(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_of_paths_stars_and_noise(spark):
    rnd = random.Random(2)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)]
    pairs += [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(60)]
    pairs = [(a, b) for a, b in pairs if a != b]
    rnd.shuffle(pairs)
    df = spark.createDataFrame(pairs + [(7, 7), (None, 3), (4, None)] + pairs[:5], "a long, b long").repartition(5)
    got = {r["node"]: r["label"] for r in components.connected_components(df).collect()}
    assert got == groups_of(pairs)


def test_kept_ids_are_not_linked(spark):
    rng = np.random.default_rng(3)
    data = [(i, rng.standard_normal(4).astype(np.float32).tolist()) for i in range(80)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    found = knn.exact_topk(df, 80)
    gone = {r["id"] for r in removal.component_removed(found, 0.8).collect()}
    assert not [p for p in removal.links(found, 0.8).collect() if p["a"] not in gone and p["b"] not in gone]
    most = {r["id"] for r in removal.component_removed(found, 0.8, keep="max").collect()}
    assert len(most) == len(gone) and most != gone


def test_preview_ranks_by_size_then_number(spark, rows):
    groups = spark.createDataFrame([(0, 1), (1, 2), (1, 3), (2, 4), (2, 5)], "group_id long, member long")
    assert rows(clusters.preview(groups, 2, 1)) == [(0, 1, 0, 2), (1, 2, 0, 4)]
    assert clusters.preview(groups, 0).count() == 0
    assert rows(clusters.size_histogram(groups)) == [(1, 1), (2, 2)]
    assert rows(clusters.size_band(groups, 2, 9)) == [(1, 2), (1, 3), (2, 4), (2, 5)]
