"""The two end-to-end pipelines, and their configuration.

``WallPlan``    one search; duplicates by component (>=); removed ids are walls
``BridgePlan``  one search, whole or by shards; greedy removal (>); removed ids are bridges

The search result is written once and read by both thresholds: the second pass
over the hit lists costs a scan, not a second search.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import runtime
from ..operators import clusters, knn, labels, removal, shards
from ..sources import readers
from ..sinks import writers


@dataclass(frozen=True)
class Config:
    """Parameters of a run; checked when made."""

    policy: str = "wall"
    duplicate: float | None = 0.9
    cluster: float = 0.7
    k: int = 100
    keep: str = "min"
    max_shard: int = shards.MAX_SHARD
    previews: int = 50
    per_preview: int = 10

    def __post_init__(self) -> None:
        if self.policy not in ("wall", "bridge"):
            raise ValueError("policy is wall or bridge")
        if self.k < 1 or self.max_shard < 1 or self.previews < 0 or self.per_preview < 0:
            raise ValueError("k and the shard size must be positive, previews not negative")
        for value in (self.duplicate, self.cluster):
            if value is not None and not -1 <= value <= 1:
                raise ValueError("thresholds are cosines")
        if self.keep not in ("min", "max", "first"):
            raise ValueError("keep is min, max or first")


@dataclass(frozen=True)
class Result:
    hits: DataFrame
    removed: DataFrame
    groups: DataFrame
    extra: dict = field(default_factory=dict)


#: Defaults of the two policies.
WALL = Config()
BRIDGE = Config(policy="bridge", duplicate=0.9, cluster=0.5)


def run(df: DataFrame, config: Config = WALL, id_col: str = "data_index", vector_col: str = "embedding") -> Result:
    """Search, removal and groups of a table of vectors."""
    spark = df.sparkSession
    nodes = df.select(df[id_col].cast("long").alias("id"))
    rows = nodes.count()
    sharded = config.policy == "bridge" and rows > config.max_shard
    if sharded:
        count = -(-rows // config.max_shard)
        hits = runtime.written(knn.sharded_topk(df, config.k, count, config.max_shard, id_col, vector_col), "hits")
    else:
        hits = runtime.written(knn.exact_topk(df, config.k, id_col, vector_col), "hits")
    none = spark.createDataFrame([], "id long")
    if config.duplicate is None:
        removed = none
    elif config.policy == "wall":
        removed = removal.component_removed(hits, config.duplicate, config.keep).select("id")
    elif sharded:
        removed = removal.sharded_removed(hits, config.duplicate, count, config.max_shard)
    else:
        removed = removal.greedy_removed(hits, config.duplicate)
    removed = runtime.written(removed, "removed")
    if config.policy == "bridge":
        groups = clusters.bridge_groups(hits, removed, config.cluster)
    elif config.duplicate is None:
        groups = clusters.plain_groups(hits, nodes, config.cluster)
    else:
        groups = clusters.wall_groups(hits, nodes, removed, config.cluster)
    return Result(hits, removed, runtime.written(groups, "groups"))


def process_hits(hits: DataFrame, config: Config, shard_count: int) -> Result:
    """Removal and groups out of stored per-shard hit lists (shard, q, rk, n, sim).

    All shards' removals are known before the first group is built.
    """
    if config.duplicate is None:
        removed = hits.sparkSession.createDataFrame([], "id long")
    else:
        removed = removal.sharded_removed(hits, config.duplicate, shard_count, config.max_shard)
    return Result(hits, removed, runtime.written(clusters.bridge_groups(hits, removed, config.cluster), "groups"))


def write_outputs(
    result: Result,
    items: DataFrame,
    folder: str,
    config: Config = WALL,
    path: str = "path",
    decode: Callable[[bytes], np.ndarray | None] | None = None,
) -> dict[str, str]:
    """Report, labels, group text and preview rows of a run, below a folder of our own.

    With ``decode`` the first readable images of the largest groups are written too, one folder a group.
    """
    spark = items.sparkSession
    writers.fresh_folder(spark, folder)
    removed = result.removed.count() if config.duplicate is not None else None
    writers.write_report(result.groups, f"{folder}/report", removed)
    writers.write_group_text(result.groups, f"{folder}/groups")
    rows = runtime.written(labels.label_rows(result.groups, items, path=path), "labels")
    classes, data = writers.write_labels(rows, folder, labels.label_file_names(rows))
    if config.previews:
        preview = clusters.preview(result.groups, config.previews, config.per_preview)
        preview.write.mode("overwrite").parquet(f"{folder}/previews")
    if config.previews and decode is not None:
        # all members of these groups, as the first readable ones may stand anywhere
        whole = clusters.preview(result.groups, config.previews, None)
        paths = items.select(F.col("data_index").alias("member"), F.col(path).alias("path"))
        sheets = writers.sheet_images(whole.join(paths, "member"), decode, limit=config.per_preview)
        named = sheets.select(F.concat("folder", F.lit("/"), "name", F.lit(".ppm")).alias("name"), F.col("image").alias("content"))
        writers.write_files(named, f"{folder}/images")
    return {"classes": classes, "data_list": data, "report": f"{folder}/report", "groups": f"{folder}/groups"}


def load(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(data_index, embedding, path) of array folders, one after the other: a preset of several sources."""
    parts = [readers.npy_table(spark, folder) for folder in folders]
    joined = readers.union_shards(parts).withColumnRenamed("data_index", "row")
    return readers.with_index(joined, "shard", "row").select("data_index", "embedding", "path")
