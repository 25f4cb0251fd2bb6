"""Shard arithmetic: how a search over n vectors is cut into jobs and parts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLIT = 1_000_000
MAX_SHARD = 10_000_000


@dataclass(frozen=True)
class Job:
    """One shard of the index: the ids from ``start`` to ``end`` (exclusive), searched by ``rank``."""

    rank: int
    job: int
    start: int
    end: int


def plan_jobs(rows: int, ranks: int = 1, largest: int = MAX_SHARD) -> list[Job]:
    """Every rank takes an equal number of whole shards, the last one also what is left.

    The shard size is the rows per rank plus the remainder, at most ``largest``.
    """
    if rows < 0 or ranks < 1 or largest < 1:
        raise ValueError("rows, ranks and the largest shard must be positive")
    if rows == 0:
        return []
    size = min(rows // ranks + rows % ranks, largest)
    jobs = -(-rows // size)
    each = jobs // ranks
    rank_of = lambda job: min(job // each, ranks - 1) if each else ranks - 1
    return [Job(rank_of(j), j, j * size, min(rows, (j + 1) * size)) for j in range(jobs)]


def part_count(rows: int, threshold: int = SPLIT) -> int:
    """Parts a table is written in: one up to the threshold, then as few as hold it."""
    return 1 if rows <= threshold else -(-rows // threshold)


def with_part(df: DataFrame, key: str = "data_index", threshold: int = SPLIT) -> DataFrame:
    """Adds ``part``: contiguous parts by index of ``threshold`` rows."""
    return df.withColumn("part", F.floor(F.col(key) / threshold).cast("long"))


def with_shard(df: DataFrame, key: str, size: int) -> DataFrame:
    return df.withColumn("shard", F.floor(F.col(key) / size).cast("long"))
