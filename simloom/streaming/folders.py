"""Streaming versions: running class centroids, and removal against what was kept before."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import runtime
from ..functions import vectors


def position_sums(stream: DataFrame, class_col: str = "folder", vector_col: str = "embedding") -> DataFrame:
    """(class, pos, n, total) of a stream: sums from which the centroids follow.

    State is one row per class and position.  No order of the classes is needed:
    a class that comes back adds to its sums.
    """
    rows = stream.filter(F.col(vector_col).isNotNull()).select(
        F.col(class_col).alias("class"), F.posexplode(vectors.as_double(vector_col)).alias("pos", "x")
    )
    return rows.groupBy("class", "pos").agg(F.count("*").alias("n"), F.sum("x").alias("total"))


def centroids_of(sums: DataFrame) -> DataFrame:
    """(class, n, centroid) out of the sums."""
    entries = F.array_sort(F.collect_list(F.struct("pos", (F.col("total") / F.col("n")).alias("m"))))
    grouped = sums.groupBy("class").agg(F.max("n").alias("n"), entries.alias("e"))
    return grouped.select("class", "n", F.transform("e", lambda e: e["m"]).alias("centroid"))


def run_centroids(spark: SparkSession, source: str, schema: str, folder: str, files_per_batch: int = 64) -> DataFrame:
    """Centroids of all Parquet files that ``source`` has had so far; later calls add new files.

    Each micro-batch's sums are written under its number, so a repeated batch
    replaces its own; the centroids sum over batches.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    stream = stream.option("maxFileAge", runtime.FILE_AGE).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        position_sums(batch).write.mode("overwrite").parquet(f"{folder}/sums/batch={number:012d}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    held = spark.read.option("recursiveFileLookup", "true").schema("class string, pos int, n long, total double")
    sums = held.parquet(f"{folder}/sums").groupBy("class", "pos").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return centroids_of(sums)


class IncrementalRemoval:
    """Greedy removal batch by batch: a vector goes if one that came before is too similar.

    The kept vectors are files in a shared folder, one set per batch number; whoever
    opens the folder again goes on from them.  A batch searches itself and the kept
    ones exactly, in blocks, for any earlier vector above the threshold: groups of
    copies may be of any size.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, threshold: float = 0.9):
        self.spark, self.threshold = spark, threshold
        self.folder = folder or f"{runtime.scratch(spark)}/kept-{uuid.uuid4().hex}"
        # a folder that holds batches goes on with them
        self.batches = [int(name.split("-")[1]) for name in runtime.whole_folders(spark, self.folder) if name.startswith("batch-")]

    def kept(self) -> DataFrame:
        """(id, embedding) of all that was kept."""
        schema = "id long, embedding array<double>"
        if not self.batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.folder}/batch-{b:012d}" for b in self.batches))

    def add(self, batch: DataFrame, number: int, id_col: str = "data_index", vector_col: str = "embedding") -> DataFrame:
        """(id): what the batch loses.  Ids must be larger than those of earlier batches."""
        from ..operators import knn

        new = batch.select(F.col(id_col).cast("long").alias("id"), vectors.as_double(vector_col).alias("embedding"))
        if number in self.batches:  # a repeated batch starts from what was there before it
            self.batches = [b for b in self.batches if b < number]
        old = self.kept()
        gone = runtime.written(knn.preceded(old, new, self.threshold), "gone")
        stay = new.join(gone, "id", "left_anti")
        stay.write.mode("overwrite").parquet(f"{self.folder}/batch-{number:012d}")
        self.batches.append(number)
        return gone
