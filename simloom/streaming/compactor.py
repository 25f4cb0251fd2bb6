"""Consolidation of very many small files: a checkpointed streaming compactor.

``compact_files`` discovers files with Structured Streaming: the source's
checkpoint remembers every file it has handed out, so a file is read once, in
whatever run it is found.  Each micro-batch (``BATCH_BYTES`` of input, or a number of
files) is written under a name made from its batch number alone, in overwrite
mode, as few files as its size asks for; the batch that a failure interrupts is
handed out again with the same files and the same number, and so replaces its own
output.  ``available now`` processes what is there and ends.

Records are consolidated in two steps: micro-batches add (record, place) rows to
the log, and ``settle`` merges the batches that are new with the records it has,
keeping the first place of each.  The new records are written under the number of
the last batch in them, and a manifest that is added in one step puts them in
force: whoever reads sees the records before or after, and a failure or a repeated
call loses and doubles nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import runtime

WHITE = " \t\r\n"
#: Bytes of one consolidated file.
TARGET_BYTES = 128 << 20
#: Bytes of small files that one micro-batch takes in.
BATCH_BYTES = 1 << 30


def entries(files: DataFrame, id_col: str = "file_id", list_col: str = "fpaths") -> DataFrame:
    """(path, file_id, pos): the records of path lists.

    Entries that are null or empty after trimming, null lists and rows with a
    null id hold no record.  Positions are from 0 and count every entry.
    """
    return (
        files.select(F.col(id_col).cast("long").alias("file_id"), F.posexplode(F.col(list_col)).alias("pos", "entry"))
        .select(F.btrim("entry", F.lit(WHITE)).alias("path"), "file_id", F.col("pos").cast("long").alias("pos"))
        .filter("file_id IS NOT NULL AND path IS NOT NULL AND path <> ''")
    )


def _first_of(rows: DataFrame) -> DataFrame:
    """(path, file_id, pos): the first place of each record; partial minima before the shuffle."""
    least = rows.groupBy("path").agg(F.min(F.struct("file_id", "pos")).alias("first"))
    return least.select("path", "first.file_id", "first.pos")


def batch_path(folder: str, number: int) -> str:
    return f"{folder}/log/batch={number:012d}"


def ingest(
    spark: SparkSession,
    source: str,
    folder: str,
    files_per_batch: int | None = None,
    id_col: str = "file_id",
    list_col: str = "fpaths",
    schema: object = None,
    target_bytes: int = TARGET_BYTES,
) -> int:
    """Take in the Parquet files of ``source`` that were not taken in before.

    A micro-batch is ``BATCH_BYTES`` of them, or ``files_per_batch`` if that is given.

    Returns the number of batches in the log.  Run it again after new files
    arrive, or after a failure: nothing is read twice and nothing is lost.
    """
    schema = schema or spark.read.parquet(source).schema
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = ("maxBytesPerTrigger", BATCH_BYTES) if files_per_batch is None else ("maxFilesPerTrigger", files_per_batch)
    reader = spark.readStream.schema(schema).option(*size).option("maxFileAge", runtime.FILE_AGE)
    if system.getFileStatus(path).isFile():  # a stream reads folders: this one's, narrowed to the file
        reader, path = reader.option("pathGlobFilter", path.getName()), path.getParent()
    stream = reader.parquet(path.toString())

    def write(batch: DataFrame, number: int) -> None:
        files = max(1, -(-runtime.input_bytes(batch) // target_bytes))
        rows = entries(batch, id_col, list_col).coalesce(int(files))  # small files in, few files out
        rows.write.mode("overwrite").parquet(batch_path(folder, number))

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    last = query.lastProgress
    return int(last["batchId"]) + 1 if last else 0


SCHEMA = "path string, file_id long, pos long"


def batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the batches in the log that are whole."""
    return [int(name.split("=")[1]) for name in runtime.whole_folders(spark, f"{folder}/log")]


def _batch_rows(spark: SparkSession, folder: str, numbers: list[int]) -> DataFrame:
    if not numbers:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(*(batch_path(folder, n) for n in numbers))


def log_entries(spark: SparkSession, folder: str) -> DataFrame:
    """(path, file_id, pos): all records taken in, repeated deliveries included."""
    return _batch_rows(spark, folder, batches(spark, folder))


def records(spark: SparkSession, folder: str) -> DataFrame:
    """(path, file_id, pos): every record once, as of the last call of :func:`settle`."""
    held = runtime.read_manifest(spark, folder)
    if held is None:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{folder}/{json.loads(held)['records']}")


def settle(spark: SparkSession, folder: str, target_bytes: int = TARGET_BYTES) -> str:
    """Write every record once into files of about ``target_bytes``; returns the table's folder.

    Only the log's batches after those settled earlier are read, and merged with the
    records there are.  The files are cut by a hash of the record and sorted inside.
    A record that comes again and again is reduced to its first place before the
    shuffle, so a hot one costs no task more than others.  The files of the call before
    are deleted: tables read from them are to be read anew.
    """
    held = runtime.read_manifest(spark, folder)
    known = json.loads(held) if held else {"records": None, "upto": -1}
    new = [n for n in batches(spark, folder) if n > known["upto"]]
    if known["records"] and not new:
        return f"{folder}/{known['records']}"
    rows = _batch_rows(spark, folder, new)
    size = runtime.input_bytes(rows)
    if known["records"]:
        before = records(spark, folder)
        rows, size = rows.unionByName(before), size + runtime.input_bytes(before)
    files = max(1, -(-size // target_bytes))
    name = f"records/upto={max(new):012d}" if new else "records/none"
    _first_of(rows).repartition(int(files), "path").sortWithinPartitions("path").write.mode("overwrite").parquet(f"{folder}/{name}")
    runtime.publish_manifest(spark, folder, json.dumps({"records": name, "upto": max(new, default=-1)}))
    if known["records"]:
        runtime.remove(spark, f"{folder}/{known['records']}")
    return f"{folder}/{name}"


def compact_files(
    spark: SparkSession,
    source: str,
    folder: str,
    files_per_batch: int | None = None,
    target_bytes: int = TARGET_BYTES,
) -> DataFrame:
    """(path, file_id, pos): every record of the small files once, read from its few consolidated files."""
    ingest(spark, source, folder, files_per_batch, target_bytes=target_bytes)
    settle(spark, folder, target_bytes)
    return records(spark, folder)


def dropped(spark: SparkSession, folder: str) -> DataFrame:
    """(file_id, pos): record entries that are not the first of their path."""
    kept = records(spark, folder)
    log = log_entries(spark, folder).select("file_id", "pos").distinct()
    return log.join(kept.select("file_id", "pos"), ["file_id", "pos"], "left_anti")
