"""Sources: image folders, path lists, group text, JSON documents, ``.npy`` arrays.

Positions are part of the data here (a row's index is its identity), so every
reader returns an explicit index column, numbered by a total order of (file,
line) or path.  Numbering is done in range slices whose sizes are summed up:
no task orders a whole catalog.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import runtime
from ..functions import names

IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "webp")
WHITE = " \t\r\n"


def with_index(df: DataFrame, *order: str, name: str = "data_index") -> DataFrame:
    """``df`` with a dense index from 0 along ``order``, materialised once.

    Rows equal in ``order`` are numbered in no set order among themselves.
    """
    placed = runtime.written(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "indexed")
    sizes = placed.groupBy("_slice").agg(F.count("*").alias("_c"))
    upto = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("_slice", F.coalesce(F.sum("_c").over(upto), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy("_slice").orderBy(*order)) - 1
    joined = placed.withColumn("_place", place).join(F.broadcast(base), "_slice")
    return joined.withColumn(name, (F.col("_base") + F.col("_place")).cast("long")).drop("_slice", "_base", "_place")


def image_folder(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES) -> DataFrame:
    """(path, data_index): images below a folder in path order.  Without any it raises.

    Only names are listed; contents are read by whoever selects them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    images = files.filter(F.lower(F.substring_index("path", ".", -1)).isin(list(suffixes)))
    if images.isEmpty():
        raise ValueError(f"no images below {folder}")
    return with_index(images, "path")


def image_bytes(spark: SparkSession, folder: str, glob: str = "*.jpg") -> DataFrame:
    """(path, content) of the images below a folder by name pattern."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return reader.load(folder).select("path", "content")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, line): lines with what orders them in their file.

    Files are read in byte ranges by many tasks.  A range's rows come in order, so a
    line's place is the start of its range and its row in the task.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")).alias("at"),
        F.col("value").alias("line"),
    )


def path_list(spark: SparkSession, path: str) -> DataFrame:
    """(path, data_index): one path per line, trimmed, blank lines dropped, in file order."""
    rows = _lines(spark, path).withColumn("path", F.btrim("line", F.lit(WHITE))).filter("path <> ''")
    return with_index(rows.select("file", "at", "path"), "file", "at").select("path", "data_index")


def line_list(spark: SparkSession, path: str) -> DataFrame:
    """(value, data_index): trimmed lines, blank ones kept, in file order."""
    rows = _lines(spark, path).withColumn("value", F.btrim("line", F.lit(WHITE)))
    return with_index(rows.select("file", "at", "value"), "file", "at").select("value", "data_index")


def parse_group_text(lines: DataFrame, line: str = "value", order: str = "data_index") -> DataFrame:
    """(group_id, pos, member): lines such as ``1, 2, 3``; group_id is the line's index.

    A blank line is a group without members and has no rows; anything that is
    no integer raises.
    """
    parts = F.split(F.btrim(F.col(line), F.lit(WHITE)), ",")
    rows = lines.filter(F.btrim(F.col(line), F.lit(WHITE)) != "").select(
        F.col(order).cast("long").alias("group_id"), F.posexplode(parts).alias("pos", "item")
    )
    return rows.select("group_id", "pos", F.btrim("item", F.lit(WHITE)).cast("long").alias("member"))


def group_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_group_text(line_list(spark, path))


def json_documents(spark: SparkSession, folder: str, glob: str = "*.json") -> DataFrame:
    """(path, json): one document per file, as text."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return reader.load(folder).select("path", F.decode("content", "UTF-8").alias("json"))


def ranked_files(spark: SparkSession, folder: str, glob: str = "temp-*.npy") -> DataFrame:
    """(path, rank, idx, shard): files named ``...-{rank}_{idx}_...`` in the order of the two numbers.

    ``shard`` numbers them from 0.  A name without the two numbers raises.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path")
    rank, idx = names.rank_index("path")
    bad = F.raise_error(F.concat(F.lit("no rank and index in "), "path")).cast("int")
    found = files.select("path", F.coalesce(rank, bad).alias("rank"), F.coalesce(idx, bad).alias("idx"))
    order = Window.orderBy("rank", "idx", "path")  # one row a file
    return found.withColumn("shard", F.row_number().over(order) - 1)


def npy_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, kind, shard): the ``.npy`` files of a folder, not below it, in natural order.

    ``kind`` is embs if the name contains it, else paths if it contains fpaths or
    list; other files are left out.  ``shard`` numbers each kind's files from 0
    by the integers of their names ([0] without any), then by name.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(folder).select("path")
    base = names.base_name("path")
    kind = F.when(F.contains(base, F.lit("embs")), "embs").when(
        F.contains(base, F.lit("fpaths")) | F.contains(base, F.lit("list")), "paths"
    )
    order = Window.partitionBy("kind").orderBy(names.natural_key("path"), base)
    return files.withColumn("kind", kind).filter("kind IS NOT NULL").withColumn("shard", F.row_number().over(order) - 1)


#: Rows of an array file that one task reads at a time.
NPY_ROWS = 1 << 16


def _open(path: str) -> tuple[object, str]:
    """The file system of a path, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _npy_head(path: str) -> tuple[tuple[int, ...], np.dtype, int]:
    """(shape, type, where the data begin) of an ``.npy`` file; only its head is read."""
    system, place = _open(path)
    with system.open_input_file(place) as file:
        version = np.lib.format.read_magic(file)
        read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        shape, fortran, dtype = read(file)
        if dtype.hasobject:
            raise ValueError(f"{path} holds pickled objects, which are refused")
        if fortran and len(shape) > 1:
            raise ValueError(f"{path} is in column order")
        if len(shape) not in (1, 2):
            raise ValueError(f"an array of {len(shape)} dimensions has no rows of vectors or strings")
        return shape, dtype, file.tell()


def npy_rows(spark: SparkSession, files: DataFrame, rows_per_batch: int = 4096, rows_per_task: int = NPY_ROWS) -> DataFrame:
    """(shard, row, embedding, value) of ``.npy`` files: vectors of 2-d arrays, strings of 1-d ones.

    The heads tell how many rows there are; ranges of ``rows_per_task`` rows are then
    read by seeking, so a file of any size is read by many tasks and none holds it.
    """

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int, int, int]] = []
            for path, shard in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = _npy_head(path)[0][0]
                out += [(path, shard, lo, min(rows_per_task, rows - lo)) for lo in range(0, rows, rows_per_task)]
            columns = list(zip(*out)) or [(), (), (), ()]
            types = (pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["path", "shard", "lo", "n"])

    cut = files.select("path", F.col("shard").cast("int")).mapInArrow(ranges, "path string, shard int, lo long, n long")
    cut = runtime.written(cut, "npy-ranges")
    tasks = max(1, min(cut.count(), 100_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, shard, start, count in zip(*(batch.column(i).to_pylist() for i in range(4))):
                shape, dtype, data = _npy_head(path)
                two = len(shape) == 2
                width = dtype.itemsize * (shape[1] if two else 1)
                system, place = _open(path)
                with system.open_input_file(place) as file:
                    for lo in range(start, start + count, rows_per_batch):
                        size = min(rows_per_batch, start + count - lo)
                        file.seek(data + lo * width)
                        part = np.frombuffer(file.read(size * width), dtype)
                        part = part.reshape(size, -1) if two else part
                        yield pa.record_batch(
                            [
                                pa.array(np.full(size, shard, np.int32)),
                                pa.array(np.arange(lo, lo + size, dtype=np.int64)),
                                pa.array(list(part.astype(np.float32)) if two else [None] * size, pa.list_(pa.float32())),
                                pa.array([None] * size if two else [str(x) for x in part], pa.string()),
                            ],
                            ["shard", "row", "embedding", "value"],
                        )

    return cut.repartition(tasks, "path", "lo").mapInArrow(run, "shard int, row long, embedding array<float>, value string")


def npy_table(spark: SparkSession, folder: str) -> DataFrame:
    """(data_index, embedding, path) out of a folder of array shards.

    Shards are concatenated in natural order, vectors and paths are matched by
    their row number in the whole.  Raises if there are not as many of both.
    """
    files = runtime.written(npy_files(spark, folder), "npy")
    if files.isEmpty():
        raise ValueError(f"no embedding or path arrays in {folder}")
    sides = []
    for kind, column in (("embs", "embedding"), ("paths", "value")):
        some = files.filter(F.col("kind") == kind)
        if some.isEmpty():
            raise ValueError(f"no {kind} arrays in {folder}")
        sides.append(with_index(npy_rows(spark, some).select("shard", "row", column), "shard", "row"))
    left, right = sides
    vectors, paths = left.count(), right.count()
    if vectors != paths:
        raise ValueError(f"{vectors} vectors but {paths} paths in {folder}")
    return left.select("data_index", "embedding").join(
        right.select("data_index", F.col("value").alias("path")), "data_index"
    )


def union_shards(shards: list[DataFrame]) -> DataFrame:
    """All rows of the shards with their shard number: the order of a concatenation is (shard, row)."""
    if not shards:
        raise ValueError("no shards")
    out = None
    for number, shard in enumerate(shards):
        part = shard.withColumn("shard", F.lit(number))
        out = part if out is None else out.unionByName(part)
    return out


def zip_by_index(left: DataFrame, right: DataFrame, key: str = "data_index") -> DataFrame:
    """Rows of equal index side by side.  Raises if the counts differ."""
    a, b = left.count(), right.count()
    if a != b:
        raise ValueError(f"{a} rows on one side but {b} on the other")
    return left.join(right, key)


def natural_sorted(paths: list[str]) -> list[str]:
    """Names in the order of the integers they hold; [0] without any."""
    key = lambda p: [int(x) for x in re.findall(r"\d+", p.rsplit("/", 1)[-1])] or [0]
    return sorted(paths, key=key)
