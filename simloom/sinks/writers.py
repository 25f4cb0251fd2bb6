"""Sinks: split tables, label sets, group text, reports, previews, divergence and JSON files."""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import grouping, runtime
from ..functions import names
from ..operators import clusters, shards

#: A folder made by this package holds this file; nothing else is ever replaced.
OWNED = "_simloom"


def _path(spark: SparkSession, folder: str) -> tuple[object, object]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fresh_folder(spark: SparkSession, folder: str, replace: bool = False) -> str:
    """An output folder of our own: made if absent; emptied if ``replace``; refused if somebody else's."""
    path, system = _path(spark, folder)
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, OWNED)
    if system.exists(path):
        if not system.exists(mark) and len(list(system.listStatus(path))):
            raise ValueError(f"{folder} holds files that are not ours")
        if replace:
            system.delete(path, True)
    system.mkdirs(path)
    system.create(mark, True).close()
    return folder


def write_split(df: DataFrame, folder: str, key: str = "data_index", threshold: int = shards.SPLIT) -> None:
    """Contiguous parts by index, ``threshold`` rows each, as partitions ``part=0..``; one part below it."""
    parts = shards.with_part(df, key, threshold)
    parts.repartitionByRange("part", key).sortWithinPartitions("part", key).write.partitionBy("part").mode("overwrite").parquet(folder)


def write_batches(df: DataFrame, folder: str, batch: str = "batch") -> None:
    """One folder per batch, rows with their paths and indices: a batch alone is complete."""
    df.write.partitionBy(batch).mode("overwrite").parquet(folder)


def write_labels(labels: DataFrame, folder: str, file_names: DataFrame) -> tuple[str, str]:
    """Classes and data list as two tables under the names of one of the name policies."""
    row = file_names.first()
    classes, data = f"{folder}/{row['classes_name']}", f"{folder}/{row['data_name']}"
    labels.select("folder").distinct().orderBy("folder").write.mode("overwrite").parquet(classes)
    labels.select("folder", "file_path").write.mode("overwrite").parquet(data)
    return classes, data


def group_lines(groups: DataFrame) -> DataFrame:
    """(group_id, value): members as ``1, 2, 3``; one line per group."""
    members = F.transform(F.array_sort(F.collect_list("member")), lambda m: m.cast("string"))
    return groups.groupBy("group_id").agg(F.array_join(members, ", ").alias("value"))


def write_group_text(groups: DataFrame, folder: str) -> None:
    group_lines(groups).orderBy("group_id").select("value").write.mode("overwrite").text(folder)


def report_lines(groups: DataFrame, removed: int | None = None, header: str = "Group sizes:") -> DataFrame:
    """(line_no, value): a header, sizes ascending with their numbers of groups, and the removed count if given."""
    sizes = clusters.size_histogram(groups).select(
        (F.col("size") + 1).alias("line_no"),
        F.format_string(" Size %d: %d group(s)", F.col("size"), F.col("groups")).alias("value"),
    )
    spark = groups.sparkSession
    lines = spark.createDataFrame([(0, header)], "line_no long, value string").unionByName(sizes)
    if removed is not None:
        last = spark.createDataFrame([(1 << 62, f"Removed {removed} duplicate images")], "line_no long, value string")
        lines = lines.unionByName(last)
    return lines


def write_report(groups: DataFrame, folder: str, removed: int | None = None) -> None:
    """The report as one text file: as many lines as there are different sizes."""
    report_lines(groups, removed).orderBy("line_no").coalesce(1).select("value").write.mode("overwrite").text(folder)


def write_divergence(rows: DataFrame, folder: str) -> None:
    """``folder,path,score`` lines, quoted where needed."""
    line = rows.select(names.flat_folder("folder").alias("folder"), "file_path", "score")
    line.write.mode("overwrite").option("header", "false").csv(folder)


def write_centroids(rows: DataFrame, folder: str, per_class: bool = False) -> None:
    """One table of (class, centroid); ``per_class`` makes a folder for every class."""
    writer = rows.withColumn("class", names.flat_folder(F.col("class").cast("string"))).write.mode("overwrite")
    (writer.partitionBy("class") if per_class else writer).parquet(folder)


def write_knn(knn: DataFrame, folder: str, beside: bool = False) -> None:
    """Hit lists partitioned by shard, indices those of the whole collection.

    With ``beside`` only the shards in ``knn`` are replaced: several ranks write to one folder.
    """
    writer = knn.write.partitionBy("shard").mode("overwrite")
    (writer.option("partitionOverwriteMode", "dynamic") if beside else writer).parquet(folder)


def write_files(rows: DataFrame, folder: str, name: str = "name", content: str = "content") -> DataFrame:
    """One file per row below a folder that all executors share; returns (name, size) of those written.

    Files of one name replace each other.  Each is written whole under another name and then
    moved, so a task that is run again leaves no half of a file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ..sources.readers import _open

        for batch in batches:
            done: list[tuple[str, int]] = []
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = data.encode() if isinstance(data, str) else data
                system, place = _open(f"{folder.rstrip('/')}/{file}")
                system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                beside = f"{place}.{uuid.uuid4().hex}.tmp"
                with system.open_output_stream(beside) as out:
                    out.write(data)
                system.move(beside, place)
                done.append((file, len(data)))
            yield pa.record_batch(
                [pa.array([n for n, _ in done], pa.string()), pa.array([c for _, c in done], pa.int64())], ["name", "size"]
            )

    return runtime.written(rows.select(name, content).mapInArrow(run, "name string, size long"), "files")


def npy_bytes(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array, allow_pickle=False)
    return out.getvalue()


def write_npy(
    df: DataFrame, folder: str, prefix: str = "embs_", key: str = "data_index", value: str = "embedding", rows_per_file: int = 65536
) -> DataFrame:
    """Array shards ``{prefix}{number}.npy`` of ``rows_per_file`` rows by index: vectors, or strings.

    Vectors of one file are of one length; null values fail.  Returns (name, size).
    """
    vector = df.schema[value].dataType.typeName() == "array"
    source = df.select(F.col(key).cast("long").alias("k"), F.col(value).cast("array<float>" if vector else "string").alias("v"))
    source = source.withColumn("part", F.floor(F.col("k") / rows_per_file).cast("long"))

    def make(group: pa.Table) -> Iterator[pa.RecordBatch]:
        if group["v"].null_count:
            raise ValueError("an array file has no place for a null")
        order = np.argsort(group["k"].to_numpy(), kind="stable")
        values = group["v"].combine_chunks().take(pa.array(order))
        if vector:
            flat = values.flatten().to_numpy(zero_copy_only=False)
            array = flat.reshape(len(values), -1)
            if (np.diff(values.offsets.to_numpy()) != array.shape[1]).any():
                raise ValueError("vectors of one file must be of one length")
        else:
            array = np.array(values.to_pylist())
        name = f"{prefix}{group['part'][0].as_py()}.npy"
        yield pa.record_batch([pa.array([name]), pa.array([npy_bytes(array)], pa.binary())], ["name", "content"])

    files = grouping.map_groups(source, "part", make, "name string, content binary", runtime.shuffle_partitions(df.sparkSession))
    return write_files(files, folder)


def write_json_documents(rows: DataFrame, folder: str, json: str = "json", name: str | None = None) -> None:
    """One JSON document per line, or, with the column ``name``, one file per document."""
    if name is not None:
        write_files(rows, folder, name, json)
        return
    rows.select(F.col(json).alias("value")).write.mode("overwrite").text(folder)


def band_colour(group: int) -> tuple[int, int, int]:
    """A colour that depends on the group alone."""
    value = zlib.crc32(str(group).encode())
    return value & 255, value >> 8 & 255, value >> 16 & 255


def encode_ppm(pixels: np.ndarray) -> bytes:
    """H x W x 3 bytes as a binary PPM image: needs no image library."""
    out = io.BytesIO()
    out.write(f"P6 {pixels.shape[1]} {pixels.shape[0]} 255\n".encode())
    out.write(np.ascontiguousarray(pixels, np.uint8).tobytes())
    return out.getvalue()


def sheet_images(
    members: DataFrame, decode: Callable[[bytes], np.ndarray | None], group: str = "rank", limit: int = 10, band: bool = False, size: int = 112
) -> DataFrame:
    """(folder, name, image): the first ``limit`` readable images of each group, scaled, as PPM bytes.

    ``members`` has (group, pos, path) and perhaps content; without it the files at the paths
    are read, and those that are not there count as unreadable.  ``decode`` gives H x W x 3
    bytes, or None if unreadable; unreadable images do not count.  Images of one name in
    one group overwrite each other and count each.  ``band`` paints the last rows
    in the group's colour.  A group is read in its order and no further than its
    last image needs.
    """
    held = "content" in members.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ..sources.readers import _open

        last, count = None, 0
        for batch in batches:
            g, place, name, image = [], [], [], []
            columns = [batch.column(i).to_pylist() for i in range(4 if held else 3)]
            for number, pos, path, *content in zip(*columns):
                if number != last:
                    last, count = number, 0
                if count >= limit:
                    continue
                data = content[0] if held else None
                if not held and path is not None:
                    try:
                        system, where = _open(path)
                        with system.open_input_file(where) as file:
                            data = file.read()
                    except (OSError, ValueError):  # not there, or no name of a file at all
                        data = None
                pixels = decode(data) if data is not None else None
                if pixels is None:
                    continue
                count += 1
                pixels = resize(pixels, size)
                if band:
                    pixels[size - size * 12 // 112 :] = band_colour(number)
                g.append(number)
                place.append(pos)
                name.append(path.rsplit("/", 1)[-1])
                image.append(encode_ppm(pixels))
            yield pa.record_batch(
                [pa.array(g, pa.int64()), pa.array(place, pa.int64()), pa.array(name, pa.string()), pa.array(image, pa.binary())],
                ["g", "pos", "name", "image"],
            )

    source = members.select(F.col(group).cast("long").alias("g"), F.col("pos").cast("long").alias("p"), "path", *(["content"] if held else []))
    whole = source.repartition(runtime.shuffle_partitions(members.sparkSession), "g").sortWithinPartitions("g", "p")
    done = whole.mapInArrow(run, "g long, pos long, name string, image binary")
    last = done.groupBy("g", "name").agg(F.max_by("image", "pos").alias("image"))
    return last.select(names.group_name("g").alias("folder"), "name", "image")


def resize(pixels: np.ndarray, size: int) -> np.ndarray:
    """Bilinear scaling to size x size, pixel centres aligned."""
    height, width = pixels.shape[:2]
    rows = np.clip((np.arange(size) + 0.5) * height / size - 0.5, 0, height - 1)
    cols = np.clip((np.arange(size) + 0.5) * width / size - 0.5, 0, width - 1)
    r0, c0 = np.floor(rows).astype(int), np.floor(cols).astype(int)
    r1, c1 = np.minimum(r0 + 1, height - 1), np.minimum(c0 + 1, width - 1)
    fr, fc = (rows - r0)[:, None, None], (cols - c0)[None, :, None]
    p = pixels.astype(np.float64)
    top = p[r0][:, c0] * (1 - fc) + p[r0][:, c1] * fc
    low = p[r1][:, c0] * (1 - fc) + p[r1][:, c1] * fc
    return np.rint(top * (1 - fr) + low * fr).astype(np.uint8)
