"""Clean listings of (folder, path) pairs and per-folder results without imbalance.

A few folders hold most rows, so nothing here groups or joins raw rows by folder.
``folder_results`` accumulates dense arrays instead: every task encodes the folders
of its split with a dictionary of its own and adds its rows into arrays indexed by
code; the arrays are cut into blocks by a hash of the folder and summed by
reduction.  A hot folder costs a task one array cell, as every other folder does.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import grouping, runtime

WHITE = " \t\r\n"
#: Codes an array begins with, and those from which a task sends its arrays on and starts new ones.
BLOCK, DICTIONARY = 4096, 1 << 18


def clean_path(path: str | F.Column) -> F.Column:
    """Trim white space, ``\\`` to ``/``, runs of ``/`` to one, lower case."""
    column = F.col(path) if isinstance(path, str) else path
    return F.lower(F.regexp_replace(F.translate(F.btrim(column, F.lit(WHITE)), "\\", "/"), "/+", "/"))


def clean_folder(folder: str | F.Column) -> F.Column:
    """Trim white space, drop all ``/`` at the end, lower case."""
    column = F.col(folder) if isinstance(folder, str) else folder
    return F.lower(F.rtrim(F.btrim(column, F.lit(WHITE)), F.lit("/")))


def subject(path: F.Column) -> F.Column:
    """The subject of a clean path: its last directory, or below ``portraits``
    the file name up to its first ``.`` or ``_``.  Empty without a directory."""
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    folder = F.when(F.size(parts) > 1, F.element_at(parts, -2)).otherwise(F.lit(""))
    return F.when(folder == "portraits", F.substring_index(F.substring_index(name, ".", 1), "_", 1)).otherwise(folder)


def clean_listing(
    df: DataFrame, folder: str = "folder", path: str = "file_path", position: str = "list_pos"
) -> DataFrame:
    """(folder, path, subject, list_pos): distinct listings, at their first position.

    Rows with a null folder or path are no listings.  Empty strings are values.
    """
    return (
        df.select(
            clean_folder(folder).alias("folder"), clean_path(path).alias("path"), F.col(position).alias("list_pos")
        )
        .filter("folder IS NOT NULL AND path IS NOT NULL")
        .groupBy("folder", "path")
        .agg(F.min("list_pos").alias("list_pos"))
        .select("folder", "path", subject(F.col("path")).alias("subject"), "list_pos")
    )


def folder_results(
    df: DataFrame, folder: str = "folder", path: str = "file_path", position: str = "list_pos"
) -> DataFrame:
    """(folder, listings, subjects, first_path) for every clean folder.

    ``listings`` counts distinct (folder, path), ``subjects`` distinct subjects,
    ``first_path`` is the smallest clean path in byte order.  Null folders and
    paths are no listings; an empty table gives an empty result; other columns
    are ignored.

    Rows of the repeated-listing and repeated-subject steps are spread by (folder,
    path) and (folder, subject), never by folder alone.
    """
    clean = clean_listing(df, folder, path, position)
    pairs = clean.select("folder", "subject").distinct()
    listed = clean.select("folder", F.lit(True).alias("listing"), "path")
    counted = pairs.select("folder", F.lit(False).alias("listing"), F.lit(None).cast("string").alias("path"))

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}  # the task's dictionary: folder to code
        listings, subjects = np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)
        first: list[str | None] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            words = batch.column(0).dictionary_encode()
            for name in words.dictionary.to_pylist():
                if name not in held:
                    held[name] = len(held)
                    first.append(None)
            code = np.array([held[name] for name in words.dictionary.to_pylist()])[words.indices.to_numpy()]
            while len(listings) < len(held):
                listings, subjects = (np.concatenate([x, np.zeros(len(x), np.int64)]) for x in (listings, subjects))
            whole = batch.column(1).to_numpy(zero_copy_only=False)
            listings += np.bincount(code[whole], minlength=len(listings))
            subjects += np.bincount(code[~whole], minlength=len(subjects))
            least = pa.table({"code": code, "p": batch.column(2)}).group_by("code").aggregate([("p", "min")])
            for c, p in zip(least["code"].to_pylist(), least["p_min"].to_pylist()):
                if p is not None and (first[c] is None or p < first[c]):
                    first[c] = p
            if len(held) >= DICTIONARY:
                yield _partial(held, listings, subjects, first)
                held, first = {}, []
                listings, subjects = np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)
        if held:
            yield _partial(held, listings, subjects, first)

    fields = "folder string, listings long, subjects long, first_path string"
    # equal splits of the input: rows are in no order of folders, whatever the folders' sizes
    arrays = listed.mapInArrow(accumulate, fields).unionByName(counted.mapInArrow(accumulate, fields))
    blocks = max(runtime.shuffle_partitions(df.sparkSession), -(-runtime.input_bytes(df) // runtime.PARTITION_BYTES))
    arrays = arrays.withColumn("block", F.pmod(F.xxhash64("folder"), F.lit(int(blocks))))

    def reduce(group: pa.Table) -> Iterable[pa.RecordBatch]:
        words = pc.dictionary_encode(group["folder"].combine_chunks())
        code, names = words.indices.to_numpy(), words.dictionary
        listings, subjects = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        np.add.at(listings, code, group["listings"].to_numpy())
        np.add.at(subjects, code, group["subjects"].to_numpy())
        least = pa.table({"code": code, "p": group["first_path"]}).group_by("code").aggregate([("p", "min")])
        at = np.argsort(least["code"].to_numpy())
        yield pa.record_batch(
            [names, pa.array(listings), pa.array(subjects), least["p_min"].combine_chunks().take(pa.array(at))],
            ["folder", "listings", "subjects", "first_path"],
        )

    return grouping.map_groups(arrays, "block", reduce, fields, int(blocks))


def _partial(held: dict[str, int], listings: np.ndarray, subjects: np.ndarray, first: list[str | None]) -> pa.RecordBatch:
    """A task's arrays, with the names of its codes."""
    n = len(held)
    return pa.record_batch(
        [pa.array(list(held), pa.string()), pa.array(listings[:n]), pa.array(subjects[:n]), pa.array(first, pa.string())],
        ["folder", "listings", "subjects", "first_path"],
    )


def large_folders(results: DataFrame, share: float = 0.02) -> DataFrame:
    """(folder): folders that hold at least ``share`` of all listings."""
    total = results.agg(F.sum("listings").alias("total"))
    return results.join(F.broadcast(total), F.col("listings") >= F.lit(share) * F.col("total")).select("folder")
