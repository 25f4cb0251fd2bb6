"""Label relations: (folder, file_path) rows of groups, class maps, catalogs, capped classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names


def label_rows(groups: DataFrame, items: DataFrame, key: str = "data_index", path: str = "path") -> DataFrame:
    """(folder, file_path): one row per member, in folders ``group_0000`` by group number.

    A member without an item fails the job: a label set that silently lacks rows
    would not be noticed.  An item with a null path is there.
    """
    paths = items.select(F.col(key).cast("long").alias("member"), F.col(path).alias("file_path"), F.lit(True).alias("known"))
    missing = F.raise_error(F.concat(F.lit("no item for member "), F.col("member").cast("string"))).cast("string")
    return groups.join(paths, "member", "left").select(
        names.group_name("group_id").alias("folder"), F.when(F.col("known"), F.col("file_path")).otherwise(missing).alias("file_path")
    )


def label_file_names(labels: DataFrame, prefix: str = "train") -> DataFrame:
    """One row (classes_name, data_name): file names with abbreviated counts, such as ``train_12K_class_1M...``."""
    count = labels.agg(F.countDistinct("folder").alias("c"), F.count("*").alias("d"))
    stem = F.concat(F.lit(prefix + "_"), names.thousands("c"), F.lit("_class_"), names.thousands("d"), F.lit("_data"))
    return count.select(F.concat(stem, F.lit("_classes")).alias("classes_name"), F.concat(stem, F.lit("_data_list")).alias("data_name"))


def remap_file_names(labels: DataFrame, prefix: str = "fr-train") -> DataFrame:
    """One row (classes_name, data_name) by the other policy: thousands of classes, millions of rows, floored."""
    count = labels.agg(F.countDistinct("folder").alias("c"), F.count("*").alias("d"))
    kilo, mega = (F.floor(F.col(c) / n).cast("string") for c, n in (("c", 1000), ("d", 1_000_000)))
    stem = F.concat(F.lit(prefix + "_"), kilo, F.lit("k_"), mega, F.lit("M-"))
    return count.select(F.concat(stem, F.lit("classes")).alias("classes_name"), F.concat(stem, F.lit("data_list")).alias("data_name"))


def annotation_file_names(labels: DataFrame, prefix: str, extra: str = "") -> DataFrame:
    """One row (classes_name, data_name) by the third policy: thousands of both, floored."""
    count = labels.agg(F.countDistinct("folder").alias("c"), F.count("*").alias("d"))
    part = lambda c: F.floor(F.col(c) / 1000).cast("string")
    stem = F.concat(F.lit(f"{prefix}_{extra}_"), part("c"), F.lit("k-c_"), part("d"), F.lit("k-d_"))
    return count.select(F.concat(stem, F.lit("classes")).alias("classes_name"), F.concat(stem, F.lit("data_list")).alias("data_name"))


def class_map(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, target): the class of each member becomes that of its group's first member.

    ``classes`` is (member, class).  If a class is in several groups the last one
    by (group, position) wins; targets are not followed further.  The first
    member of a group maps its own class to itself and counts as a write too.
    """
    first = groups.groupBy("group_id").agg(F.min("member").alias("member"))
    target = first.join(classes, "member").select("group_id", F.col("class").alias("target"))
    written = groups.join(classes, "member").select("group_id", "member", "class").join(target, "group_id")
    last = F.max_by("target", F.struct("group_id", "member"))  # members are in order inside a group
    return written.groupBy("class").agg(last.alias("target"))


def class_list(mapping: DataFrame) -> DataFrame:
    """(class): sorted distinct targets."""
    return mapping.select(F.col("target").alias("class")).distinct().orderBy("class")


def relabel(catalog: DataFrame, mapping: DataFrame, path: str, class_of: Column) -> DataFrame:
    """(folder, file_path): the catalog's rows whose class is mapped.

    The map side is as large as the number of classes; Spark broadcasts it only
    below its own size limit and shuffles both sides beyond.
    """
    rows = catalog.select(F.col(path).alias("file_path"), class_of.alias("class"))
    return rows.join(mapping, "class").select(F.col("target").alias("folder"), "file_path")


def relabel_counts(catalog: DataFrame, mapping: DataFrame, class_of: Column) -> DataFrame:
    """One row (hits, misses) of a relabelling."""
    rows = catalog.select(class_of.alias("class"))
    known = mapping.select("class", F.lit(1).alias("known"))
    return rows.join(known, "class", "left").agg(
        F.count_if(F.col("known").isNotNull()).alias("hits"), F.count_if(F.col("known").isNull()).alias("misses")
    )


def capped(
    items: DataFrame, limit: int, order: str, folder: str = "folder", path: str = "file_path", origin: str = "origin.jpg"
) -> DataFrame:
    """(folder, file_path, pos): at most ``limit`` rows per class, the original first.

    The last row whose path contains ``origin`` is the class's original and comes
    first; other originals are left out; then come the first ``limit - 1`` other
    rows by ``order``.  A class without an original raises.  A ``limit`` of 0 or
    less keeps all rows in their order, originals included, and asks for none.
    """
    rows = items.select(
        F.col(folder).alias("folder"), F.col(path).alias("file_path"), F.col(order).alias("o"), F.contains(F.col(path), F.lit(origin)).alias("is_origin")
    )
    if limit <= 0:
        place = F.row_number().over(Window.partitionBy("folder").orderBy("o")) - 1
        return rows.select("folder", "file_path", place.alias("pos"))
    originals = rows.filter("is_origin").groupBy("folder").agg(F.max_by("file_path", "o").alias("file_path"))
    others = rows.filter("NOT is_origin")
    # the first rows of a class are chosen in the tasks before the shuffle, however large the class is
    first = Window.partitionBy("folder").orderBy("o")
    some = others.withColumn("pos", F.row_number().over(first)).filter(F.col("pos") < max(limit, 2))
    known = originals.select("folder", F.lit(True).alias("has"))
    joined = some.alias("s").join(known.alias("k"), F.col("s.folder").eqNullSafe(F.col("k.folder")), "left")
    checked = F.when(F.col("has"), F.col("pos")).otherwise(
        F.raise_error(F.concat(F.lit("no original in class "), F.coalesce("s.folder", F.lit("null")))).cast("int")
    )
    checked = joined.select("s.folder", "file_path", checked.alias("pos")).filter(F.col("pos") < limit)
    return originals.select("folder", "file_path", F.lit(0).alias("pos")).unionByName(checked)


def annotated(groups: DataFrame, items: DataFrame, documents: DataFrame, root: str = "") -> DataFrame:
    """(name, json): the members' documents with their image path, frame, scene and group added.

    ``groups`` is (group_id, member), ``items`` (member, path), ``documents`` (path, json); a
    document is the one whose file name is the image's up to its first dot, with .json.
    A member without a document, or whose name holds no frame number, fails the job.
    """
    base = names.base_name("path")
    held = documents.select(names.base_name("path").alias("name"), "json")
    rows = groups.join(items, "member").select("group_id", "path", F.concat(names.stem_of(base), F.lit(".json")).alias("name"))
    rows = rows.join(held, "name", "left")
    bad = lambda what: F.raise_error(F.concat(F.lit(f"no {what} for "), "path"))
    fields = {
        "img_path": F.concat(F.lit(root), "path"),
        "frame_cnt": F.coalesce(names.frame_of(base), bad("frame number").cast("int")),
        "scene_str": names.scene_of(base),
        "face_id": F.col("group_id"),
    }
    whole = rows.withColumn("json", F.coalesce("json", bad("document").cast("string")))
    return whole.select("name", augment_json(whole, "json", fields).alias("json"))


def augment_json(rows: DataFrame, json: str, fields: dict[str, Column]) -> Column:
    """The JSON object column with top-level fields added or replaced, as JSON text.

    Every value keeps its type, nested ones too: fields are numbers, booleans or
    strings as their columns are, and a null column is a JSON null.  A null or
    malformed document, or one that is no object, gives an object of the new fields only.
    """
    held = F.from_json(F.col(json), "map<string,variant>")
    none = F.create_map().cast("map<string,variant>")
    kept = F.map_filter(F.coalesce(held, none), lambda k, v: ~k.isin(list(fields)))
    null = F.parse_json(F.lit("null"))
    added = F.create_map(
        *(x for name, value in fields.items() for x in (F.lit(name), F.coalesce(value.cast("variant"), null)))
    )
    return F.to_json(F.map_concat(kept, added))
