"""Expressions on paths and names: classes, file name parts, padding, abbreviations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _from_end(path: Column, k: int) -> Column:
    """The ``k``-th segment from the end (1 is the last); null if there are fewer."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= k, F.get(parts, F.size(parts) - k))


def base_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def class_from_parents(path: Column | str) -> Column:
    """The two directories above the file, joined by ``/``; one if there is just one, empty if none."""
    path = _col(path)
    parent, grand = _from_end(path, 2), _from_end(path, 3)
    return F.coalesce(F.concat(grand, F.lit("/"), parent), parent, F.when(path.isNotNull(), ""))


def class_from_file(path: Column | str, suffix: int = 4) -> Column:
    """The file name less its last ``suffix`` characters, whatever they are."""
    name = base_name(path)
    return F.substring(name, F.lit(1), F.greatest(F.length(name) - suffix, F.lit(0)))


def class_of(path: Column | str, marker: str) -> Column:
    """The file-name class for paths that contain ``marker``, the parents' class for all others."""
    path = _col(path)
    return F.when(F.contains(path, F.lit(marker)), class_from_file(path)).otherwise(class_from_parents(path))


def class_below(path: Column | str, root: str) -> Column:
    """The parent if its own parent is named ``root``; else grandparent/parent."""
    path = _col(path)
    parent, grand = F.coalesce(_from_end(path, 2), F.lit("")), F.coalesce(_from_end(path, 3), F.lit(""))
    return F.when(path.isNull(), None).when(grand == root, parent).otherwise(F.concat(grand, F.lit("/"), parent))


def scene_of(name: Column | str) -> Column:
    """What stands before the first ``_pid``."""
    return F.element_at(F.split(_col(name), "_pid"), 1)


def frame_of(name: Column | str) -> Column:
    """The number between the first ``cnt`` and the next ``.``; null without one."""
    return F.regexp_extract(_col(name), r"cnt([0-9]+)(?:\.|$)", 1).try_cast("int")


def stem_of(name: Column | str) -> Column:
    """What stands before the first ``.``."""
    return F.substring_index(_col(name), ".", 1)


def flat_folder(folder: Column | str) -> Column:
    """``/`` to ``_``."""
    return F.replace(_col(folder), F.lit("/"), F.lit("_"))


def zero_pad(number: Column | str, width: int = 4) -> Column:
    """At least ``width`` digits; longer numbers are not cut."""
    text = _col(number).cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def group_name(number: Column | str) -> Column:
    return F.concat(F.lit("group_"), zero_pad(number))


def thousands(number: Column | str) -> Column:
    """``n div 1000`` and ``K`` from 1000 on, else the number."""
    number = _col(number).cast("long")
    kilo = F.floor(number / 1000).cast("long").cast("string")
    return F.when(number >= 1000, F.concat(kilo, F.lit("K"))).otherwise(number.cast("string"))


def undirected(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    """(smaller, larger) end of a link."""
    return F.least(_col(a), _col(b)), F.greatest(_col(a), _col(b))


def natural_key(name: Column | str) -> Column:
    """All integers of the base name, [0] without any: the sort key of shard files."""
    numbers = F.regexp_extract_all(base_name(name), F.lit(r"(\d+)"), 1)
    return F.when(F.size(numbers) > 0, F.transform(numbers, lambda x: x.cast("decimal(38,0)"))).otherwise(
        F.array(F.lit(0).cast("decimal(38,0)"))
    )


def rank_index(name: Column | str) -> tuple[Column, Column]:
    """(rank, index) of names like ``temp-{rank}_{index}_...``."""
    base = base_name(name)
    pattern = r"-(\d+)_(\d+)_"
    return F.regexp_extract(base, pattern, 1).try_cast("int"), F.regexp_extract(base, pattern, 2).try_cast("int")
