"""Vector expressions on array columns: JVM-side, no Python.

A null vector gives null everywhere.  All arithmetic is in double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Added to the norm before division, so that a zero vector stays zero.
EPS = 1e-12


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v: Column | str) -> Column:
    return _col(v).cast("array<double>")


def as_float(v: Column | str) -> Column:
    return _col(v).cast("array<float>")


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(v: Column | str, eps: float = EPS) -> Column:
    """x / (|x| + eps); a zero vector stays zero."""
    length = norm(v) + F.lit(eps)
    return F.transform(as_double(v), lambda x: x / length)


def l2_normalize_guarded(v: Column | str) -> Column:
    """x / |x|, without eps; a zero vector is returned as it is."""
    length = norm(v)
    return F.when(length == 0, as_double(v)).otherwise(F.transform(as_double(v), lambda x: x / length))


def inner_product(a: Column | str, b: Column | str) -> Column:
    """Inner product; null if the lengths differ."""
    products = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Inner product over the product of the lengths; null if one is zero."""
    size = norm(a) * norm(b)
    return F.when(size > 0, inner_product(a, b) / size)


def vector_concat(*parts: Column | str) -> Column:
    return F.concat(*(_col(p) for p in parts))


def vector_slice(v: Column | str, start: int, length: int) -> Column:
    """``length`` entries from position ``start`` (from 0) on."""
    return F.slice(_col(v), start + 1, length)


def tail(v: Column | str, length: int) -> Column:
    """The last ``length`` entries; null if the vector is shorter."""
    column = _col(v)
    return F.when(F.size(column) >= length, F.slice(column, F.size(column) - length + 1, F.lit(length)))
