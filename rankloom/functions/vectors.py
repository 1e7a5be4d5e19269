"""Vector arithmetic on ``array<double>`` columns with higher-order functions.

These replace row-at-a-time vector UDFs: they stay inside the JVM, need no
serialisation of an object vector per row, and read arrays as stored in parquet.
ML ``VectorUDT`` columns are converted only at model edges (``as_array``).
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    """Dot product of two equal-length arrays."""
    return _sum(F.zip_with(_col(a), _col(b), lambda x, y: x * y))


def l2_norm(v) -> Column:
    """Euclidean length; a null vector gives null."""
    return F.sqrt(_sum(F.transform(_col(v), lambda x: x * x)))


def cosine(a, b, norm_a=None, norm_b=None) -> Column:
    """Cosine similarity, 0.0 when either vector has zero length.

    Pass precomputed norms when one side is scored many times (a candidate pool).
    """
    na = l2_norm(a) if norm_a is None else _col(norm_a)
    nb = l2_norm(b) if norm_b is None else _col(norm_b)
    return F.when((na == 0.0) | (nb == 0.0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))


def as_array(v) -> Column:
    """ML vector → ``array<double>``; arrays of any numeric type are cast."""
    return vector_to_array(_col(v), "float64")


def as_vector(a) -> Column:
    """``array<double>`` → ML dense vector (only where an MLlib API needs it)."""
    return array_to_vector(_col(a))
