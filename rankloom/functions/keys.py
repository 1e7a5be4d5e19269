"""Repeatable pseudo-random keys.

``rand(seed)`` depends on partitioning, so a rerun after a lost executor or a
different input split can give other rows.  A seeded hash of the row's own key
is the same on every run and in every engine (the md5 hex digest matches DuckDB).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seeded_key(key, seed: int = 42) -> Column:
    """md5 hex of ``"<key>:<seed>"``: a uniform, repeatable sort key."""
    return F.md5(F.concat(_col(key).cast("string"), F.lit(f":{seed}")))


def hash_bucket(key, seed: int = 42, buckets: int = 100) -> Column:
    """Bucket in [0, buckets) from the first 8 hex digits of the seeded key."""
    head = F.conv(F.substring(seeded_key(key, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int")
