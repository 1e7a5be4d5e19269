"""Joins with a table of keys that Spark can split when a key of the other side is hot.

AQE splits a skewed partition of a join only if both inputs are exchanges made for that join.
A side that was grouped or joined by the same key before is already partitioned by it, so
Spark reuses that partitioning and cannot split.  Joining on the key and a hash of it asks for
a partitioning neither side has, so both sides get an exchange of their own (the key side is
narrow: one row a key), and AQE splits the hot partition.

``heavy_lookup_join`` does without the hot partition: frequent keys are found by a partial count
and joined by broadcast where their rows are, only the others are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.sources.tables import kept

HEAVY_ROWS = 100_000     # keys with fewer rows are never worth a path of their own


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("_kh", F.hash(key))


def semi_join(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in ``keys``."""
    return _keyed(rows, key).join(_keyed(keys.select(key), key), [key, "_kh"], "left_semi").drop("_kh")


def lookup_join(rows: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row a key."""
    return _keyed(rows, key).join(_keyed(table, key), [key, "_kh"], how).drop("_kh")


def heavy_keys(rows: DataFrame, key: str, least: int = HEAVY_ROWS) -> list:
    """The keys with more rows than a fair shuffle partition holds (and more than ``least``):
    fewer than the number of shuffle partitions.  One aggregate over the key column."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # read twice, computed once: the rows may be costly to make
    counts = kept(rows.groupBy(key).count(), "key-counts")
    # the largest of the counts alone meet in one task
    top = (counts.filter(F.col(key).isNotNull() & (F.col("count") > least))
           .orderBy(F.desc("count"), key).limit(parts).collect())
    if not top:
        return []
    n = counts.agg(F.sum("count")).first()[0]
    return [r[key] for r in top if r["count"] * parts > n]


def heavy_lookup_join(rows: DataFrame, table: DataFrame, key: str, how: str = "left",
                      least: int = HEAVY_ROWS) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row a key (``how``: left or inner).

    Rows of heavy keys meet their few rows of ``table`` by broadcast (fewer than the number of
    shuffle partitions) and are not moved; the rest is a plain lookup join.
    """
    heavy = heavy_keys(rows, key, least)
    if not heavy:
        return lookup_join(rows, table, key, how)
    hot = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    return (rows.filter(hot).join(F.broadcast(table.filter(F.col(key).isin(heavy))), key, how)
            .unionByName(lookup_join(rows.filter(~hot), table, key, how)))
