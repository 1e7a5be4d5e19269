"""Tables written in hash buckets of a key, so that joins and groupings by it need no shuffle.

A cluster that reads the same ratings many times writes them once by user and once by item.
Buckets can't be split while they are read: a key with a third of all rows makes one large
bucket, so such data is better read plainly (the default of the operators), where AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` files by the hash of ``key``, sorted by it, under
    the name ``table`` of the session's catalog (replaced if it exists); returns the table."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{table}`")
    # dealt by the same hash first: one file a bucket
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return spark.table(table)


def register_bucketed(spark: SparkSession, table: str, path: str, schema: str, key: str,
                      buckets: int) -> DataFrame:
    """A table that another application wrote: its folder, columns and buckets under a name."""
    spark.sql(f"DROP TABLE IF EXISTS `{table}`")
    spark.sql(f"CREATE TABLE `{table}` ({schema}) USING parquet "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
