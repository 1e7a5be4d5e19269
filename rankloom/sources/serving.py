"""Recommendations stored for lookups: a request batch reads the files it can hit.

The table is partitioned by a hash bucket of the user and sorted by user within each file, so
a batch of requests prunes folders by its buckets and row groups by its users' range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "_bucket"
BUCKETS = 256
FEW_USERS = 1000      # up to so many users are named in the scan's filter


def bucket_of(user: Column | str, buckets: int) -> Column:
    return F.pmod(F.hash(F.col(user) if isinstance(user, str) else user), F.lit(buckets)).cast("int")


def write_serving(recs: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write ``recs`` (with ``userId``) for ``read_serving``; an earlier table is replaced."""
    (recs.withColumn(BUCKET, bucket_of("userId", buckets))
     .repartition(buckets, BUCKET).sortWithinPartitions(BUCKET, "userId")
     .write.mode("overwrite").partitionBy(BUCKET).parquet(path))


def read_serving(spark: SparkSession, path: str, requests: DataFrame | None = None,
                 buckets: int = BUCKETS) -> DataFrame:
    """The stored recommendations; with ``requests`` (a batch with ``userId``) at least those of
    its users, from the folders and row groups that can hold them.

    At most ``buckets`` numbers and ``FEW_USERS`` ids come to the driver.  ``buckets`` must be
    the number the table was written with.
    """
    table = spark.read.parquet(path)
    if requests is not None:
        users = requests.select(F.col("userId").alias("u")).dropna().distinct()
        hit = [r["b"] for r in users.select(bucket_of("u", buckets).alias("b")).distinct().collect()]
        table = table.filter(F.col(BUCKET).isin(hit))
        few = [r["u"] for r in users.limit(FEW_USERS + 1).collect()]
        if len(few) <= FEW_USERS:
            table = table.filter(F.col("userId").isin(few))
    return table.drop(BUCKET)
