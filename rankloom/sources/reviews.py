"""Raw review scan with a fixed schema (no inference pass over the input)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The raw review layout, all fields nullable.
REVIEW_SCHEMA = T.StructType([
    T.StructField("overall", T.DoubleType()),
    T.StructField("verified", T.BooleanType()),
    T.StructField("reviewTime", T.StringType()),
    T.StructField("reviewerID", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("reviewerName", T.StringType()),
    T.StructField("reviewText", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("unixReviewTime", T.LongType()),
    T.StructField("vote", T.StringType()),
    T.StructField("style", T.MapType(T.StringType(), T.StringType())),
    T.StructField("image", T.ArrayType(T.StringType())),
])


def read_reviews(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """Read JSON lines (plain or gzip) with the fixed schema.

    Malformed lines become all-null rows and wrong-typed fields become null
    (PERMISSIVE mode); cleaning drops them.  A ``.gz`` file cannot be split, so
    it is read by one task: the rows are spread over ``partitions`` (default when
    the input has ``.gz`` files, also inside a folder: the shuffle partition count) right after the scan instead of
    running the whole pipeline in that one task.
    """
    df = spark.read.schema(REVIEW_SCHEMA).option("mode", "PERMISSIVE").json(path)
    if partitions is None and any(f.endswith(".gz") for f in df.inputFiles()):
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if partitions:
        df = df.repartition(partitions)
    return df
