"""Parquet tables in and out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rankloom.session import scratch_path


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Read a parquet file or a folder of parts; select early so the scan prunes."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def optional_table(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    """A table that may be absent: a missing path gives an empty table of ``schema``,
    so left joins against it fall back to their defaults."""
    if path:
        try:
            return spark.read.schema(schema).parquet(path)
        except Exception as exc:  # noqa: BLE001 - Spark raises AnalysisException subclasses
            if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
                raise
    return spark.createDataFrame([], schema)


def write_table(df: DataFrame, path: str, files: int | None = None,
                sort_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write parquet, optionally as ``files`` parts.

    With ``sort_by`` the rows are range-partitioned on those keys and sorted
    inside each part: the folder is globally ordered without a single-task sort.
    Without it a count-only change uses ``repartition`` (round robin).
    """
    if sort_by:
        n = files or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
        df = df.repartitionByRange(int(n), *sort_by).sortWithinPartitions(*sort_by)
    elif files:
        df = df.repartition(files)
    df.write.mode(mode).parquet(path)


def kept(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: computed once, lineage cut
    with files that any executor can read again.  ``compression``: Parquet's codec, the session's
    by default."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
