"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.session import scratch_path

#: ASCII white space as the contracts name it: space, tab, newline, VT, FF, CR.
SPACE = r"\x20\x09-\x0D"
#: Upper to lower case for A-Z alone; other letters stay as they are.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can read again after a loss; the
    plan is computed once.
    """
    path = scratch_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(sizes, most: int):
    """(start, end) of runs of consecutive rows holding at most ``most`` bytes together
    (a larger row stands alone)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes):
        yield start, len(sizes)
