"""Review cleaning (drop rows missing critical fields or with an invalid rating)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The valid rating range and the raw columns not carried forward.
MIN_RATING, MAX_RATING = 1.0, 5.0
DROPPED_COLUMNS = ("vote", "style", "image", "reviewTime", "reviewerName")


def valid_review() -> F.Column:
    """Keep-condition: ids and rating present, 1 <= overall <= 5 (NaN fails: NaN sorts high)."""
    return (F.col("reviewerID").isNotNull() & F.col("asin").isNotNull()
            & F.col("overall").isNotNull()
            & (F.col("overall") >= MIN_RATING) & (F.col("overall") <= MAX_RATING))


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Valid reviews without the unused raw columns (one fused filter, pushed to the scan)."""
    return raw.filter(valid_review()).drop(*[c for c in DROPPED_COLUMNS if c in raw.columns])


def reject_counts(raw: DataFrame) -> DataFrame:
    """One pass over the raw table: total, kept and per-reason rejected row counts."""
    ok = valid_review()
    return raw.agg(
        F.count(F.lit(1)).alias("rawRows"),
        F.count_if(ok).alias("cleanRows"),
        F.count_if(F.col("reviewerID").isNull()).alias("nullReviewer"),
        F.count_if(F.col("asin").isNull()).alias("nullItem"),
        F.count_if(F.col("overall").isNull()).alias("nullRating"),
        F.count_if(F.col("overall").isNotNull()
                   & ~((F.col("overall") >= MIN_RATING) & (F.col("overall") <= MAX_RATING)))
        .alias("ratingOutOfRange"))
