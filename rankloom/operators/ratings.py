"""Rating tables: ids from natural keys, activity and popularity counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators.skew import semi_join

# Activity thresholds.
ALS_MIN_RATINGS = 5      # users with >= 5 ratings are trained on
WARM_MIN_RATINGS = 6     # users with > 5 ratings are served as warm


def build_ratings(clean: DataFrame, user_index: DataFrame, item_index: DataFrame) -> DataFrame:
    """Clean reviews → (userId int, itemId int, rating float, timestamp long).

    Index ids are long; the int cast raises on overflow (ANSI) instead of wrapping.
    Duplicate (user, item) reviews are kept, one row each.
    """
    return (clean.join(user_index, "reviewerID").join(item_index, "asin")
            .select(F.col("userIndex").cast("int").alias("userId"),
                    F.col("itemIndex").cast("int").alias("itemId"),
                    F.col("overall").cast("float").alias("rating"),
                    F.col("unixReviewTime").alias("timestamp")))


def user_activity(ratings: DataFrame) -> DataFrame:
    """(userId, userRatingCount): partial counts per task, then one shuffle."""
    return ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("userRatingCount"))


def item_popularity(ratings: DataFrame) -> DataFrame:
    """(itemId, itemRatingCount)."""
    return ratings.groupBy("itemId").agg(F.count(F.lit(1)).alias("itemRatingCount"))


def item_rating_stats(ratings: DataFrame) -> DataFrame:
    """(itemId, itemRatingCount, itemAvgRating) from ratings alone."""
    return ratings.groupBy("itemId").agg(
        F.count(F.lit(1)).alias("itemRatingCount"),
        F.avg(F.col("rating").cast("double")).alias("itemAvgRating"))


def active_ratings(ratings: DataFrame, min_ratings: int = ALS_MIN_RATINGS,
                   extra: list[str] | None = None, colocated: bool = False) -> DataFrame:
    """Ratings of users with at least ``min_ratings`` complete ratings.

    Rows with a null or NaN field are dropped first.  The user filter is a
    semi join against the aggregated counts that AQE can split (``skew``), so a hot
    user's rows do not meet in one task; there is no window over users.  ``colocated`` says
    that ``ratings`` is a table in buckets of ``userId`` (``sources.bucketed``): count and join
    then read it as it lies, without a shuffle and without splits.
    """
    base = ratings.select(F.col("userId").cast("int"), F.col("itemId").cast("int"),
                          F.col("rating").cast("float"), *(extra or [])).na.drop()
    keep = (user_activity(base).filter(F.col("userRatingCount") >= min_ratings)
            .select("userId"))
    if colocated:
        return base.join(keep, "userId", "left_semi")
    return semi_join(base, keep, "userId")
