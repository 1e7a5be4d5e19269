"""Ranker features, labels and the balanced training set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.keys import hash_bucket
from rankloom.functions.scoring import log_count, minmax_over
from rankloom.functions.vectors import l2_norm
from rankloom.operators.skew import lookup_join, semi_join

# Feature list, defaults for missing joins, class weights, balance ratio.
FEATURE_COLUMNS = ["alsScore", "w2vScore", "logItemPop", "logUserActivity", "itemAvgRating"]
DEFAULT_AVG_RATING = 3.0
DEFAULT_COUNT = 1
POSITIVE_WEIGHT, NEGATIVE_WEIGHT = 3.0, 1.0
NEGATIVES_PER_POSITIVE = 10
TRAIN_FRACTION = 0.8


def candidate_minmax(candidates: DataFrame, raw: str = "alsRawScore") -> DataFrame:
    """(userId, itemId, alsScore): raw scores min-max scaled per user, 0.5 when flat.

    Each user has a bounded candidate list (top-N of a model), so the per-user
    window is small.
    """
    return candidates.select("userId", "itemId", minmax_over(raw, "userId").alias("alsScore"))


def item_features(items: DataFrame | None, popularity: DataFrame) -> DataFrame:
    """(itemId, norm, itemAvgRating, itemReviewCount, itemRatingCount): one narrow row for
    every item with a vector or a rating."""
    if items is None:
        return popularity.select("itemId", F.lit(None).cast("double").alias("norm"),
                                 F.lit(None).cast("double").alias("itemAvgRating"),
                                 F.lit(None).cast("long").alias("itemReviewCount"), "itemRatingCount")
    own = items.select("itemId", F.when(F.col("embedding").isNotNull(), l2_norm("embedding")).alias("norm"),
                       "itemAvgRating", "itemReviewCount")
    return own.join(popularity, "itemId", "full")


def candidate_features(scored: DataFrame, items: DataFrame | None, activity: DataFrame,
                       popularity: DataFrame) -> DataFrame:
    """Join item, user and popularity data to (userId, itemId, alsScore) and derive features.

    ``items``: (itemId, embedding, itemAvgRating, itemReviewCount) or None.  What an item
    contributes is worked out once per item (``item_features``, a few numbers, no
    vector), then joined in one join that AQE can split on hot items.
    """
    out = lookup_join(scored, item_features(items, popularity), "itemId")
    out = out.join(activity, "userId", "left")
    dc = F.lit(DEFAULT_COUNT).cast("long")
    return out.select(
        "userId", "itemId", "alsScore", F.coalesce("norm", F.lit(0.0)).alias("w2vScore"),
        log_count(F.coalesce("itemRatingCount", dc)).alias("logItemPop"),
        log_count(F.coalesce("userRatingCount", dc)).alias("logUserActivity"),
        F.coalesce("itemAvgRating", F.lit(DEFAULT_AVG_RATING)).alias("itemAvgRating"),
        F.coalesce("userRatingCount", dc).alias("userRatingCount"),
        F.coalesce("itemRatingCount", dc).alias("itemRatingCount"),
        F.coalesce("itemReviewCount", dc).alias("itemReviewCount"))


def label_candidates(features: DataFrame, ratings: DataFrame, users: DataFrame) -> DataFrame:
    """label = 1.0 when the user rated the item (any rating, duplicates counted once)."""
    rated = (semi_join(ratings.select("userId", "itemId"), users, "userId")
             .distinct().withColumn("_hit", F.lit(1)))
    return (features.join(rated, ["userId", "itemId"], "left")
            .withColumn("label", F.when(F.col("_hit") == 1, F.lit(1.0)).otherwise(F.lit(0.0)))
            .drop("_hit"))


def label_counts(labeled: DataFrame) -> DataFrame:
    """(positives, negatives, positiveRate %) in one pass; rate 0.0 when empty."""
    pos, neg = F.count_if(F.col("label") == 1.0), F.count_if(F.col("label") == 0.0)
    return labeled.agg(pos.alias("positives"), neg.alias("negatives")).select(
        "positives", "negatives",
        F.coalesce(F.try_divide(F.col("positives") * 100.0,
                                F.col("positives") + F.col("negatives")), F.lit(0.0))
        .alias("positiveRate"))


def negative_fraction(positives: int, negatives: int,
                      ratio: int = NEGATIVES_PER_POSITIVE) -> float:
    """min(1, ratio·pos/neg); 1.0 when there are no negatives."""
    if negatives <= 0:
        return 1.0
    return min(1.0, positives * ratio / negatives)


def balanced_training_set(labeled: DataFrame, seed: int = 42,
                          ratio: int = NEGATIVES_PER_POSITIVE,
                          train_fraction: float = TRAIN_FRACTION) -> DataFrame:
    """Positives (weight 3) + hash-downsampled negatives (weight 1), with a split column.

    The negative fraction needs the label counts: one small aggregate job.  Both the
    downsampling and the 80/20 split are hash buckets of (userId, itemId), so the
    set is identical on every run.
    """
    counts = label_counts(labeled).first()
    frac = negative_fraction(counts["positives"], counts["negatives"], ratio)
    pair = F.concat_ws("|", F.col("userId").cast("string"), F.col("itemId").cast("string"))
    keep_neg = hash_bucket(pair, seed, 1_000_000) < int(round(frac * 1_000_000))
    is_pos = F.col("label") == 1.0
    out = labeled.filter(is_pos | ((F.col("label") == 0.0) & keep_neg))
    split = F.when(hash_bucket(pair, seed + 1, 100) < int(round(train_fraction * 100)),
                   F.lit("train")).otherwise(F.lit("test"))
    return out.select(
        "userId", "itemId", "label",
        F.when(is_pos, F.lit(POSITIVE_WEIGHT)).otherwise(F.lit(NEGATIVE_WEIGHT)).alias("classWeight"),
        *FEATURE_COLUMNS, split.alias("split"))
