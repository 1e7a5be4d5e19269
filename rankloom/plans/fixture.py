"""Shared derivations of the fixture tables used by the registered queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.operators import ratings as R
from rankloom.operators import recommend as REC
from rankloom.sources import testdata as td

DIGITS = 6   # doubles are compared with the oracle after rounding to 6 digits


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (engines sum floats in different orders)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name) for f in df.schema.fields])


class Fixture:
    """Lazy fixture views and the derived tables most queries share."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._memo = spark, sf_dir, {}

    def view(self, name: str) -> DataFrame:
        return td.view(self.spark, self.sf_dir, name, self._memo)

    @cached_property
    def ratings(self) -> DataFrame:
        return self.view("ratings")

    @cached_property
    def activity(self) -> DataFrame:
        return R.user_activity(self.ratings)

    @cached_property
    def popularity(self) -> DataFrame:
        return R.item_popularity(self.ratings)

    @cached_property
    def items(self) -> DataFrame:
        """Item vectors with the average rating from the ratings table."""
        stats = R.item_rating_stats(self.ratings).select(
            "itemId", "itemAvgRating", F.col("itemRatingCount").alias("itemReviewCount"))
        return REC.item_vectors(self.view("item_emb"), stats)

    @cached_property
    def segments(self) -> DataFrame:
        return REC.segment_users(self.ratings, activity=self.activity)

    @cached_property
    def cold_users(self) -> DataFrame:
        return self.segments.filter(F.col("segment") == "cold").select("userId")

    @cached_property
    def warm_users(self) -> DataFrame:
        return self.segments.filter(F.col("segment") == "warm").select("userId")

    @cached_property
    def profiles(self) -> DataFrame:
        return REC.user_profiles(self.ratings, self.cold_users, self.items)

    @cached_property
    def profiles_seen(self) -> DataFrame:
        """Profiles with the pool items each user rated (one aggregation)."""
        return REC.user_profiles(self.ratings, self.cold_users, self.items,
                                 track_items=REC.pool_ids(self.pool))

    @cached_property
    def pool(self) -> DataFrame:
        # at most POOL_SIZE rows: cached so its two small fetches share one run
        return REC.candidate_pool(self.items, self.popularity).cache()


    @cached_property
    def reviews(self) -> DataFrame:
        return self.view("reviews")

    @cached_property
    def clean(self) -> DataFrame:
        from rankloom.operators.clean import clean_reviews
        return clean_reviews(self.reviews)

    @cached_property
    def user_index(self) -> DataFrame:
        from rankloom.operators.index import build_index
        return build_index(self.clean, "reviewerID", "userIndex")

    @cached_property
    def item_index(self) -> DataFrame:
        from rankloom.operators.index import build_index
        return build_index(self.clean, "asin", "itemIndex")

    @cached_property
    def item_stats(self) -> DataFrame:
        from rankloom.operators.docs import item_text_stats
        return item_text_stats(self.clean)

    @cached_property
    def docs(self) -> DataFrame:
        from rankloom.operators.docs import item_documents
        return item_documents(self.clean)
