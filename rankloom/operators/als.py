"""Collaborative filtering with Spark ML's ALS (explicit ratings).

ALS itself is blocked and shuffles factor blocks between iterations; its lineage
is cut every ``checkpoint_interval`` iterations in the session's shared
checkpoint folder (``spark.checkpoint.dir``), so a lost executor does not force a
recomputation from the first iteration.
"""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators.ratings import active_ratings
from rankloom.operators.sampling import split_by_hash
from rankloom.operators.skew import semi_join
from rankloom.operators.topk import topk_by_norm

# The reference's ALS settings.
RANK, MAX_ITER, REG_PARAM, CHECKPOINT_INTERVAL = 15, 5, 0.1, 2
TOP_USERS, TOP_ITEMS, SUBSET_CANDIDATES = 5, 5, 50
RATINGS_PER_BLOCK = 1_000_000
MOST_PER_BLOCK = 16_000_000     # 0.2 GB of a block's ratings, twice while it is built
MIN_BLOCKS = 10      # Spark ML's own default


def als_estimator(rank: int = RANK, max_iter: int = MAX_ITER, reg: float = REG_PARAM,
                  blocks: int = MIN_BLOCKS, seed: int = 42,
                  checkpoint_interval: int = CHECKPOINT_INTERVAL) -> ALS:
    return ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol="userId", itemCol="itemId",
               ratingCol="rating", coldStartStrategy="drop", numUserBlocks=blocks,
               numItemBlocks=blocks, implicitPrefs=False, checkpointInterval=checkpoint_interval,
               seed=seed)


def split_ratings(ratings: DataFrame, by: str = "row", seed: int = 42,
                  train_fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Repeatable train/test split: by row (the reference's choice), by user, or by
    time (ratings after the ``train_fraction`` timestamp quantile are the test side;
    needs a ``timestamp`` column)."""
    if by == "user":
        return tuple(split_by_hash(ratings, "userId", (train_fraction, 1 - train_fraction), seed))
    if by == "time":
        cut = ratings.agg(F.percentile_approx("timestamp", train_fraction, 100_000)).first()[0]
        if cut is None:
            return ratings, ratings.limit(0)
        return ratings.filter(F.col("timestamp") <= cut), ratings.filter(F.col("timestamp") > cut)
    if by != "row":
        raise ValueError("by must be 'row', 'user' or 'time'")
    # the row's content is its key: exact duplicates land on the same side
    keyed = ratings.withColumn("_k", F.concat_ws("|", *[F.col(c).cast("string") for c in ratings.columns]))
    tr, te = split_by_hash(keyed, "_k", (train_fraction, 1 - train_fraction), seed)
    return tr.drop("_k"), te.drop("_k")


def blocks_for(ratings: int, parallelism: int, per_block: int = RATINGS_PER_BLOCK) -> int:
    """User and item blocks: ``per_block`` ratings each, and enough for all cores."""
    return max(MIN_BLOCKS, parallelism, -(-ratings // per_block))


def train_als(train: DataFrame, **params) -> ALSModel:
    """Fit ALS on (userId, itemId, rating); ``blocks`` by default from the rating count.

    Every half-iteration sends a factor to each block that has a rating of it, so with more
    blocks more is shuffled than the ratings grow.  There are as many as cores, more only where
    a block would not fit.
    """
    if params.get("blocks") is None:
        cores = train.sparkSession.sparkContext.defaultParallelism
        params["blocks"] = blocks_for(train.count(), cores, MOST_PER_BLOCK)
    return als_estimator(**params).fit(train.select("userId", "itemId", "rating"))


def fit_active(ratings: DataFrame, min_ratings: int = 5, by: str = "row", seed: int = 42,
               **params) -> tuple[ALSModel, DataFrame, DataFrame]:
    """Active users only, split, fit: returns (model, train, test)."""
    extra = ["timestamp"] if by == "time" else []
    active = active_ratings(ratings, min_ratings, extra)
    train, test = split_ratings(active, by, seed)
    return train_als(train, seed=seed, **params), train, test


def predict(model: ALSModel, test: DataFrame) -> DataFrame:
    """(userId, itemId, rating, prediction) for known users/items, NaN and null dropped."""
    return (model.transform(test.select("userId", "itemId", "rating"))
            .filter(F.col("prediction").isNotNull() & ~F.isnan("prediction")))


def rmse(predictions: DataFrame) -> float:
    return RegressionEvaluator(metricName="rmse", labelCol="rating",
                               predictionCol="prediction").evaluate(predictions)


def _best(queries: DataFrame, targets: DataFrame, k: int, query: str, target: str) -> DataFrame:
    """Best ``k`` targets of every query by the model's prediction (the inner product of the
    factors): targets in buckets of falling norm instead of all pairs of factor blocks."""
    def factors(df):
        return df.select("id", F.col("features").alias("vector"))

    best = topk_by_norm(factors(queries), factors(targets), k, query, target)
    # the model's predictions are floats
    return best.select(query, F.col(target).cast("int").alias(target),
                       F.col("score").cast("float").cast("double").alias("alsRawScore"))


def user_topk(model: ALSModel, k: int = TOP_USERS) -> DataFrame:
    """(userId, itemId, alsRawScore): best ``k`` items of every user."""
    return _best(model.userFactors, model.itemFactors, k, "userId", "itemId")


def item_topk(model: ALSModel, k: int = TOP_ITEMS) -> DataFrame:
    """(itemId, userId, alsRawScore): best ``k`` users of every item."""
    return _best(model.itemFactors, model.userFactors, k, "itemId", "userId")


def candidates_for(model: ALSModel, users: DataFrame, n: int = SUBSET_CANDIDATES) -> DataFrame:
    """(userId, itemId, alsRawScore) for the best ``n`` items of each listed user.

    Users unknown to the model get no rows (see ``uncovered_users``).
    """
    asked = semi_join(model.userFactors, users.select(F.col("userId").alias("id")), "id")
    return _best(asked, model.itemFactors, n, "userId", "itemId")


def uncovered_users(model: ALSModel, users: DataFrame) -> DataFrame:
    """Listed users that have no factor vector in the model."""
    known = model.userFactors.select(F.col("id").alias("userId"))
    return users.select("userId").join(known, "userId", "left_anti")


def item_factors(model: ALSModel) -> DataFrame:
    """(itemId, alsEmbedding array<float>)."""
    return model.itemFactors.select(F.col("id").alias("itemId"), F.col("features").alias("alsEmbedding"))
