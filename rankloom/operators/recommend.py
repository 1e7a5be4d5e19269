"""The three recommendation paths and their combination.

* warm users (> 5 ratings): ALS candidates re-ranked by the GBT ranker (``als_gbt``)
* cold users with a taste profile: cosine to a popular-item pool (``w2v_personalized``)
* everyone else: the global popularity top-k (``popularity_fallback``)

Cold users are scored against the pool as matrices (``topk``); candidate lists are ranked by
a per-user window whose rows per user are bounded by the candidate count.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.scoring import TASTE_WEIGHTS, log_count, popularity_blend, taste_blend
from rankloom.functions.vectors import l2_norm
from rankloom.operators.bounded import bounded_array, bounded_ids
from rankloom.operators.ratings import WARM_MIN_RATINGS, user_activity
from rankloom.operators.sampling import sample_keys
from rankloom.operators.skew import semi_join
from rankloom.operators.topk import targets_of, topk_bounded

# Source tags, defaults for missing item data, pool and list sizes.
SOURCE_WARM, SOURCE_COLD, SOURCE_FALLBACK = "als_gbt", "w2v_personalized", "popularity_fallback"
DEFAULT_AVG_RATING = 3.0
DEFAULT_COUNT = 1
POOL_MIN_RATINGS, POOL_SIZE, TOP_K = 10, 1000, 10
REC_COLUMNS = ["userId", "itemId", "hybridScore", "alsScore", "w2vScore", "source", "rank"]


# ---------------------------------------------------------------- segmentation

def segment_users(ratings: DataFrame, sample_size: int | None = None, seed: int = 42,
                  activity: DataFrame | None = None,
                  warm_min: int = WARM_MIN_RATINGS) -> DataFrame:
    """(userId, userRatingCount, segment) for a repeatable sample of users.

    ``segment`` is ``warm`` for >= ``warm_min`` ratings, else ``cold``.
    """
    act = activity if activity is not None else user_activity(ratings)
    if sample_size is not None:
        act = act.join(sample_keys(act, "userId", sample_size, seed), "userId")
    return (act
            .withColumn("segment", F.when(F.col("userRatingCount") >= warm_min, F.lit("warm"))
                        .otherwise(F.lit("cold"))))


# ---------------------------------------------------------------- item tables

def item_vectors(item_emb: DataFrame, item_meta: DataFrame | None = None) -> DataFrame:
    """(itemId, embedding array<double>, itemAvgRating, itemReviewCount).

    ``item_meta`` (itemId, itemAvgRating[, itemReviewCount]) is optional; missing
    values fall back to the fixed defaults.
    """
    emb = item_emb.select(F.col("itemId").cast("int"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    # a vector with a null, NaN or infinite element counts as none
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    emb = emb.withColumn("embedding", F.when(~bad, F.col("embedding")))
    if item_meta is None:
        return (emb.withColumn("itemAvgRating", F.lit(DEFAULT_AVG_RATING))
                .withColumn("itemReviewCount", F.lit(DEFAULT_COUNT).cast("long")))
    meta = item_meta.select("itemId", "itemAvgRating",
                            (F.col("itemReviewCount") if "itemReviewCount" in item_meta.columns
                             else F.lit(None).cast("long")).alias("itemReviewCount"))
    return (emb.join(meta, "itemId", "left")
            .withColumn("itemAvgRating", F.coalesce("itemAvgRating", F.lit(DEFAULT_AVG_RATING)))
            .withColumn("itemReviewCount",
                        F.coalesce("itemReviewCount", F.lit(DEFAULT_COUNT).cast("long"))))


# ---------------------------------------------------------------- profiles

def user_profiles(ratings: DataFrame, users: DataFrame, item_emb: DataFrame,
                  track_items: list | None = None) -> DataFrame:
    """(userId, profile): the rating-weighted mean of the vectors of rated items.

    Only rated items that have a vector count; users with none get no row.  When a
    user's weights sum to <= 0 the weighted sum is returned undivided.  The sum is
    one partial+final aggregation (``Summarizer``) on a fixed-size buffer per user,
    so a user with very many ratings is combined across tasks, never gathered.

    ``track_items`` (a bounded id list, e.g. a candidate pool) adds ``seen``: the
    tracked items the user rated, collected in the same aggregation (at most
    ``len(track_items)`` per user).
    """
    rated = (semi_join(ratings.select("userId", "itemId", F.col("rating").cast("double").alias("w")),
                       users, "userId")
             .join(item_emb.select("itemId", "embedding").filter(F.col("embedding").isNotNull()),
                   "itemId"))
    weighted = array_to_vector(F.transform("embedding", lambda x: x * F.col("w")))
    aggs = [Summarizer.sum(weighted).alias("_s"), F.sum("w").alias("_w")]
    if track_items is not None:
        aggs.append(F.collect_set(F.when(F.col("itemId").isin(list(track_items)), F.col("itemId")))
                    .alias("seen"))
    agg = rated.groupBy("userId").agg(*aggs)
    s = vector_to_array(F.col("_s"), "float64")
    profile = F.when(F.col("_w") > 0, F.transform(s, lambda x: x / F.col("_w"))).otherwise(s)
    extra = ["seen"] if track_items is not None else []
    return agg.select("userId", profile.alias("profile"), *extra)


# ---------------------------------------------------------------- candidate pool

def candidate_pool(items: DataFrame, popularity: DataFrame, min_ratings: int = POOL_MIN_RATINGS,
                   k: int = POOL_SIZE) -> DataFrame:
    """The ``k`` most-rated items that have a vector and >= ``min_ratings`` ratings.

    Ties on the count are broken by itemId.  The ordered limit runs on
    (itemId, count) only; the vectors of the ≤ k winners are fetched afterwards
    with a broadcast of those ids, so no task ever gathers k vectors per partition.
    """
    counted = (items.filter(F.col("embedding").isNotNull()).select("itemId")
               .join(popularity, "itemId", "left")
               .withColumn("itemRatingCount",
                           F.coalesce("itemRatingCount", F.lit(DEFAULT_COUNT).cast("long")))
               .filter(F.col("itemRatingCount") >= min_ratings))
    top = counted.orderBy(F.desc("itemRatingCount"), F.asc("itemId")).limit(k)
    return (items.join(F.broadcast(top), "itemId")
            .select("itemId", "embedding", "itemAvgRating", "itemRatingCount",
                    log_count("itemRatingCount").alias("logItemPop")))


# ---------------------------------------------------------------- ranking helpers

def _top_k_array(scored: Column, k: int, ties: bool) -> Column:
    """Sort an array<struct<neg, itemId, ...>> ascending and keep the top ``k``.

    Returns array<struct<entry, rank>>.  Without ``ties`` ranks are 1..k (itemId
    breaks ties).  With ``ties`` every entry scoring at least the k-th score stays,
    ranked like SQL ``rank()`` (1 + number of strictly better entries).
    """
    if not ties:
        top = F.slice(F.sort_array(scored), 1, k)
        return F.transform(top, lambda e, i: F.struct(e.alias("e"), (i + 1).alias("rank")))

    def keep(ordered: Column) -> Column:
        kth = F.try_element_at(ordered, F.lit(k))["neg"]
        return F.when(F.size(ordered) <= k, ordered).otherwise(
            F.filter(ordered, lambda e: e["neg"] <= kth))

    def ranked(kept: Column) -> Column:
        return F.transform(kept, lambda e: F.struct(
            e.alias("e"), (F.size(F.filter(kept, lambda o: o["neg"] < e["neg"])) + 1).alias("rank")))

    return _let(_let(F.sort_array(scored), keep), ranked)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def rank_within_user(df: DataFrame, score: str = "hybridScore", k: int = TOP_K,
                     ties: bool = False, key: str = "userId") -> DataFrame:
    """Keep each user's best ``k`` rows by ``score`` (desc) and add ``rank`` (int).

    For inputs with a bounded number of rows per user (candidate lists).  The
    filter on the rank lets Spark insert a WindowGroupLimit that trims each task
    to k rows per user before the shuffle.
    """
    order = [F.desc(score)] if ties else [F.desc(score), F.asc("itemId")]
    w = Window.partitionBy(key).orderBy(*order)
    fn = F.rank() if ties else F.row_number()
    return df.withColumn("rank", fn.over(w).cast("int")).filter(F.col("rank") <= k)


# ---------------------------------------------------------------- cold path

def recommend_cold(profiles: DataFrame, pool: DataFrame, ratings: DataFrame | None = None,
                   k: int = TOP_K, ties: bool = False, exclude_seen: bool = True,
                   digits: int | None = None, max_pool: int | None = None) -> DataFrame:
    """Top-``k`` pool items per profile user by the taste blend (source ``w2v_personalized``).

    score = cosine(profile, item)·0.60 + avgRating/5·0.25 + logPop/10·0.15.  Items the
    user already rated are excluded first (``exclude_seen``): from the profiles'
    ``seen`` column when present (see ``user_profiles(track_items=...)``), else from
    ``ratings``.  ``digits`` rounds the score before ranking so that engines with
    different float summation agree.

    Profiles of a batch are one matrix, multiplied with blocks of the pool's matrix
    (``topk``): the item-only terms of the blend are the targets' bias, and blocks whose
    bound is below a user's k-th score are skipped.  No users × pool rows and no shuffle
    after the profiles.  The pool's size is checked (bytes, and ``max_pool`` if given).
    """
    norm = l2_norm("embedding")
    pool_rows = pool.select(
        "itemId", norm.alias("norm"),
        F.transform("embedding", lambda x: F.when(norm == 0, 0.0).otherwise(x / norm)).alias("unit"),
        taste_blend(F.lit(0.0), "itemAvgRating", "logItemPop").alias("rest"))
    targets = targets_of(pool_rows, "unit", "rest", ("norm",), max_rows=max_pool,
                         what="candidate pool")
    users = profiles.select("userId", "profile", *(["seen"] if "seen" in profiles.columns else []))
    if exclude_seen and "seen" not in profiles.columns and ratings is not None:
        ids = targets.ids.tolist()
        seen = (ratings.select("userId", "itemId").filter(F.col("itemId").isin(ids))
                .join(profiles.select("userId"), "userId", "left_semi")
                .groupBy("userId").agg(F.collect_set("itemId").alias("seen")))
        users = users.join(seen, "userId", "left")
    if not len(targets.ids):
        return _no_recs(users.sparkSession)
    best = topk_bounded(users, targets, k, "userId", "profile", weight=TASTE_WEIGHTS[0], unit=True,
                        ties=ties, digits=digits,
                        without="seen" if exclude_seen and "seen" in users.columns else None)
    return best.select("userId", F.col("itemId").cast(pool.schema["itemId"].dataType).alias("itemId"),
                       F.col("score").alias("hybridScore"), F.lit(0.0).alias("alsScore"),
                       F.col("norm").alias("w2vScore"), F.lit(SOURCE_COLD).alias("source"), "rank")


def _no_recs(spark) -> DataFrame:
    return spark.createDataFrame([], "userId int, itemId int, hybridScore double, alsScore double, "
                                     "w2vScore double, source string, rank int")


def pool_ids(pool: DataFrame, max_pool: int | None = None) -> list:
    """The item ids of a candidate pool (at most the k it was made with; ``max_pool``, if
    given, is checked)."""
    return bounded_ids(pool, "itemId", max_pool, "candidate pool")


# ---------------------------------------------------------------- fallback path

def users_without_profile(users: DataFrame, profiles: DataFrame) -> DataFrame:
    """Users (e.g. cold ones) that have no taste profile."""
    return users.select("userId").join(profiles.select("userId"), "userId", "left_anti")


def popularity_top(popularity: DataFrame, items: DataFrame | None, k: int = TOP_K,
                   digits: int | None = None) -> DataFrame:
    """Global top-``k`` items by logPop·0.5 + avgRating·0.3 + norm·0.2 (itemId breaks ties)."""
    base = popularity.select("itemId", "itemRatingCount")
    if items is not None:
        base = base.join(items.select("itemId", "embedding", "itemAvgRating"), "itemId", "left")
    else:
        base = (base.withColumn("embedding", F.lit(None).cast("array<double>"))
                .withColumn("itemAvgRating", F.lit(None).cast("double")))
    norm = F.when(F.col("embedding").isNull(), F.lit(0.0)).otherwise(l2_norm("embedding"))
    avg = F.coalesce("itemAvgRating", F.lit(DEFAULT_AVG_RATING))
    score = popularity_blend(log_count("itemRatingCount"), avg, norm)
    if digits is not None:
        score = F.round(score, digits)
    return (base.select("itemId", score.alias("hybridScore"), norm.alias("w2vScore"))
            .orderBy(F.desc("hybridScore"), F.asc("itemId")).limit(k))


def recommend_fallback(users: DataFrame, top: DataFrame, k: int = TOP_K,
                       ties: bool = False) -> DataFrame:
    """Every user gets the best k of the global list ``top`` (source ``popularity_fallback``)."""
    head = top.orderBy(F.desc("hybridScore"), F.asc("itemId")).limit(POOL_SIZE if ties else k)
    arr, _ = bounded_array(head.select(F.col("hybridScore").alias("score"), "itemId",
                                       F.col("w2vScore").alias("w2v")), POOL_SIZE,
                           "popularity top list")
    entries = F.transform(arr, lambda e: F.struct((-e["score"]).alias("neg"), e["itemId"].alias("itemId"),
                                                  e["score"].alias("score"), e["w2v"].alias("w2v")))
    ranked = _top_k_array(entries, k, ties)
    return (users.select("userId", F.explode(ranked).alias("t"))
            .select("userId", F.col("t.e.itemId").alias("itemId"),
                    F.col("t.e.score").alias("hybridScore"), F.lit(0.0).alias("alsScore"),
                    F.col("t.e.w2v").alias("w2vScore"), F.lit(SOURCE_FALLBACK).alias("source"),
                    F.col("t.rank").cast("int").alias("rank")))


# ---------------------------------------------------------------- combination

def combine(*paths: DataFrame) -> DataFrame:
    """Union of the path outputs by column name (no global sort: sort at write time)."""
    out = None
    for p in paths:
        p = p.select(*REC_COLUMNS)
        out = p if out is None else out.unionByName(p)
    return out


# ---------------------------------------------------------------- warm path

def recommend_warm(als_model, ranker, warm_users: DataFrame, items: DataFrame | None,
                   activity: DataFrame, popularity: DataFrame, n_candidates: int = 50,
                   k: int = TOP_K, ties: bool = False, exclude_seen: bool = False,
                   ratings: DataFrame | None = None) -> DataFrame:
    """ALS top-``n_candidates`` per warm user, re-scored by the ranker (source ``als_gbt``).

    Each user's list is bounded by ``n_candidates``, so the per-user min-max
    window and the final rank window stay small per key.  ``exclude_seen`` (needs
    ``ratings``) drops candidates the user already rated before ranking; off by
    default, as in the reference.
    """
    from rankloom.operators import als as A
    from rankloom.operators import features as FE
    from rankloom.operators import ranker as RK

    cands = A.candidates_for(als_model, warm_users, n_candidates)
    feats = FE.candidate_features(FE.candidate_minmax(cands), items, activity, popularity)
    scored = RK.score(ranker, feats).select(
        "userId", "itemId", "hybridScore", "alsScore", "w2vScore", F.lit(SOURCE_WARM).alias("source"))
    if exclude_seen:
        if ratings is None:
            raise ValueError("exclude_seen needs ratings")
        seen = ratings.select("userId", "itemId").join(warm_users.select("userId"), "userId", "left_semi")
        scored = scored.join(seen, ["userId", "itemId"], "left_anti")
    return rank_within_user(scored, k=k, ties=ties)
