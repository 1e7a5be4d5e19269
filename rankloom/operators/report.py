"""Reports over recommendations and ratings, and batch user lookups.

Single-row reports are built without joining one-row tables together: each part
is a distributed aggregate, the parts are unioned by name (missing columns null)
and folded with ``max``, so every number comes from the cluster in one plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.scoring import (
    COLD_MAX, POWER_MIN, clamp, product_url, rmse_quality, segment_label, unknown_label,
)
from rankloom.operators.sampling import sample_per_group
from rankloom.operators.skew import heavy_lookup_join, lookup_join
from rankloom.sources.tables import kept

# List length bounds for lookups, rounding of served scores.
MIN_N, MAX_N, DEFAULT_N = 1, 10, 10
SCORE_DIGITS, RATING_DIGITS, PCT_DIGITS = 4, 2, 2
NOT_FOUND_MESSAGE = "No recommendations found for this user."


def _fold(*parts: DataFrame) -> DataFrame:
    """One row: the union of single-row aggregates, columns folded with max."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


def _pct(num, den, digits: int | None = None):
    v = F.coalesce(F.try_divide(F.col(num).cast("double") * 100.0, F.col(den)), F.lit(0.0))
    return F.round(v, digits) if digits is not None else v


def source_breakdown(recs: DataFrame) -> DataFrame:
    """(source, totalRecs, usersServed) ordered by source."""
    return (recs.groupBy("source")
            .agg(F.count(F.lit(1)).alias("totalRecs"), F.countDistinct("userId").alias("usersServed"))
            .orderBy("source"))


def coverage_report(recs: DataFrame, sampled: DataFrame, ratings: DataFrame) -> DataFrame:
    """Totals and coverage % of the sampled users and of all rated users.

    Coverage of the sample divides by the real sample size (not a fixed constant).
    """
    r = recs.agg(F.count(F.lit(1)).alias("totalRecs"), F.countDistinct("userId").alias("usersWithRecs"))
    s = sampled.agg(F.countDistinct("userId").alias("sampledUsers"))
    t = ratings.agg(F.countDistinct("userId").alias("totalUsers"))
    out = _fold(r, s, t)
    return out.select("totalRecs", "usersWithRecs", "sampledUsers", "totalUsers",
                      _pct("usersWithRecs", "sampledUsers").alias("coverageSampledPct"),
                      _pct("usersWithRecs", "totalUsers").alias("coverageAllPct"))


def path_coverage(recs: DataFrame, users: DataFrame, source: str) -> DataFrame:
    """(source, usersServed, usersTargeted) for one path: of the targeted ``users``."""
    served = (recs.filter(F.col("source") == source).join(users.select("userId"), "userId", "left_semi")
              .agg(F.countDistinct("userId").alias("usersServed")))
    target = users.agg(F.countDistinct("userId").alias("usersTargeted"))
    return _fold(served, target).select(F.lit(source).alias("source"), "usersServed", "usersTargeted")


def personalization(recs: DataFrame) -> DataFrame:
    """Distinct rank-1 items over users with recommendations, in %."""
    out = recs.agg(F.countDistinct(F.when(F.col("rank") == 1, F.col("itemId"))).alias("uniqueTopItems"),
                   F.countDistinct("userId").alias("usersWithRecs"))
    return out.select("uniqueTopItems", "usersWithRecs",
                      _pct("uniqueTopItems", "usersWithRecs").alias("personalizationPct"))


def rec_preview(recs: DataFrame, source: str = "w2v_personalized", max_rank: int = 3,
                n: int = 15) -> DataFrame:
    """The first ``n`` rows of one source with rank <= ``max_rank`` (user, rank order)."""
    return (recs.filter((F.col("source") == source) & (F.col("rank") <= max_rank))
            .orderBy("userId", "rank", "itemId").limit(n))


def dataset_counts(activity: DataFrame, popularity: DataFrame) -> DataFrame:
    """Row, user and item counts and the activity segments in one row, from the two tables
    of counts (one row per user, one per item): no distinct count over the ratings."""
    n = F.col("userRatingCount")
    r = popularity.filter(F.col("itemId").isNotNull()).agg(F.count(F.lit(1)).alias("totalItems"))
    a = activity.agg(F.coalesce(F.sum(n), F.lit(0)).alias("totalRatings"),
                     F.count("userId").alias("totalUsers"),
                     F.count_if(n <= COLD_MAX).alias("coldUsers"),
                     F.count_if(n > COLD_MAX).alias("warmUsers"),
                     F.count_if(n > POWER_MIN).alias("powerUsers"))
    return _fold(r, a).select("totalRatings", "totalUsers", "totalItems", "coldUsers",
                              "warmUsers", "powerUsers")


def dataset_stats(activity: DataFrame, popularity: DataFrame, recs: DataFrame) -> DataFrame:
    """Dashboard numbers: totals, users with recs, coverage %, segment counts.

    ``warmUsers`` counts every user above the cold cut, power users included.
    """
    base = dataset_counts(activity, popularity)
    served = recs.agg(F.countDistinct("userId").alias("usersWithRecs"))
    out = _fold(base, served)
    return out.select("totalUsers", "totalItems", "totalRatings", "usersWithRecs",
                      _pct("usersWithRecs", "totalUsers", PCT_DIGITS).alias("coveragePct"),
                      "coldUsers", "warmUsers", "powerUsers")


def segment_share(activity: DataFrame) -> DataFrame:
    """(segment, users, sharePct) for cold / regular / power; shares of all users, 1 digit."""
    n = F.col("userRatingCount")
    seg = segment_label(n)
    counts = activity.groupBy(seg.alias("segment")).agg(F.count(F.lit(1)).alias("users"))
    total = F.sum("users").over(Window.partitionBy())   # three rows at most
    return counts.select("segment", "users",
                         F.round(F.coalesce(F.try_divide(F.col("users") * 100.0, total), F.lit(0.0)), 1)
                         .alias("sharePct"))


def item_facts(item_index: DataFrame | None, item_meta: DataFrame | None) -> DataFrame | None:
    """(itemId, asin, _avg, _cnt), one row an item: its key and its numbers; null without any
    table.  An item without a key goes by its ``UNKNOWN_`` label, in ``item_meta`` too."""
    if item_index is None and item_meta is None:
        return None
    none = [F.lit(None).cast("double").alias("_avg"), F.lit(None).cast("long").alias("_cnt")]
    idx = None if item_index is None else item_index.select(
        F.col("itemIndex").cast("int").alias("itemId"), "asin")
    if item_meta is None:
        return idx.select("itemId", "asin", *none)
    meta = item_meta.select("asin", F.col("avgRating").alias("_avg"),
                            F.col("reviewCount").alias("_cnt")).dropDuplicates(["asin"])
    if idx is not None:
        meta = kept(meta, "item-meta")       # read twice below: reviews are aggregated once
    number = F.regexp_extract("asin", "(-?[0-9]+)$", 1).try_cast("int")
    labelled = meta.withColumn("itemId", number).filter(F.col("asin") == unknown_label("itemId"))
    if idx is None:
        return labelled.select("itemId", "asin", "_avg", "_cnt")
    return idx.join(meta, "asin", "left").select("itemId", "asin", "_avg", "_cnt").unionByName(
        labelled.join(idx, "itemId", "left_anti").select("itemId", "asin", "_avg", "_cnt"))


def enrich_recs(recs: DataFrame, item_index: DataFrame | None, item_meta: DataFrame | None,
                split_heavy: bool = True) -> DataFrame:
    """Attach asin (or ``UNKNOWN_<id>``), item rating/review count (0 when unknown),
    rounded scores and the product URL to recommendation rows.

    Item tables are joined first, so recommendations are shuffled once; those of items in very
    many lists (the fallback's ten) are not shuffled at all (``skew.heavy_lookup_join``;
    ``split_heavy=False`` saves its count where ``recs`` is known to be small).
    """
    facts = item_facts(item_index, item_meta)
    if facts is None:
        out = recs.select("*", F.lit(None).cast("string").alias("asin"),
                          F.lit(None).cast("double").alias("_avg"), F.lit(None).cast("long").alias("_cnt"))
    else:
        out = (heavy_lookup_join if split_heavy else lookup_join)(recs, facts, "itemId")
    out = out.withColumn("asin", F.coalesce("asin", unknown_label("itemId")))
    return out.select(
        "userId", F.col("rank").cast("int").alias("rank"), "itemId", "asin",
        F.round("hybridScore", SCORE_DIGITS).alias("hybridScore"),
        F.round("alsScore", SCORE_DIGITS).alias("alsScore"),
        F.round("w2vScore", SCORE_DIGITS).alias("w2vScore"), "source",
        F.round(F.coalesce("_avg", F.lit(0.0)), RATING_DIGITS).alias("avgRating"),
        F.coalesce("_cnt", F.lit(0)).cast("long").alias("reviewCount"),
        product_url("asin").alias("amazonUrl"))


def lookup_recs(requests: DataFrame, recs: DataFrame, activity: DataFrame,
                item_index: DataFrame | None = None, item_meta: DataFrame | None = None) -> DataFrame:
    """Answer a batch of lookups: ``requests`` (userId[, n]) → one row per returned
    recommendation, or one row with ``found = false`` when the user has none.

    n is clamped to 1..10 (default 10); a user's list is their rows with rank <= n.  Only the
    recommendations of requested users are enriched, and their lists are cut by the stored
    rank, without a window.
    """
    req = requests.select(
        "userId", clamp(F.coalesce(F.col("n") if "n" in requests.columns else F.lit(None),
                                   F.lit(DEFAULT_N)), MIN_N, MAX_N).alias("topN"))
    wanted = recs.join(req.select("userId").distinct(), "userId", "left_semi").filter(
        F.col("rank") <= MAX_N)
    listed = enrich_recs(wanted, item_index, item_meta, split_heavy=False)
    # the source a user is served by: that of the first row (a user's rows share it)
    first = (wanted.filter(F.col("rank") == 1).groupBy("userId")
             .agg(F.min_by("source", "itemId").alias("userSource")))
    own = listed.withColumnRenamed("userId", "_u")
    hits = (req.join(own, (F.col("userId") == F.col("_u")) & (F.col("rank") <= F.col("topN")), "left")
            .join(first, "userId", "left"))
    out = hits.join(activity.select("userId", "userRatingCount"), "userId", "left")
    found = F.col("itemId").isNotNull()
    count = F.coalesce("userRatingCount", F.lit(0)).cast("long")
    return out.select(
        "userId", "topN", found.alias("found"),
        F.col("userRatingCount").isNotNull().alias("userExists"),
        F.when(found, count).alias("ratingCount"),
        F.when(found, segment_label(count)).alias("segment"),
        F.when(found, F.col("userSource")).alias("source"),
        F.when(~found, F.lit(NOT_FOUND_MESSAGE)).alias("message"),
        "rank", "itemId", "asin", "hybridScore", "alsScore", "w2vScore", "avgRating",
        "reviewCount", "amazonUrl")


def sample_users_by_segment(recs: DataFrame, activity: DataFrame, k: int = 5,
                            seed: int = 42) -> DataFrame:
    """Up to ``k`` users with recommendations per segment (cold / regular / power)."""
    users = recs.select("userId").distinct().join(activity, "userId", "left")
    labelled = users.filter(F.col("userRatingCount").isNotNull()).withColumn(
        "segment", segment_label("userRatingCount"))
    return sample_per_group(labelled, "segment", "userId", k, seed).select(
        "segment", "userId", "userRatingCount")


def rmse_report(predictions: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """(n, rmse, quality) over rows with a non-null, non-NaN prediction."""
    ok = predictions.filter(F.col(prediction).isNotNull() & ~F.isnan(F.col(prediction)))
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    out = ok.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(err * err)).alias("rmse"))
    return out.select("n", "rmse", rmse_quality("rmse").alias("quality"))


def accuracy_report(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(n, accuracy): share of rows whose prediction equals the label."""
    hit = F.when(F.col(prediction) == F.col(label), F.lit(1)).otherwise(F.lit(0))
    return predictions.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))
