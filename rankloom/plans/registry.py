"""Named queries over the fixture tables: each takes (spark, sf_dir) → DataFrame.

Every query reads the driver's tables (through the fixture views), so its work
grows with the scale factor.  Doubles are rounded to 6 digits for the oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.vectors import cosine, dot, l2_norm
from rankloom.operators import als as A
from rankloom.operators import als_salted as SA
from rankloom.operators import clean as CL
from rankloom.operators.cooccur import pair_counts
from rankloom.operators import docs as D
from rankloom.operators import embed as EM
from rankloom.operators import features as FE
from rankloom.operators import index as IX
from rankloom.operators import ratings as R
from rankloom.operators import recommend as REC
from rankloom.operators import report as RP
from rankloom.operators import sampling as S
from rankloom.operators.metrics import ranking_metrics
from rankloom.operators.topk import nearest
from rankloom.plans.fixture import DIGITS, Fixture, rounded
from rankloom.session import scratch_path
from rankloom.sources import read_reviews, read_serving, read_table, write_bucketed, write_serving, write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SAMPLE_SHARE = 10        # the sampling checks draw a tenth of the users


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Fixture(spark, sf_dir))
    return fn


# ------------------------------------------------------------ preprocessing

@query
def clean_reviews(fx):
    return CL.clean_reviews(fx.reviews)


@query
def review_rejects(fx):
    return CL.reject_counts(fx.reviews)


@query
def reviews_json_scan(fx):
    """Reviews written as gzipped JSON lines (plus malformed lines), scanned with the fixed
    schema and cleaned: equal to ``clean_reviews``."""
    base = scratch_path(fx.spark, f"reviews-json-{uuid.uuid4().hex}")
    fx.reviews.write.mode("overwrite").json(f"{base}/good", compression="gzip")
    bad = fx.spark.createDataFrame(
        [('{"overall": "five", "reviewerID": "U1", "asin": "I1"}',), ("{not json",),
         ('{"overall": 4.0, "reviewerID": null, "asin": "I2"}',)], "value string")
    bad.coalesce(1).write.mode("overwrite").text(f"{base}/bad")
    # as many files as tasks wrote: read where they lie, without a shuffle
    raw = read_reviews(fx.spark, [f"{base}/good", f"{base}/bad"], partitions=0)
    return CL.clean_reviews(raw).select(*fx.clean.columns)


@query
def user_index(fx):
    return fx.user_index


@query
def item_index(fx):
    return fx.item_index


@query
def ratings(fx):
    return R.build_ratings(fx.clean, fx.user_index, fx.item_index)


@query
def item_documents(fx):
    return rounded(fx.docs)


@query
def item_document_chunks(fx):
    """The chunks of every item's document: joined by their places, and whether each begins
    where the one before it ends."""
    return (D.joined_chunks(D.item_document_chunks(fx.clean, chunk_chars=1000))
            .select("asin", "combinedText", "gapless", (F.col("longest") <= 1001).alias("bounded")))


@query
def item_text_stats(fx):
    return rounded(fx.item_stats)


@query
def part_tokens(fx):
    """Every review's stop-word-free tokens, and how many empty ones end it."""
    toks = EM.part_tokens(D.item_text_parts(fx.clean))
    return toks.select("asin", "unixReviewTime", "reviewerID", "partKey", "nTokens", "endEmpties",
                       "tokensText")


@query
def cooccurrences(fx):
    """Word pairs at most two places apart in a review's tokens, at least 50 times."""
    toks = EM.part_tokens(D.item_text_parts(fx.clean))
    return pair_counts(toks, window=2, min_pairs=50, tokens="tokensText")


@query
def embeddable_items(fx):
    toks = EM.part_tokens(D.item_text_parts(fx.clean))
    return rounded(EM.embeddable_items(EM.item_token_stats(toks)))


@query
def embeddable_parts(fx):
    """The sentences Word2Vec is trained on."""
    toks = EM.part_tokens(D.item_text_parts(fx.clean))
    items = EM.embeddable_items(EM.item_token_stats(toks))
    return EM.embeddable_parts(toks, items).select("asin", "partKey", "nTokens")


@query
def index_extension(fx):
    """Item ids extended: keys of valid reviews by odd items keep ids given to even ones."""
    even = fx.clean.filter(F.substring("asin", -1, 1).isin("0", "2", "4", "6", "8"))
    return IX.extend_index(IX.build_index(even, "asin", "itemIndex"), fx.clean, "asin", "itemIndex")


@query
def split_by_time(fx):
    """Active ratings split at the 0.8 quantile of time: rows of each side and its bounds."""
    active = R.active_ratings(fx.ratings, extra=["timestamp"])
    train, test = A.split_ratings(active, by="time")
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test"))).groupBy("split").agg(
                F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("lo"),
                F.max("timestamp").alias("hi")))


@query
def item_tokens(fx):
    toks = D.item_tokens(fx.docs)
    return toks.select("asin", F.size("rawTokens").cast("long").alias("tokenCount"),
                       F.array_join("rawTokens", " ").alias("tokensText"))


@query
def item_tokens_nostop(fx):
    docs = (fx.docs.filter(F.col("reviewCount") >= 5)
            .filter(F.length("combinedText") > 50))
    toks = D.stop_words_remover("rawTokens", "tokens").transform(D.item_tokens(docs))
    toks = toks.filter(F.size("tokens") > 3)
    return toks.select("asin", F.size("tokens").cast("long").alias("tokenCount"),
                       F.array_join("tokens", " ").alias("tokensText"))


@query
def active_ratings_bucketed(fx):
    """``active_ratings`` from ratings written in buckets of the user: no shuffle to read them."""
    name = f"ratings_{uuid.uuid4().hex}"
    table = write_bucketed(fx.ratings, name, scratch_path(fx.spark, name), "userId", 8)
    return R.active_ratings(table, colocated=True)


@query
def user_activity(fx):
    return fx.activity


@query
def item_popularity(fx):
    return fx.popularity


@query
def active_ratings(fx):
    return R.active_ratings(fx.ratings)


@query
def dataset_counts(fx):
    return RP.dataset_counts(fx.activity, fx.popularity)


@query
def parquet_roundtrip(fx):
    path = scratch_path(fx.spark, f"ratings-{uuid.uuid4().hex}")
    write_table(fx.ratings, path, files=4, sort_by=["userId", "itemId"])
    return read_table(fx.spark, path)


# ------------------------------------------------------------ vectors

@query
def embedding_norm(fx):
    return rounded(fx.items.select("itemId", l2_norm("embedding").alias("norm")))


def _rated_with_profile(fx):
    rated = (fx.ratings.select("userId", "itemId").join(fx.cold_users, "userId", "left_semi")
             .join(fx.items.select("itemId", "embedding"), "itemId"))
    return rated.join(fx.profiles, "userId")


@query
def embedding_cosine(fx):
    p = _rated_with_profile(fx)
    return rounded(p.select("userId", "itemId", cosine("profile", "embedding").alias("cosine")))


@query
def embedding_dot(fx):
    p = _rated_with_profile(fx)
    return rounded(p.select("userId", "itemId", dot("profile", "embedding").alias("dot")))


@query
def nearest_vectors(fx):
    """The ten nearest vectors, by cosine, of every vector whose id is divisible by 100."""
    v = fx.view("embeddings").select(F.col("vec_id").cast("long").alias("id"),
                                     F.col("embedding").alias("vector"))
    return nearest(v, v.filter(F.col("id") % 100 == 0), 10, "id", "vector", digits=DIGITS)


@query
def user_profiles(fx):
    return rounded(fx.profiles.select("userId", F.posexplode("profile").alias("pos", "value"))
                   .withColumn("pos", F.col("pos").cast("long")))


# ------------------------------------------------------------ ranker inputs

def _features(fx):
    return FE.candidate_features(FE.candidate_minmax(fx.view("candidates")), fx.items,
                                 fx.activity, fx.popularity)


def _labeled(fx):
    return FE.label_candidates(_features(fx), fx.ratings, fx.warm_users)


@query
def candidate_minmax(fx):
    return rounded(FE.candidate_minmax(fx.view("candidates")))


@query
def candidate_features(fx):
    return rounded(_features(fx))


@query
def label_candidates(fx):
    return rounded(_labeled(fx))


@query
def positive_rate(fx):
    return rounded(FE.label_counts(_labeled(fx)))


@query
def auc_exact(fx):
    """Exact areas of a stand-in score (the rounded ALS score, so with many ties)."""
    scored = _labeled(fx).select(F.round("alsScore", 2).alias("score"), "label")
    return rounded(ranking_metrics(scored))


@query
def balanced_training_set(fx):
    return rounded(FE.balanced_training_set(_labeled(fx)))


@query
def accuracy_report(fx):
    pred = _labeled(fx).withColumn(
        "prediction", F.when(F.col("alsScore") >= 0.5, F.lit(1.0)).otherwise(F.lit(0.0)))
    return rounded(RP.accuracy_report(pred))


@query
def rmse_report(fx):
    return rounded(RP.rmse_report(fx.view("predictions")))


# ------------------------------------------------------------ sampling and segments

@query
def sample_users(fx):
    n = fx.ratings.select("userId").distinct().count() // SAMPLE_SHARE
    return S.sample_keys(fx.ratings, "userId", n)


@query
def segment_users(fx):
    return fx.segments


@query
def segment_users_sampled(fx):
    """Segments of a repeatable tenth of the users."""
    n = fx.ratings.select("userId").distinct().count() // SAMPLE_SHARE
    return REC.segment_users(fx.ratings, n, activity=fx.activity)


@query
def train_test_split(fx):
    train, test = S.split_by_hash(R.active_ratings(fx.ratings), "userId")
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test"))))


# ------------------------------------------------------------ recommendation paths

@query
def recommend_cold(fx):
    return rounded(REC.recommend_cold(fx.profiles_seen, fx.pool, digits=DIGITS))


@query
def candidate_pool(fx):
    return rounded(fx.pool.drop("embedding"))


def _no_profile(fx):
    return REC.users_without_profile(fx.cold_users, fx.profiles)


def _top(fx):
    return REC.popularity_top(fx.popularity, fx.items, digits=DIGITS)


def _unreached(fx):
    """Cold users without a profile or with every pool item seen."""
    reachable = fx.profiles_seen.filter(F.size("seen") < len(REC.pool_ids(fx.pool)))
    return REC.users_without_profile(fx.cold_users, reachable)


def _fallback(fx):
    return REC.recommend_fallback(_no_profile(fx), _top(fx))


@query
def users_without_profile(fx):
    return _no_profile(fx)


@query
def recommend_fallback(fx):
    return rounded(_fallback(fx))


@query
def recommend_ties(fx):
    scored = fx.ratings.select("userId", "itemId", F.col("rating").cast("double").alias("score"))
    return REC.rank_within_user(scored, score="score", ties=True)


def _warm_standin(fx):
    mm = FE.candidate_minmax(fx.view("candidates"))
    c = fx.view("candidates").join(mm, ["userId", "itemId"])
    scored = c.select("userId", "itemId", F.col("alsRawScore").alias("hybridScore"), "alsScore",
                      F.lit(0.0).alias("w2vScore"), F.lit(REC.SOURCE_WARM).alias("source"))
    return REC.rank_within_user(scored)


@query
def combine_paths(fx):
    cold = REC.recommend_cold(fx.profiles_seen, fx.pool, digits=DIGITS)
    return rounded(REC.combine(_warm_standin(fx), cold, _fallback(fx)))


@query
def users_without_recs(fx):
    """Users in no path's result, of all rated users (none is expected)."""
    recs = REC.combine(_warm_standin(fx), REC.recommend_cold(fx.profiles_seen, fx.pool, digits=DIGITS),
                       REC.recommend_fallback(_unreached(fx), _top(fx)))
    lost = fx.activity.join(recs.select("userId").distinct(), "userId", "left_anti")
    return RP._fold(fx.activity.agg(F.count(F.lit(1)).alias("users")),
                    lost.agg(F.count(F.lit(1)).alias("without")))


# ------------------------------------------------------------ reports

@query
def source_breakdown(fx):
    return RP.source_breakdown(fx.view("recs"))


@query
def coverage_report(fx):
    """Totals and coverage over all users."""
    return rounded(RP.coverage_report(fx.view("recs"), fx.cold_users.unionByName(fx.warm_users),
                                      fx.ratings))


@query
def personalization(fx):
    return rounded(RP.personalization(fx.view("recs")))


@query
def rec_preview(fx):
    return rounded(RP.rec_preview(fx.view("recs")))


@query
def dataset_stats(fx):
    return rounded(RP.dataset_stats(fx.activity, fx.popularity, fx.view("recs")))


@query
def segment_share(fx):
    return rounded(RP.segment_share(fx.activity))


@query
def enrich_recs(fx):
    return rounded(RP.enrich_recs(fx.view("recs"), fx.item_index, fx.item_stats))


@query
def enrich_recs_no_meta(fx):
    return rounded(RP.enrich_recs(fx.view("recs"), fx.item_index, None))


@query
def lookup_recs(fx):
    """Requests: every customer id as a user id, n = custkey % 12 (0 and 11 get clamped)."""
    req = fx.view("customer").select(F.col("c_custkey").cast("int").alias("userId"),
                                     (F.col("c_custkey") % 12).cast("int").alias("n"))
    out = RP.lookup_recs(req, fx.view("recs"), fx.activity, fx.item_index, fx.item_stats)
    # integer columns that are null for not-found rows are compared as doubles
    return rounded(out.select(*[F.col(c).cast("double").alias(c)
                                if c in ("ratingCount", "rank", "itemId", "reviewCount") else c
                                for c in out.columns]))


@query
def lookup_served(fx):
    """``lookup_recs`` from recommendations stored in buckets: the files of the requested users."""
    path = scratch_path(fx.spark, f"serving-{uuid.uuid4().hex}")
    write_serving(fx.view("recs"), path, buckets=32)
    req = fx.view("customer").select(F.col("c_custkey").cast("int").alias("userId"),
                                     (F.col("c_custkey") % 12).cast("int").alias("n"))
    out = RP.lookup_recs(req, read_serving(fx.spark, path, req, buckets=32), fx.activity,
                         fx.item_index, fx.item_stats)
    return rounded(out.select(*[F.col(c).cast("double").alias(c)
                                if c in ("ratingCount", "rank", "itemId", "reviewCount") else c
                                for c in out.columns]))


@query
def sample_users_by_segment(fx):
    return RP.sample_users_by_segment(fx.view("recs"), fx.activity)


# ------------------------------------------------------------ fitted models

def _fitted(fx):
    from rankloom.plans.models import fitted
    return fitted(fx)


# What a fit determines - keys, row counts, vocabularies, bounds - is compared with the oracle;
# the fitted numbers themselves are tested for their properties (tests/test_models.py).

def _per(df, key, n="n"):
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(n))


def _finite(col):
    return F.col(col).isNotNull() & ~F.isnan(col) & (F.abs(col) < float("inf"))


@query
def als_predictions(fx):
    m = _fitted(fx)
    return A.predict(m.als, m.als_test).select("userId", "itemId", "rating",
                                               _finite("prediction").alias("finite"))


@query
def als_user_topk(fx):
    return _per(A.user_topk(_fitted(fx).als), "userId")


@query
def als_item_topk(fx):
    return _per(A.item_topk(_fitted(fx).als), "itemId")


@query
def als_candidates(fx):
    m = _fitted(fx)
    return _per(A.candidates_for(m.als, m.ranker_users, 50), "userId")


@query
def als_hot_items(fx):
    """Salted half-steps on all ratings: whether every item's factors solve its least squares."""
    ratings = fx.ratings.select("userId", "itemId", "rating")
    model = SA.train_als_salted(ratings, rank=8, max_iter=3, rows_per_part=20)
    return SA.residuals(ratings, model).select("itemId", (F.col("residual") < 1e-8).alias("solved"))


@query
def als_item_factors(fx):
    return A.item_factors(_fitted(fx).als).select(
        "itemId", F.size("alsEmbedding").cast("long").alias("rank"))


@query
def w2v_item_embeddings(fx):
    return rounded(_fitted(fx).items.select(
        "itemId", "itemAvgRating", "itemReviewCount",
        F.size("embedding").cast("long").alias("dim"),
        F.forall("embedding", lambda x: ~F.isnan(x)).alias("finite")))


@query
def w2v_synonyms(fx):
    """Synonyms of words of the vocabulary: how many each probe word gets."""
    return _per(EM.synonyms(_fitted(fx).w2v), "query")


@query
def fit_or_load(fx):
    """A saved Word2Vec model is loaded, not refit: its words and their dimension."""
    from pyspark.ml.functions import vector_to_array
    m = _fitted(fx)
    path = scratch_path(fx.spark, f"w2v-reuse-{uuid.uuid4().hex}")
    m.w2v.write().overwrite().save(path)
    loaded = EM.word2vec_fit_or_load(path, m.sentences, mode="reuse")
    return loaded.getVectors().select("word", F.size(vector_to_array("vector")).cast("long").alias("dim"))


def _gbt(fx):
    from rankloom.operators import ranker as RK
    m = _fitted(fx)
    return RK.evaluate(m.ranker, m.training.filter(F.col("split") == "test"))


@query
def gbt_report(fx):
    unit = [F.col(c).between(0.0, 1.0).alias(c) for c in ("aucROC", "aucPR", "accuracy")]
    return _gbt(fx).select((F.col("n") > 0).alias("tested"), *unit)


@query
def gbt_importances(fx):
    from rankloom.operators import ranker as RK
    return RK.importances(_fitted(fx).ranker).select(
        "feature", F.col("importance").between(0.0, 1.0).alias("valid"))


@query
def recommend_warm(fx):
    """The personalised path alone: rows and last rank of every user it serves."""
    m = _fitted(fx)
    warm = REC.segment_users(m.ratings, activity=m.activity).filter("segment = 'warm'")
    recs = REC.recommend_warm(m.als, m.ranker, warm.select("userId"), m.items, m.activity,
                              m.popularity)
    return recs.groupBy("userId").agg(F.count(F.lit(1)).alias("n"),
                                      F.max("rank").cast("long").alias("lastRank"))


@query
def recommend_all(fx):
    """The full run, written once; every rated user is served, with ranks from 1 on."""
    from rankloom.plans.recommend import generate, release
    m = _fitted(fx)
    out = generate(m.ratings, m.items, m.als, m.ranker)
    path = scratch_path(fx.spark, f"recommendations-{uuid.uuid4().hex}")
    write_table(out["recs"], path)
    release(out)
    return read_table(fx.spark, path).groupBy("userId").agg(
        F.countDistinct("source").alias("sources"),
        (F.max("rank") == F.count(F.lit(1))).alias("ranked"))


@query
def model_report(fx):
    """RMSE (with its quality band), ranker metrics and feature importances, from the models."""
    from rankloom.operators import ranker as RK
    m = _fitted(fx)
    rmse = RP.rmse_report(A.predict(m.als, m.als_test)).withColumnRenamed("n", "nRated")
    imp = RK.importances(m.ranker).agg(
        F.concat_ws(",", F.array_sort(F.collect_list("feature"))).alias("features"),
        F.round(F.sum("importance"), 6).alias("importance"))
    return RP._fold(rmse.select("nRated", _finite("rmse").alias("rmse")),
                    _gbt(fx).select(F.col("aucROC").between(0.0, 1.0).alias("aucROC")), imp)


# ------------------------------------------------------------ streaming

@query
def lookup_stream(fx):
    """The ``lookup_recs`` requests written as files and answered by a stream."""
    from rankloom.streaming import run_lookup_stream
    base = scratch_path(fx.spark, f"lookup-stream-{uuid.uuid4().hex}")
    req = fx.view("customer").select(F.col("c_custkey").cast("int").alias("userId"),
                                     (F.col("c_custkey") % 12).cast("int").alias("n"))
    req.repartition(4).write.parquet(f"{base}/requests")
    out = run_lookup_stream(fx.spark, f"{base}/requests", f"{base}/answers", f"{base}/checkpoint",
                            fx.view("recs"), fx.activity, fx.item_index, fx.item_stats)
    return rounded(out.select(*[F.col(c).cast("double").alias(c)
                                if c in ("ratingCount", "rank", "itemId", "reviewCount") else c
                                for c in out.columns]))


@query
def path_coverage(fx):
    """Users served by the personalised path among the cold users."""
    return RP.path_coverage(fx.view("recs"), fx.cold_users, REC.SOURCE_COLD)
