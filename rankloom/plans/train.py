"""Stages 2-4: ALS, Word2Vec item vectors, GBT ranker."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators import als as A
from rankloom.operators import embed as EM
from rankloom.operators import features as FE
from rankloom.operators import ranker as RK
from rankloom.operators.ratings import WARM_MIN_RATINGS, item_popularity, user_activity
from rankloom.operators.sampling import sample_keys
from rankloom.session import ensure_checkpoint_dir

# Fixed value: candidates per user.
RANKER_CANDIDATES = 50


@dataclass
class AlsStage:
    model: object
    predictions: DataFrame
    rmse: float


def als_stage(ratings: DataFrame, seed: int = 42, **params) -> AlsStage:
    model, _, test = A.fit_active(ratings, seed=seed, **params)
    # evaluated and written by the caller: predicted once, kept in the shared folder
    ensure_checkpoint_dir(ratings.sparkSession)
    preds = A.predict(model, test).checkpoint(eager=True)
    return AlsStage(model, preds, A.rmse(preds))


def embedding_stage(item_parts: DataFrame, item_index: DataFrame, model_path: str | None = None,
                    mode: str = "retrain", **params):
    """Word2Vec fit (or reuse) → item vectors keyed by itemId."""
    toks = EM.part_tokens(item_parts)
    sentences = EM.embeddable_parts(toks, EM.embeddable_items(EM.item_token_stats(toks)))
    model = (EM.word2vec_fit_or_load(model_path, sentences, mode, **params) if model_path
             else EM.train_word2vec(sentences, **params))
    emb = EM.item_embeddings(model, toks)
    items = emb.join(item_index, "asin").select(
        F.col("itemIndex").cast("int").alias("itemId"), "embedding",
        F.col("avgRating").alias("itemAvgRating"), F.col("reviewCount").alias("itemReviewCount"))
    return model, items


@dataclass
class RankerStage:
    model: object
    labeled: DataFrame
    training: DataFrame
    report: DataFrame


def ranker_stage(als_model, ratings: DataFrame, items: DataFrame | None, seed: int = 42,
                 sample_size: int | None = None, n_candidates: int = RANKER_CANDIDATES,
                 **params) -> RankerStage:
    activity, popularity = user_activity(ratings), item_popularity(ratings)
    warm = activity.filter(F.col("userRatingCount") >= WARM_MIN_RATINGS)
    users = sample_keys(warm, "userId", sample_size, seed)
    cands = A.candidates_for(als_model, users, n_candidates)
    feats = FE.candidate_features(FE.candidate_minmax(cands), items, activity, popularity)
    # used twice (label counts, then the sample): cut the lineage once in the shared
    # checkpoint folder instead of running the ALS subset recommendation twice
    ensure_checkpoint_dir(ratings.sparkSession)
    labeled = FE.label_candidates(feats, ratings, users).checkpoint(eager=True)
    training = FE.balanced_training_set(labeled, seed=seed).cache()
    model = RK.train_ranker(training.filter(F.col("split") == "train"), seed=seed, **params)
    report = RK.evaluate(model, training.filter(F.col("split") == "test"))
    return RankerStage(model, labeled, training, report)

