"""The fitted models of the full pipeline over the review fixture.

Models are fitted once per scale and saved under the shared checkpoint root
(``spark.checkpoint.dir``); later queries, in this or another application, load
them through ``fit_or_load``, as the reference reuses a saved Word2Vec model.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators import als as A
from rankloom.operators import embed as EM
from rankloom.operators import features as FE
from rankloom.operators import ranker as RK
from rankloom.operators.ratings import WARM_MIN_RATINGS, item_popularity, user_activity
from rankloom.plans import preprocess as PP
from rankloom.plans.fixture import Fixture
from rankloom.plans.train import RANKER_CANDIDATES
from rankloom.session import shared_path
from rankloom.sources.models import fingerprint, fit_or_load, load_model
from rankloom.sources.tables import kept

MODEL_VERSION = "v5"   # bump when training code changes, so saved models are refit
_MEMO: dict = {}


class Fitted:
    """Tables and models of the full pipeline; each model is fitted (or loaded)
    only when first needed, so a query touching ALS does not wait for Word2Vec."""

    def __init__(self, fx: Fixture):
        self.spark = fx.spark
        self.base = shared_path(fx.spark, f"models-{_tag(fx.sf_dir)}")
        self.tables = PP.preprocess(fx.reviews, keep_keys=True)
        self.ratings = self.tables["ratings"].cache()
        self.activity, self.popularity = user_activity(self.ratings), item_popularity(self.ratings)

    @cached_property
    def _als_split(self):
        # fingerprinted, counted, fitted and tested: the active users are found once
        return A.split_ratings(kept(A.active_ratings(self.ratings), "active-ratings"))

    @property
    def als_test(self) -> DataFrame:
        return self._als_split[1]

    @cached_property
    def als(self) -> ALSModel:
        train = self._als_split[0]
        path = f"{self.base}/als-{self._als_print}"
        fit_or_load(path, lambda: A.train_als(train), ALSModel)
        # the saved factors: those of a fit are recomputed from its shuffles if a task loses them
        return load_model(ALSModel, path)

    @cached_property
    def _als_print(self) -> str:
        return fingerprint(self._als_split[0], MODEL_VERSION)

    @cached_property
    def _w2v_print(self) -> str:
        return fingerprint(self.sentences.select("asin", "partKey", "nTokens"), MODEL_VERSION)

    @cached_property
    def parts(self) -> DataFrame:
        return EM.part_tokens(self.tables["item_parts"])

    @cached_property
    def sentences(self) -> DataFrame:
        items = EM.embeddable_items(EM.item_token_stats(self.parts))
        return EM.embeddable_parts(self.parts, items)

    @cached_property
    def w2v(self):
        return EM.word2vec_fit_or_load(f"{self.base}/word2vec-{self._w2v_print}", self.sentences)

    @cached_property
    def items(self) -> DataFrame:
        return (EM.item_embeddings(self.w2v, self.parts).join(self.tables["item_index"], "asin")
                .select(F.col("itemIndex").cast("int").alias("itemId"), "embedding",
                        F.col("avgRating").alias("itemAvgRating"),
                        F.col("reviewCount").alias("itemReviewCount"))).cache()

    @cached_property
    def ranker_users(self) -> DataFrame:
        """All warm users; written once, as candidates and labels both read them."""
        warm = self.activity.filter(F.col("userRatingCount") >= WARM_MIN_RATINGS)
        return kept(warm.select("userId"), "ranker-users")

    @cached_property
    def training(self) -> DataFrame:
        cands = A.candidates_for(self.als, self.ranker_users, RANKER_CANDIDATES)
        feats = FE.candidate_features(FE.candidate_minmax(cands), self.items, self.activity,
                                      self.popularity)
        labeled = FE.label_candidates(feats, self.ratings, self.ranker_users).checkpoint(eager=True)
        return FE.balanced_training_set(labeled).cache()

    @cached_property
    def ranker(self) -> GBTClassificationModel:
        train = self.training.filter(F.col("split") == "train")
        prints = f"{self._als_print}-{self._w2v_print}"     # all that the training set is made of
        return fit_or_load(f"{self.base}/ranker-{prints}", lambda: RK.train_ranker(train),
                           GBTClassificationModel)


def _tag(sf_dir: str) -> str:
    return hashlib.sha1(sf_dir.encode()).hexdigest()[:12]


def fitted(fx: Fixture) -> Fitted:
    key = (fx.spark.sparkContext.applicationId, fx.sf_dir)
    if key not in _MEMO:
        _MEMO[key] = Fitted(fx)
    return _MEMO[key]
