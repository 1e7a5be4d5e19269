"""Properties of the fitted-model operators (no SQL oracle exists for a fit)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import als as A
from rankloom.operators import docs as D
from rankloom.operators import embed as EM
from rankloom.operators import features as FE
from rankloom.operators import ranker as RK
from rankloom.plans.fixture import Fixture
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def fx(spark):
    return Fixture(spark, SMALL)


def test_als_fit_predict_topk(fx):
    ratings = fx.ratings
    model, train, test = A.fit_active(ratings, max_iter=5)
    preds = A.predict(model, train)
    pdf = preds.toPandas()
    assert np.isfinite(pdf["prediction"]).all()
    # fits the training rows better than the global mean does
    global_sd = float(np.sqrt(((pdf["rating"] - pdf["rating"].mean()) ** 2).mean()))
    assert A.rmse(preds) < global_sd
    top = A.user_topk(model, 5).toPandas()
    assert top.groupby("userId").size().max() <= 5
    known = {r.itemId for r in ratings.select("itemId").distinct().collect()}
    assert set(top["itemId"]) <= known
    users = ratings.select("userId").distinct().limit(5)
    cands = A.candidates_for(model, users, 7).toPandas()
    assert cands.groupby("userId").size().max() <= 7


def test_document_vectors_equal_transform_of_joined_text(fx):
    bounds = {"min_reviews": 2, "min_chars": 20}
    toks = EM.part_tokens(D.item_text_parts(fx.clean)).cache()
    sentences = EM.embeddable_parts(toks, EM.embeddable_items(EM.item_token_stats(toks), **bounds))
    model = EM.train_word2vec(sentences, min_count=5, max_iter=1, vector_size=8)
    mine = {r.asin: np.array(r.embedding)
            for r in EM.item_embeddings(model, toks, **bounds).collect()}
    docs = fx.docs.filter((F.length("combinedText") > 20) & (F.col("reviewCount") >= 2))
    tk = D.stop_words_remover("rawTokens", "tokens").transform(D.item_tokens(docs)) \
        .filter(F.size("tokens") > 3)
    ref = {r.asin: r.vector.toArray() for r in model.transform(tk.select("asin", "tokens")).collect()}
    assert set(mine) == set(ref) and len(ref) > 10
    for a, v in ref.items():
        assert np.allclose(mine[a], v, atol=1e-12)


def test_trailing_tokens_of_the_last_part(spark):
    """A document's last part, also one that occurs twice, loses its trailing empty tokens
    once, like the joined text's; null times sort first."""
    rows = [("I1", None, "u0", 5.0, "first part "), ("I1", 7, "u1", 5.0, "end words  "),
            ("I1", 7, "u1", 5.0, "end words  "), ("I2", 1, "u1", 3.0, "xx yy"), ("I2", 2, "u1", 3.0, "zz")]
    parts = spark.createDataFrame(rows, "asin string, unixReviewTime long, reviewerID string, "
                                        "overall double, text string")
    got = {r.asin: (r.docTokens, r.docChars) for r in
           EM.item_token_stats(EM.part_tokens(parts)).collect()}
    joined = "first part  end words   end words  "
    kept = [t for t in joined.rstrip().split(" ")
            if t not in EM.stop_words_remover("a", "b").getStopWords()]
    assert got == {"I1": (len(kept), len(joined)), "I2": (3, 8)}


def test_native_split_equals_tokenizer(fx):
    from pyspark.ml.feature import Tokenizer
    docs = fx.docs
    a = Tokenizer(inputCol="combinedText", outputCol="t").transform(docs).select("asin", "t")
    b = docs.select("asin", D.split_tokens("combinedText").alias("n"))
    joined = a.join(b, "asin").filter(F.col("t") != F.col("n"))
    assert joined.count() == 0
    edge = fx.spark.createDataFrame([("",), ("   ",), (" A b  ",), ("x\ty",)], "s string")
    got = [r.n for r in edge.select(D.split_tokens("s").alias("n")).collect()]
    assert got == [[""], [], ["", "a", "b"], ["x", "y"]]


def test_ranker_learns_planted_signal(spark):
    rows = []
    rng = np.random.default_rng(7)
    for i in range(400):
        label = float(i % 4 == 0)
        rows.append((i, i, label, 3.0 if label else 1.0, float(label + rng.normal(0, 0.3)),
                     float(rng.random()), float(rng.random()), float(rng.random()), 3.0, "train"))
    df = spark.createDataFrame(rows, "userId int, itemId int, label double, classWeight double, "
                               "alsScore double, w2vScore double, logItemPop double, "
                               "logUserActivity double, itemAvgRating double, split string")
    model = RK.train_ranker(df, max_iter=5)
    rep = RK.evaluate(model, df).first()
    assert rep.aucROC > 0.9
    scored = RK.score(model, df).toPandas()
    assert scored["hybridScore"].between(0, 1).all()
    imp = RK.importances(model).toPandas()
    assert imp.iloc[0]["feature"] == "alsScore"
    assert list(imp["importance"]) == sorted(imp["importance"], reverse=True)


def test_balanced_set_keeps_all_positives(fx):
    feats = FE.candidate_features(FE.candidate_minmax(fx.view("candidates")), fx.items,
                                  fx.activity, fx.popularity)
    lab = FE.label_candidates(feats, fx.ratings, fx.warm_users)
    bal = FE.balanced_training_set(lab)
    assert bal.filter("label = 1.0").count() == lab.filter("label = 1.0").count()
    assert set(r.split for r in bal.select("split").distinct().collect()) <= {"train", "test"}


def test_warm_path_bounds_and_exclude_seen(fx):
    from rankloom.operators import recommend as REC
    model, _, _ = A.fit_active(fx.ratings, max_iter=3)
    feats = FE.candidate_features(
        FE.candidate_minmax(A.candidates_for(model, fx.warm_users, 20)), fx.items,
        fx.activity, fx.popularity)
    lab = FE.label_candidates(feats, fx.ratings, fx.warm_users)
    ranker = RK.train_ranker(FE.balanced_training_set(lab), max_iter=3)
    base = REC.recommend_warm(model, ranker, fx.warm_users, fx.items, fx.activity,
                              fx.popularity, n_candidates=20).toPandas()
    assert base.groupby("userId").size().max() <= 10
    assert set(base["source"]) == {"als_gbt"}
    assert base["hybridScore"].between(0, 1).all()
    excl = REC.recommend_warm(model, ranker, fx.warm_users, fx.items, fx.activity,
                              fx.popularity, n_candidates=20, exclude_seen=True,
                              ratings=fx.ratings)
    seen = fx.ratings.select("userId", "itemId")
    assert excl.join(seen, ["userId", "itemId"]).count() == 0


def test_generate_serves_every_user(spark):
    """By default nobody is sampled away, and nobody is left without a row."""
    from rankloom.operators import recommend as REC
    from rankloom.plans import recommend as RG
    fx = Fixture(spark, SMALL)
    model, _, _ = A.fit_active(fx.ratings, max_iter=2)
    feats = FE.candidate_features(
        FE.candidate_minmax(A.candidates_for(model, fx.warm_users, 20)), fx.items,
        fx.activity, fx.popularity)
    ranker = RK.train_ranker(FE.balanced_training_set(
        FE.label_candidates(feats, fx.ratings, fx.warm_users)), max_iter=2)
    users = {r.userId for r in fx.activity.collect()}
    for options in ({}, {"exclude_seen": True, "ties": True}):
        out = RG.generate(fx.ratings, fx.items, model, ranker, **options)
        assert {r.userId for r in out["recs"].select("userId").distinct().collect()} == users
        RG.release(out)
    # no vectors at all: no profile and no pool, everyone cold falls back
    none = REC.item_vectors(fx.view("item_emb").limit(0))
    out = RG.generate(fx.ratings, none, model, ranker)
    assert {r.userId for r in out["recs"].select("userId").distinct().collect()} == users
    RG.release(out)


def test_als_blocks_follow_the_ratings():
    assert A.blocks_for(0, 4) == 10 and A.blocks_for(5_000_000, 64) == 64
    assert A.blocks_for(20_000_000_000, 4000) == 20_000


def test_models_are_reused_by_fingerprint(spark):
    import uuid
    from pyspark.ml.recommendation import ALSModel
    from rankloom.session import scratch_path
    from rankloom.sources.models import fingerprint, fit_or_load, path_exists
    one = spark.createDataFrame([(1, 1, 5.0), (1, 2, 3.0), (2, 1, 1.0)], "userId int, itemId int, rating float")
    more = one.unionByName(one.limit(1))
    assert fingerprint(one) == fingerprint(one.repartition(3)) != fingerprint(more)
    assert fingerprint(one, 5) != fingerprint(one, 6)
    path = scratch_path(spark, f"als-{uuid.uuid4().hex}")
    fits = []

    def fit():
        fits.append(1)
        return A.train_als(one, max_iter=1)

    assert not path_exists(path)
    for _ in range(2):
        fit_or_load(path, fit, ALSModel)
    assert len(fits) == 1
    fit_or_load(path, fit, ALSModel, mode="retrain")
    assert len(fits) == 2


def test_ranker_users_are_all_warm_users(spark):
    """None of more than 200,000 warm users is left out of candidates and training."""
    from rankloom.plans.models import Fitted
    fitted = object.__new__(Fitted)
    counts = F.when(F.col("id") % 100 == 0, 5).otherwise(6).cast("long").alias("userRatingCount")
    fitted.activity = spark.range(210_000).select(F.col("id").cast("int").alias("userId"), counts)
    row = fitted.ranker_users.agg(F.count("userId").alias("n"), F.countDistinct("userId").alias("users"),
                                  F.count_if(F.col("userId") % 100 == 0).alias("cold")).first()
    assert (row.n, row.users, row.cold) == (207_900, 207_900, 0)
