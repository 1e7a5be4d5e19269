"""Edge cases from the survey's semantics table, on inline rows."""

import math

import pytest
from pyspark.sql import functions as F

from rankloom.functions.scoring import taste_blend
from rankloom.functions.vectors import cosine, l2_norm
from rankloom.operators import features as FE
from rankloom.operators import recommend as REC
from rankloom.operators import report as RP
from rankloom.operators.clean import clean_reviews
from rankloom.operators.ratings import build_ratings
from rankloom.session import scratch_path
from rankloom.sources import read_reviews
from rankloom.sources.tables import optional_table


def test_bad_json_and_wrong_types_are_dropped(spark):
    path = scratch_path(spark, "edge-json")
    lines = [
        '{"reviewerID": "U1", "asin": "I1", "overall": 5.0, "reviewText": "good"}',
        '{"reviewerID": "U2", "asin": "I1", "overall": "five"}',
        '{broken',
        '{"reviewerID": "U3", "asin": "I2", "overall": 0.0}',
        '{"reviewerID": "U4", "asin": "I2", "overall": 5.5}',
        '{"reviewerID": null, "asin": "I2", "overall": 3.0}',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
    clean = clean_reviews(read_reviews(spark, path))
    assert [r.reviewerID for r in clean.collect()] == ["U1"]
    assert "vote" not in clean.columns and "reviewTime" not in clean.columns


def test_nan_rating_is_rejected(spark):
    df = spark.createDataFrame([("U1", "I1", float("nan")), ("U2", "I1", 4.0)],
                               "reviewerID string, asin string, overall double")
    assert [r.reviewerID for r in clean_reviews(df).collect()] == ["U2"]


def test_flat_scores_scale_to_half(spark):
    c = spark.createDataFrame([(1, 10, 2.0), (1, 11, 2.0), (2, 10, 1.0), (2, 11, 3.0)],
                              "userId int, itemId int, alsRawScore double")
    got = {(r.userId, r.itemId): r.alsScore for r in FE.candidate_minmax(c).collect()}
    assert got == {(1, 10): 0.5, (1, 11): 0.5, (2, 10): 0.0, (2, 11): 1.0}


def test_zero_vector_cosine_is_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0]), ([3.0, 4.0], [3.0, 4.0])],
                               "a array<double>, b array<double>")
    got = [r.c for r in df.select(cosine("a", "b").alias("c")).collect()]
    assert got[0] == 0.0 and math.isclose(got[1], 1.0)
    assert [r.n for r in df.select(l2_norm("a").alias("n")).collect()] == [0.0, 5.0]


def test_ties_default_and_plain_rank(spark):
    rows = [(1, i, 1.0 if i < 12 else 0.5) for i in range(15)]
    df = spark.createDataFrame(rows, "userId int, itemId int, hybridScore double")
    broken = REC.rank_within_user(df).collect()
    assert len(broken) == 10 and sorted(r.itemId for r in broken) == list(range(10))
    plain = REC.rank_within_user(df, ties=True).collect()
    assert len(plain) == 12 and {r["rank"] for r in plain} == {1}


def test_array_top_k_matches_window_ranks(spark):
    """Array scoring equals explicit (user, item) pairs ranked by a window (brute force)."""
    pool = spark.createDataFrame(
        [(i, [1.0, float(i % 3)], 3.0, math.log(11.0)) for i in range(20)],
        "itemId int, embedding array<double>, itemAvgRating double, logItemPop double")
    prof = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])],
                                 "userId int, profile array<double>")
    pairs = prof.join(pool, how="cross").select(  # test-only brute force over 60 pairs
        "userId", "itemId",
        F.round(taste_blend(cosine("profile", "embedding"), "itemAvgRating", "logItemPop"), 6)
        .alias("hybridScore"))
    for ties in (False, True):
        got = {(r.userId, r.itemId, r["rank"]) for r in
               REC.recommend_cold(prof, pool, None, ties=ties, digits=6, max_pool=20).collect()}
        want = {(r.userId, r.itemId, r["rank"]) for r in
                REC.rank_within_user(pairs, ties=ties).collect()}
        assert got == want
    tied = REC.recommend_cold(prof, pool, None, ties=True, max_pool=20).filter("userId = 3").count()
    assert tied == 20   # zero profile: every item scores the same


def test_large_pool_in_blocks(spark):
    """A pool of 5000 items is scored in blocks like one array would be."""
    pool = spark.range(5000).selectExpr(
        "CAST(id AS INT) AS itemId", "array(1.0D + id % 7, 1.0D + id % 11) AS embedding",
        "1.0D + id % 5 AS itemAvgRating", "ln(2.0D + id) AS logItemPop")
    prof = spark.createDataFrame([(1, [1.0, 0.2]), (2, [0.1, 1.0])], "userId int, profile array<double>")
    pairs = prof.join(pool, how="cross").select(
        "userId", "itemId",
        F.round(taste_blend(cosine("profile", "embedding"), "itemAvgRating", "logItemPop"), 6)
        .alias("hybridScore"))
    for ties in (False, True):
        got = {(r.userId, r.itemId, r["rank"]) for r in
               REC.recommend_cold(prof, pool, None, ties=ties, digits=6).collect()}
        assert got == {(r.userId, r.itemId, r["rank"]) for r in
                       REC.rank_within_user(pairs, ties=ties).collect()}
    items = REC.item_vectors(pool.select("itemId", "embedding"))
    pop = pool.selectExpr("itemId", "CAST(10 + itemId AS BIGINT) AS itemRatingCount")
    assert len(REC.pool_ids(REC.candidate_pool(items, pop, k=5000))) == 5000


def test_invalid_vectors_count_as_none(spark):
    emb = spark.createDataFrame([(1, [1.0, float("nan")]), (2, [float("inf"), 0.0]), (3, [None, 1.0]),
                                 (4, [1.0, 2.0]), (5, None)], "itemId int, embedding array<double>")
    items = REC.item_vectors(emb)
    assert {r.itemId for r in items.filter("embedding IS NOT NULL").collect()} == {4}
    pop = emb.selectExpr("itemId", "CAST(50 AS BIGINT) AS itemRatingCount")
    assert REC.pool_ids(REC.candidate_pool(items, pop)) == [4]


def test_fallback_takes_the_best_k_of_a_longer_list(spark):
    top = spark.createDataFrame([(i, float(i), 0.0) for i in range(25)],
                                "itemId int, hybridScore double, w2vScore double")
    users = spark.createDataFrame([(1,)], "userId int")
    got = [(r.itemId, r["rank"]) for r in REC.recommend_fallback(users, top).collect()]
    assert sorted(got, key=lambda x: x[1]) == [(24 - i, i + 1) for i in range(10)]


def test_checkpoint_folder_is_required_off_local():
    from types import SimpleNamespace
    from rankloom.session import ensure_checkpoint_dir
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(
            getCheckpointDir=lambda: None, master=master))
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(cluster)


def test_gzip_files_in_a_folder_are_spread(spark):
    import uuid
    path = scratch_path(spark, f"gz-{uuid.uuid4().hex}")
    spark.createDataFrame([('{"reviewerID": "U1", "asin": "I1", "overall": 5.0}',)], "value string") \
        .coalesce(1).write.option("compression", "gzip").text(path)
    plan = read_reviews(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan


def test_pool_bound_is_checked(spark):
    pool = spark.createDataFrame([(i, [1.0], 3.0, 1.0) for i in range(5)],
                                 "itemId int, embedding array<double>, itemAvgRating double, logItemPop double")
    prof = spark.createDataFrame([(1, [1.0])], "userId int, profile array<double>")
    with pytest.raises(ValueError):
        REC.recommend_cold(prof, pool, None, max_pool=4)


def test_zero_negatives_fraction():
    assert FE.negative_fraction(5, 0) == 1.0
    assert FE.negative_fraction(0, 0) == 1.0
    assert FE.negative_fraction(1, 100) == pytest.approx(0.1)
    assert FE.negative_fraction(50, 100) == 1.0


def test_zero_weight_profile_is_unnormalised(spark):
    r = spark.createDataFrame([(1, 1, 0.0), (1, 2, 0.0), (2, 1, 2.0), (2, 2, 1.0)],
                              "userId int, itemId int, rating float")
    e = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 3.0])], "itemId int, embedding array<double>")
    got = {x.userId: x.profile for x in REC.user_profiles(r, r.select("userId").distinct(), e).collect()}
    assert got[1] == [0.0, 0.0]
    assert got[2] == pytest.approx([2.0 / 3.0, 1.0])


def test_missing_item_table_uses_defaults(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("asin", T.StringType()), T.StructField("avgRating", T.DoubleType()),
                           T.StructField("reviewCount", T.LongType())])
    meta = optional_table(spark, "/nonexistent/path/for/test", schema)
    assert meta.count() == 0
    recs = spark.createDataFrame([(1, 7, 0.9, 0.1, 0.2, "als_gbt", 1)],
                                 "userId int, itemId int, hybridScore double, alsScore double, "
                                 "w2vScore double, source string, rank int")
    out = RP.enrich_recs(recs, None, meta).first()
    assert out.asin == "UNKNOWN_7" and out.avgRating == 0.0 and out.reviewCount == 0
    assert out.amazonUrl.endswith("UNKNOWN_7")


def test_lookup_unknown_user_and_clamped_n(spark):
    recs = spark.createDataFrame([(1, i, 1.0 - i / 100, 0.0, 0.0, "als_gbt", i + 1) for i in range(10)],
                                 "userId int, itemId int, hybridScore double, alsScore double, "
                                 "w2vScore double, source string, rank int")
    act = spark.createDataFrame([(1, 25), (3, 2)], "userId int, userRatingCount long")
    req = spark.createDataFrame([(1, 0), (1, 11), (2, 5), (3, None)], "userId int, n int")
    out = RP.lookup_recs(req, recs, act).collect()
    by = {}
    for r in out:
        by.setdefault((r.userId, r.topN), []).append(r)
    assert len(by[(1, 1)]) == 1 and len(by[(1, 10)]) == 10
    assert by[(1, 1)][0].segment == "power user"
    assert by[(2, 5)][0].found is False and by[(2, 5)][0].userExists is False
    assert by[(3, 10)][0].found is False and by[(3, 10)][0].userExists is True


def test_id_overflow_raises(spark):
    clean = spark.createDataFrame([("U1", "I1", 4.0, 1)], "reviewerID string, asin string, overall double, unixReviewTime long")
    users = spark.createDataFrame([("U1", 2**31)], "reviewerID string, userIndex long")
    items = spark.createDataFrame([("I1", 0)], "asin string, itemIndex long")
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        build_ratings(clean, users, items).collect()


def test_coverage_divides_by_actual_sample(spark):
    recs = spark.createDataFrame([(1, 1, "a", 1), (2, 1, "a", 1)], "userId int, itemId int, source string, rank int")
    sample = spark.createDataFrame([(1,), (2,), (3,), (4,)], "userId int")
    ratings = spark.createDataFrame([(u, 1) for u in range(1, 9)], "userId int, itemId int")
    r = RP.coverage_report(recs, sample, ratings).first()
    assert r.coverageSampledPct == 50.0 and r.coverageAllPct == 25.0


def test_every_line_is_a_review(spark):
    from rankloom.sources.testdata import raw_table, view
    from tests.conftest import SMALL
    assert view(spark, SMALL, "reviews").count() == raw_table(spark, SMALL, "lineitem").count()
