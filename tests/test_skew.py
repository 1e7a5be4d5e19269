"""Hot keys: one user and one item each hold about a third of all ratings."""

import numpy as np
import pandas as pd
import pytest

from rankloom.operators import ratings as R
from rankloom.operators import recommend as REC


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 30_000
    users = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 3000, n))
    items = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 400, n))
    pdf = pd.DataFrame({"userId": users.astype("int32"), "itemId": items.astype("int32"),
                        "rating": rng.integers(1, 6, n).astype("float32")})
    emb = pd.DataFrame({"itemId": np.arange(0, 400, dtype="int32")})
    emb["embedding"] = [list(rng.normal(size=4)) for _ in range(len(emb))]
    return pdf, emb, spark.createDataFrame(pdf).repartition(16), spark.createDataFrame(emb)


def test_active_ratings_under_skew(skewed):
    pdf, _, ratings, _ = skewed
    got = R.active_ratings(ratings).count()
    counts = pdf.groupby("userId").size()
    assert got == int(counts[counts >= 5].sum())


def test_profiles_under_skew(skewed):
    pdf, emb, ratings, emb_df = skewed
    users = ratings.select("userId").distinct()
    got = {r.userId: np.array(r.profile) for r in REC.user_profiles(ratings, users, emb_df).collect()}
    vec = dict(zip(emb["itemId"], emb["embedding"]))
    for u in [0, 1, 2, 17]:
        rows = pdf[pdf.userId == u]
        if rows.empty:
            continue
        w = rows["rating"].astype(float).to_numpy()
        v = np.array([vec[i] for i in rows["itemId"]])
        assert np.allclose(got[u], (v * w[:, None]).sum(0) / w.sum(), atol=1e-9)


def test_cold_path_with_hot_item(skewed):
    pdf, emb, ratings, emb_df = skewed
    counts = pdf.groupby("userId").size()
    cold = ratings.sparkSession.createDataFrame(
        pd.DataFrame({"userId": counts[counts <= 5].index.astype("int32")}))
    items = REC.item_vectors(emb_df)
    pool = REC.candidate_pool(items, R.item_popularity(ratings), k=50)
    prof = REC.user_profiles(ratings, cold, items, track_items=REC.pool_ids(pool))
    recs = REC.recommend_cold(prof, pool).toPandas()
    assert recs.groupby("userId").size().max() <= 10
    seen = set(zip(pdf.userId, pdf.itemId))
    assert not any((u, i) in seen for u, i in zip(recs.userId, recs.itemId))


@pytest.fixture
def splitting(spark):
    """No broadcast joins, and thresholds at which these small tables count as skewed."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_joins(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [x for x in text.splitlines() if "Join" in x]


def test_hot_keys_are_split_in_the_final_plan(skewed, splitting):
    from rankloom.operators import features as FE
    from rankloom.operators.skew import lookup_join, semi_join
    _, _, ratings, emb = skewed
    act, pop = R.user_activity(ratings), R.item_popularity(ratings)
    users = act.filter("userRatingCount >= 5").select("userId")
    items = REC.item_vectors(emb)
    rows = ratings.select("userId", "itemId")
    for df in (R.active_ratings(ratings), semi_join(rows, users, "userId"),
               lookup_join(rows, FE.item_features(items, pop), "itemId")):
        joins = final_joins(df)
        assert any("skew=true" in x for x in joins), joins
    profiles = REC.user_profiles(ratings, users, items)
    assert sum("skew=true" in x for x in final_joins(profiles)) >= 2


def test_heavy_keys_are_not_shuffled(spark):
    from rankloom.operators.skew import heavy_keys, heavy_lookup_join, lookup_join
    rows = spark.range(9000).selectExpr(
        "CAST(CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 997 END AS INT) AS itemId", "id")
    table = spark.range(900).selectExpr("CAST(id AS INT) AS itemId", "id * 2 AS v")
    assert heavy_keys(rows, "itemId", least=1000) == [7]
    assert heavy_keys(rows, "itemId") == []
    for how in ("left", "inner"):
        got = heavy_lookup_join(rows, table, "itemId", how, least=1000)
        want = lookup_join(rows, table, "itemId", how)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in text.lower() and "IN (7)" in text or "= 7" in text


def test_enriched_recommendations_of_heavy_items(spark, monkeypatch):
    from rankloom.operators import report as RP
    from rankloom.operators import skew
    recs = spark.range(6000).selectExpr(
        "CAST(id AS INT) AS userId", "CAST(CASE WHEN id % 2 = 0 THEN 3 ELSE id % 200 END AS INT) AS itemId",
        "0.12345D AS hybridScore", "0.0D AS alsScore", "0.0D AS w2vScore", "'x' AS source", "1 AS rank")
    index = spark.range(100).selectExpr("id AS itemIndex", "concat('A', id) AS asin")
    meta = spark.createDataFrame([(f"A{i}", 4.5, i) for i in range(0, 100, 2)] + [("UNKNOWN_151", 1.0, 9)],
                                 "asin string, avgRating double, reviewCount long")
    plain = sorted(map(str, RP.enrich_recs(recs, index, meta, split_heavy=False).collect()))
    monkeypatch.setattr(RP, "heavy_lookup_join", lambda *a: skew.heavy_lookup_join(*a, least=1000))
    assert sorted(map(str, RP.enrich_recs(recs, index, meta).collect())) == plain
    by_id = {r.itemId: r for r in RP.enrich_recs(recs, index, meta).collect()}
    assert (by_id[151].asin, by_id[151].reviewCount) == ("UNKNOWN_151", 9)
    assert (by_id[153].asin, by_id[153].reviewCount, by_id[3].asin) == ("UNKNOWN_153", 0, "A3")


def test_recs_and_item_numbers_are_computed_once_more_at_most(spark):
    """The count of heavy keys is one pass over the rows; item numbers are aggregated once."""
    from pyspark.sql import functions as F
    from rankloom.operators.report import item_facts
    from rankloom.operators.skew import heavy_keys
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(4000).select((F.col("id") % 3).alias("itemId")).mapInArrow(counted, "itemId long")
    assert sorted(heavy_keys(rows, "itemId", least=100)) == [0, 1, 2] and seen.value == 4000
    meta = spark.createDataFrame([("I1", 4.0, 2), ("UNKNOWN_7", 3.0, 1)], "asin string, avgRating double, "
                                 "reviewCount long").mapInArrow(counted, "asin string, avgRating double, reviewCount long")
    index = spark.createDataFrame([("I1", 1), ("I2", 2)], "asin string, itemIndex long")
    facts = item_facts(index, meta).collect()
    assert seen.value == 4002
    assert {tuple(r) for r in facts} == {(1, "I1", 4.0, 2), (2, "I2", None, None), (7, "UNKNOWN_7", 3.0, 1)}
