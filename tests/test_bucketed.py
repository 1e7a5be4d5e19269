"""Bucketed ratings: counted and joined without a shuffle, with the same rows."""

import uuid

import pytest

from rankloom.operators import features as FE
from rankloom.operators import ratings as R
from rankloom.plans.fixture import Fixture
from rankloom.session import scratch_path
from rankloom.sources import register_bucketed, write_bucketed
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def tables(spark):
    fx = Fixture(spark, SMALL)
    out = {}
    for key in ("userId", "itemId"):
        name = f"ratings_by_{key}_{uuid.uuid4().hex}"
        out[key] = (name, scratch_path(spark, name))
        write_bucketed(fx.ratings, *out[key], key, 6)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield fx, out
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_ratings_are_not_exchanged(spark, tables):
    fx, names = tables
    by_user, by_item = (spark.table(names[k][0]) for k in ("userId", "itemId"))
    active = R.active_ratings(by_user, colocated=True)
    for df in (active, R.user_activity(by_user), R.item_popularity(by_item)):
        assert "Exchange" not in plan(df)
    assert "Exchange" in plan(R.active_ratings(fx.ratings))
    assert rows(active) == rows(R.active_ratings(fx.ratings))
    # candidates are joined with figures of the ratings: only one side of each join moves
    scored = FE.candidate_minmax(fx.view("candidates"))
    feats = FE.candidate_features(scored, fx.items, R.user_activity(by_user), R.item_popularity(by_item))
    plain = FE.candidate_features(scored, fx.items, fx.activity, fx.popularity)
    assert plan(feats).count("Exchange") < plan(plain).count("Exchange")
    assert rows(feats) == rows(plain)


def test_another_applications_table(spark, tables):
    fx, names = tables
    name = f"again_{uuid.uuid4().hex}"
    again = register_bucketed(spark, name, names["userId"][1],
                              "userId INT, itemId INT, rating FLOAT, timestamp BIGINT", "userId", 6)
    assert "Exchange" not in plan(R.user_activity(again))
    assert rows(R.user_activity(again)) == rows(R.user_activity(fx.ratings))
