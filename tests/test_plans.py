"""Physical-plan shape: the scale properties the operators are designed for."""

import pytest

import __spark_entry__ as E
from rankloom.operators import recommend as REC
from rankloom.plans.fixture import Fixture
from tests.conftest import SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def fx(spark):
    return Fixture(spark, SMALL)


@pytest.mark.parametrize("name", ["recommend_cold", "recommend_fallback", "combine_paths",
                                  "lookup_recs", "coverage_report", "dataset_stats"])
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan(E.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_cold_path_has_one_user_aggregation_and_no_shuffle_after(fx):
    df = REC.recommend_cold(fx.profiles_seen, fx.pool)
    p = plan(df)
    top = p.split("ObjectHashAggregate")[0]          # operators above the profile aggregation
    assert "Exchange" not in top and "Window" not in top


def test_profile_sum_is_partially_aggregated(fx):
    p = fx.profiles._jdf.queryExecution().executedPlan().toString()
    # partial (map-side) aggregation below the shuffle, final above it
    assert p.count("ObjectHashAggregate") >= 2 or "SortAggregate" in p


def test_top_k_per_user_uses_window_group_limit(fx, spark):
    df = REC.rank_within_user(fx.ratings.selectExpr("userId", "itemId", "CAST(rating AS DOUBLE) AS hybridScore"))
    df._jdf.queryExecution().executedPlan()
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in p


def test_pool_top_k_carries_no_vectors(fx):
    p = plan(REC.candidate_pool(fx.items, fx.popularity, k=500))
    line = next(x for x in p.splitlines() if "TakeOrderedAndProject" in x)
    assert "limit=500" in line and "embedding" not in line


def test_filters_reach_the_scan(spark):
    p = E.queries()["active_ratings"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_orderkey)" in p and "l_comment" not in p


def test_no_text_in_item_shuffles_of_the_embedding_path(fx):
    from rankloom.operators import docs as D
    from rankloom.operators import embed as EM
    toks = EM.part_tokens(D.item_text_parts(fx.clean))
    for df in (D.item_text_stats(fx.clean), EM.item_token_stats(toks)):
        lines = plan(df).splitlines()
        aggregates = [x for x in lines if "Aggregate" in x and "asin" in x]
        assert aggregates and not [x for x in aggregates if "reviewText" in x or "tokens#" in x]
        from_item_shuffle = False
        for x in reversed(lines):            # below the exchange by item text is still there
            from_item_shuffle |= "Exchange hashpartitioning(asin" in x
            if from_item_shuffle:
                assert "reviewText" not in x


def test_counts_need_no_expand(spark):
    assert "Expand" not in plan(E.queries()["dataset_counts"](spark, SMALL))


def test_lookup_joins_requests_before_enriching(spark):
    from rankloom.operators.report import lookup_recs
    fx = Fixture(spark, SMALL)
    req = fx.view("customer").selectExpr("CAST(c_custkey AS INT) AS userId")
    p = plan(lookup_recs(req, fx.view("recs"), fx.activity, fx.item_index, fx.item_stats))
    assert "LeftSemi" in p and "row_number" not in p


def test_fixed_size_tables_only_are_fetched(fx):
    # the pool fetch is bounded: asking for a smaller bound fails loudly
    with pytest.raises(ValueError):
        REC.pool_ids(fx.pool, max_pool=3)
