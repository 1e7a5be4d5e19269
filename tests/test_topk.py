"""Blocked top-k: against plain sorting, in one block, many blocks and rounds of buckets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import als as A
from rankloom.operators import topk as T
from rankloom.plans.fixture import Fixture
from tests.conftest import SMALL


def rows_of(best):
    return list(zip(best.row.tolist(), best.id.tolist(), best.score.tolist(), best.ranks().tolist()))


def brute(q, ids, v, bias, k, weight, ties, digits, without):
    out = []
    for r, x in enumerate(q):
        found = []
        for i, t, b in zip(ids, v, bias):
            if (r, i) not in without:
                s = weight * float(x @ t) + b
                found.append((-(round(s, digits) if digits is not None else s), i))
        found.sort()
        if ties:
            kth = found[min(k, len(found)) - 1][0] if found else 0
            out += [(r, i, -s, 1 + sum(x < s for x, _ in found)) for s, i in found if s <= kth]
        else:
            out += [(r, i, -s, n + 1) for n, (s, i) in enumerate(found[:k])]
    return out


@pytest.mark.parametrize("n,k,ties,digits", [(0, 3, False, None), (2, 5, True, 3), (700, 7, False, 6),
                                             (700, 7, True, 1), (1500, 40, False, 2)])
def test_best_of_equals_sorting(n, k, ties, digits):
    r = np.random.default_rng(n + k)
    v = r.normal(size=(n, 6)) * r.gamma(1.0, size=(n, 1))
    v[n // 2:n // 2 + 3] = 0
    ids, bias = r.permutation(5 * n)[:n], r.normal(size=n) * .2
    q = np.vstack([r.normal(size=(30, 6)), np.zeros((1, 6))])
    out_rows = np.repeat(np.arange(31), 4)
    out_ids = r.choice(np.append(ids, -5), 124)
    t = T.Targets(ids.astype(np.int64), v, bias, {})
    best, scored = T.best_of(q, t, k, .6, ties, digits, (out_rows, out_ids))
    want = brute(q, ids.tolist(), v, bias, k, .6, ties, digits, set(zip(out_rows.tolist(), out_ids.tolist())))
    got = rows_of(best)
    assert [(x[0], x[1], x[3]) for x in got] == [(x[0], x[1], x[3]) for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want])
    assert scored.max(initial=0) <= n


def test_bounds_skip_blocks():
    r = np.random.default_rng(1)
    v = r.normal(size=(20_000, 8)) * (1 / (1 + np.arange(20_000)))[:, None]
    t = T.Targets(np.arange(20_000), v, np.zeros(20_000), {})
    best, scored = T.best_of(r.normal(size=(50, 8)), t, 10)
    assert scored.max() <= 2 * T.BLOCK and len(best.row) == 500


@pytest.fixture(scope="module")
def factors(spark):
    r = np.random.default_rng(8)

    def table(n, scale):
        v = r.normal(size=(n, 5)) * (r.pareto(scale, size=(n, 1)) + .1)
        v[:n // 5] = v[0]                    # equal norms and equal scores
        return spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)],
                                     "id int, vector array<float>").repartition(3)

    return table(90, 3), table(400, 2)


def test_rounds_of_buckets_equal_one_round(factors):
    q, t = factors
    one = T.topk_by_norm(q, t, 8).collect()
    many = T.topk_by_norm(q, t, 8, max_bytes=16 * 7 * 30).collect()
    assert sorted((x["userId"], x["itemId"], x["score"], x["rank"]) for x in one) == sorted(
        (x["userId"], x["itemId"], x["score"], x["rank"]) for x in many)
    assert len(one) == 90 * 8 and max(x["scored"] for x in one) <= 400
    # the bounds save work
    assert sum({x["userId"]: x["scored"] for x in many}.values()) < 90 * 400


def test_empty_sides(factors):
    q, t = factors
    assert T.topk_by_norm(q, t.limit(0), 3).count() == 0
    assert T.topk_by_norm(q.limit(0), t, 3).count() == 0


def test_equal_to_the_models_own_top_k(spark):
    fx = Fixture(spark, SMALL)
    model = A.fit_active(fx.ratings, max_iter=4)[0]

    def scores(df, key):
        return {r[0]: r[1] for r in df.groupBy(key).agg(F.sort_array(F.collect_list("alsRawScore"))).collect()}

    for mine, own, key in (
            (A.user_topk(model, 5), model.recommendForAllUsers(5), "userId"),
            (A.item_topk(model, 5), model.recommendForAllItems(5), "itemId"),
            (A.candidates_for(model, fx.ratings.select("userId").filter("userId % 3 = 0"), 20),
             model.recommendForUserSubset(fx.ratings.select("userId").filter("userId % 3 = 0").distinct(), 20),
             "userId")):
        own = own.select(key, F.inline("recommendations")).withColumn(
            "alsRawScore", F.col("rating").cast("double"))
        a, b = scores(mine, key), scores(own, key)
        assert set(a) == set(b) and len(a) > 50
        assert all(np.allclose(a[x], b[x], atol=1e-5) for x in a)


def test_bound_is_checked(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(6)], "itemId int, v array<double>")
    assert len(T.targets_of(df, "v").ids) == 6
    with pytest.raises(ValueError):
        T.targets_of(df, "v", max_rows=5)
    nan = spark.createDataFrame([(1, [float("nan")])], "itemId int, v array<double>")
    with pytest.raises(ValueError):
        T.targets_of(nan, "v")


@pytest.mark.parametrize("max_bytes", [T.MAX_TARGET_BYTES, 400])
def test_nearest_equals_sorting_cosines(spark, max_bytes):
    r = np.random.default_rng(5)
    v = {f"w{i:03d}": r.normal(size=4) for i in range(150)}
    v["same1"] = v["w000"] * 2
    rows = [(w, x.tolist()) for w, x in v.items()] + [("null", None), ("short", [1.0]), ("zero", [0.0] * 4)]
    df = spark.createDataFrame(rows, "word string, vector array<double>").repartition(4)
    asked = ["w000", "w007", "w100", "w149"]
    got: dict = {}
    for x in T.nearest(df, df.filter(F.col("word").isin(asked)), 6, "word", "vector",
                       max_bytes=max_bytes).orderBy("query", "rank").collect():
        got.setdefault(x["query"], []).append((x["word"], x["similarity"]))
    v |= {"null": np.zeros(4), "short": np.zeros(4), "zero": np.zeros(4)}

    def cos(a, b):
        n = np.linalg.norm(a) * np.linalg.norm(b)
        return float(a @ b / n) if n else 0.0

    for w in asked:
        want = sorted(((cos(v[w], x), y) for y, x in v.items() if y != w), reverse=True)[:6]
        assert [y for y, _ in got[w]] == [y for _, y in want]
        assert np.allclose([s for _, s in got[w]], [s for s, _ in want])
    assert T.nearest(df, df.limit(0), 3, "word", "vector").count() == 0


def test_few_query_partitions_are_spread(spark):
    """Queries that lie in one partition are scored by as many tasks as there are partitions."""
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.normal(size=4)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, vector array<double>").coalesce(1)
    top = T.topk_by_norm(df, df, 3)
    assert top.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    m = np.array([v for _, v in rows])
    want = -np.sort(-(m @ m.T), axis=1)[:, :3]
    got = {}
    for x in top.collect():
        got.setdefault(x["userId"], []).append((x["rank"], x["score"]))
    assert np.allclose([[s for _, s in sorted(got[i])] for i in range(400)], want)


def test_wide_blocks_with_ties_and_bias():
    """Past the first blocks, which are narrow: as brute force, tied scores and bias included."""
    r = np.random.default_rng(5)
    n, k = T.BLOCK * (T.WARM + 2 * T.WIDE), 6
    t = T.Targets(np.arange(n), r.normal(size=(n, 2)), r.integers(0, 3, n).astype(float), {})
    q = r.normal(size=(40, 2))
    for ties in (False, True):
        best, _ = T.best_of(q, t, k, 1.0, ties, 1)
        score = np.round(q @ t.vectors.T + t.bias, 1)
        for i in range(40):
            order = np.lexsort((t.ids, -score[i]))
            want = order[score[i][order] >= score[i][order[k - 1]]] if ties else order[:k]
            assert best.id[best.row == i].tolist() == t.ids[want].tolist()


def test_products_scored_in_single_precision_first_are_exact(monkeypatch):
    """Near ties below single precision, equal vectors, zero and tiny ones: the same best targets, in the same
    order, as all products in double; products too large for single precision are not scored in it."""
    random = np.random.default_rng(8)
    vectors = random.normal(size=(3000, 6))
    vectors[1000:2000] = vectors[:1000] * (1 + random.uniform(-1e-9, 1e-9, (1000, 1)))
    vectors[2000:2500] = vectors[:500]
    vectors[2990:] = 0
    queries = np.concatenate([random.normal(size=(300, 6)), np.zeros((2, 6)), random.normal(size=(3, 6)) * 1e-36])
    used = []
    inner = T._best_products
    monkeypatch.setattr(T, "_best_products", lambda *a: (used.append(1), inner(*a))[1])
    for scale, singles in ((1.0, 1), (1e-30, 1), (1e20, 0)):
        targets = T.Targets(random.permutation(3000).astype(np.int64), vectors * scale, np.zeros(3000), {})
        for k in (1, 7, 400):
            used.clear()
            best, scored = T.best_of(queries, targets, k)
            assert len(used) == singles and (scored <= 3000).all()
            exact = np.einsum("qd,td->qt", queries, targets.vectors)
            for row in range(0, len(queries), 7):
                # each product added up in the same order as the kernel does
                own = np.einsum("ij,ij->i", np.broadcast_to(queries[row], targets.vectors.shape), targets.vectors)
                assert np.allclose(own, exact[row], rtol=1e-9, atol=abs(own).max() * 1e-12)
                want = targets.ids[np.lexsort((targets.ids, -own))[:k]] if singles else None
                mine = best.id[best.row == row]
                assert len(mine) == k and (want is None or mine.tolist() == want.tolist())
