"""What the ALS queries shuffle: blocks of a large fit, and what is worked out more than once."""

from types import SimpleNamespace

from rankloom.operators import als as A
from rankloom.plans.fixture import Fixture
from rankloom.plans.models import Fitted

from tests.conftest import SMALL


def _blocks(monkeypatch, ratings, cores):
    """The blocks that ``train_als`` asks for."""
    asked = {}
    monkeypatch.setattr(A, "als_estimator", lambda **params: asked.update(params) or SimpleNamespace(
        fit=lambda rows: None))
    context = SimpleNamespace(sparkContext=SimpleNamespace(defaultParallelism=cores))
    train = SimpleNamespace(count=lambda: ratings, sparkSession=context, select=lambda *c: None)
    A.train_als(train)
    return asked["blocks"]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_blocks_of_a_fit_do_not_grow_with_the_ratings(monkeypatch):
    """Ten times the ratings on the same cores: no more copies of a factor are shuffled."""
    assert _blocks(monkeypatch, 15_000_000, 12) == _blocks(monkeypatch, 150_000_000, 12) == 12
    # but a block always fits
    assert _blocks(monkeypatch, 2_000_000_000, 12) == 125


def test_reviews_and_active_users_are_worked_out_once(spark):
    fitted = Fitted(Fixture(spark, SMALL))
    assert "l_orderkey" not in _plan(fitted.tables["ratings"])
    for side in fitted._als_split:
        assert "Join" not in _plan(side) and "Aggregate" not in _plan(side)
    both = sorted(tuple(r) for side in fitted._als_split for r in side.collect())
    assert both == sorted(tuple(r) for r in A.active_ratings(fitted.ratings).collect())
