"""Every registered query with an oracle equals its DuckDB SQL (sf0.001)."""

import math
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql.types import IntegralType

import __spark_entry__ as E
from tests.conftest import SMALL

ORACLE = E.oracle_sql()


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, float):
        return None if math.isnan(v) else ("f", v)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, Counter(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    got = df.toPandas()
    for f in df.schema.fields:      # pandas would make floats of integers with nulls
        if isinstance(f.dataType, IntegralType):
            got[f.name] = got[f.name].astype("Int64")
    want = duck.execute(ORACLE[name]).fetchdf()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(got) == len(want)
    assert gr == wr


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["userId", "itemId", "hybridScore", "alsScore", "w2vScore", "source", "rank"]
    assert df.count() > 0
