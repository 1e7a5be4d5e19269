"""Attaching a small table of proven size to every row, without a join.

A candidate pool (top-k items) or a global top-10 list is the same for every
user.  A join against it would multiply rows (users × pool) and then need a
shuffle to rank them.  Instead the table is fetched once (its row count is
checked against ``max_rows``), folded into one array literal, and every user
row scores the whole array with higher-order functions: no row explosion, no
shuffle, and the literal travels with the task binary (broadcast once per
executor).
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def _json_value(v):
    if isinstance(v, float) and (math.isnan(v) or math.isinf(v)):
        raise ValueError("non-finite value in a bounded table")
    if isinstance(v, (list, tuple)):
        return [_json_value(x) for x in v]
    return v


def bounded_array(df: DataFrame, max_rows: int, what: str = "table",
                  key: str | None = None) -> tuple[Column, list]:
    """``df`` (at most ``max_rows`` rows, else ValueError) as an array<struct> literal,
    plus the values of column ``key`` (empty list without a key) from the same fetch."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows; refusing to attach it")
    payload = json.dumps([{k: _json_value(v) for k, v in r.asDict().items()} for r in rows])
    keys = [r[key] for r in rows] if key else []
    return F.from_json(F.lit(payload), ArrayType(df.schema)), keys


def bounded_ids(df: DataFrame, col: str, max_rows: int | None = None, what: str = "table") -> list:
    """The values of ``col`` of a table bounded by an ordered limit (checked if
    ``max_rows`` is given)."""
    rows = (df if max_rows is None else df.limit(max_rows + 1)).select(col).collect()
    if max_rows is not None and len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows")
    return [r[0] for r in rows]
