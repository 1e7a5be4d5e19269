"""Fixture tables derived from the driver's TPC-H-style parquet tables.

Each view is one SQL text with placeholders, rendered for Spark (``spark.sql``
with DataFrame arguments, no global view names) and for DuckDB (the oracle, where
the same text becomes a CTE).  The views only re-shape the given tables, so their
size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations")

# Engine-specific spellings of the same expression.
# The user of an order: a quarter of the orders stand for a user of their own.
_USER = "(CASE WHEN o_orderkey % 4 = 3 THEN 500000000 + o_orderkey ELSE o_custkey END)"
_SPARK_TOKENS = {
    "user": _USER,
    "epoch": "unix_timestamp(o_orderdate)",
    "darr": "ARRAY<DOUBLE>",
    "k10": "explode(sequence(0, 9))",
}
_DUCK_TOKENS = {
    "user": _USER,
    "epoch": "CAST(epoch(o_orderdate) AS BIGINT)",
    "darr": "DOUBLE[]",
    "k10": "unnest(range(0, 10))",
}

# Fixed fixture definitions: table references are {name} placeholders.
VIEWS: dict[str, str] = {
    # every line is a review; 'A' lines with quantity 1..4 are invalid rows; a quarter of the
    # orders belong to a user of their own (few ratings), returned lines carry long texts
    "reviews": """
SELECT CASE WHEN l_returnflag = 'A' AND l_quantity = 1 THEN NULL
            ELSE concat('U', lpad(CAST({user} AS STRING), 10, '0')) END AS reviewerID,
       CASE WHEN l_returnflag = 'A' AND l_quantity = 2 THEN NULL
            ELSE concat('I', lpad(CAST(l_partkey AS STRING), 8, '0')) END AS asin,
       CASE WHEN l_returnflag = 'A' AND l_quantity = 3 THEN NULL
            WHEN l_returnflag = 'A' AND l_quantity = 4 THEN 0.0
            ELSE CAST(1 + (l_orderkey + l_partkey) % 5 AS DOUBLE) END AS overall,
       l_linestatus = 'F' AS verified,
       CASE WHEN l_linenumber = 7 THEN NULL WHEN l_returnflag = 'R' THEN text
            ELSE concat('order ', CAST(l_orderkey AS STRING), ' part ', CAST(l_partkey AS STRING), ' of size ',
                        CAST(p_size AS STRING), ' ') END AS reviewText,
       CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE p_name END AS summary,
       {epoch} AS unixReviewTime
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
JOIN {documents} ON doc_id = (l_orderkey * 7 + l_linenumber) % (SELECT count(*) FROM {documents})""",
    "ratings": """
SELECT CAST({user} AS INT) AS userId, CAST(l_partkey AS INT) AS itemId,
       CAST(1 + (l_orderkey + l_partkey) % 5 AS FLOAT) AS rating, {epoch} AS timestamp
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    # there are fewer vectors than items, so profile-less users exist
    "item_emb": """
SELECT CAST(vec_id AS INT) AS itemId, CAST(embedding AS {darr}) AS embedding FROM {embeddings}""",
    # 10 stand-in ALS candidates per warm user; userId % 50 = 0 gets flat scores
    "candidates": """
SELECT userId, CAST((CAST(userId AS BIGINT) * 13 + k * 17) % (SELECT count(*) FROM {part}) AS INT) AS itemId,
       CASE WHEN userId % 50 = 0 THEN CAST(1.0 AS DOUBLE)
            ELSE ((CAST(userId AS BIGINT) * 31 + k * 7) % 100) / CAST(10.0 AS DOUBLE) END AS alsRawScore
FROM (SELECT userId, {k10} AS k
      FROM (SELECT userId FROM {ratings} GROUP BY userId HAVING count(*) > 5) w) u""",
    "predictions": """
SELECT userId, itemId, rating, CASE WHEN itemId % 11 = 0 THEN CAST('NaN' AS FLOAT)
       ELSE CAST(1 + itemId % 5 AS FLOAT) END AS prediction FROM {ratings}""",
    # stand-in recommendations of every user; only some cold users by the personalised path
    "recs": """
SELECT userId, itemId, score AS hybridScore, 0.0 * score AS alsScore, 0.0 * score AS w2vScore,
       CASE WHEN userId % 3 = 0 THEN 'als_gbt' WHEN userId % 3 = 1 THEN 'w2v_personalized'
            ELSE 'popularity_fallback' END AS source,
       CAST(rank() OVER (PARTITION BY userId ORDER BY score DESC, itemId) AS INT) AS rank
FROM (SELECT userId, CAST((CAST(userId AS BIGINT) * 13 + k * 17) % (SELECT count(*) FROM {part}) AS INT) AS itemId,
             ((CAST(userId AS BIGINT) * 31 + k * 7) % 100) / CAST(10.0 AS DOUBLE) AS score
      FROM (SELECT userId, {k10} AS k FROM (SELECT DISTINCT userId FROM {ratings}) d) u) c""",
}

VIEW_DEPS: dict[str, tuple[str, ...]] = {
    "reviews": ("lineitem", "orders", "part", "documents"),
    "ratings": ("lineitem", "orders"),
    "item_emb": ("embeddings",),
    "candidates": ("part", "ratings"),
    "predictions": ("ratings",),
    "recs": ("part", "ratings"),
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(lines: DataFrame) -> DataFrame:
    """``lines`` as they are if their scan has a task for every core; else the columns that reviews
    need, dealt by order to a few tasks a core: the joins turn narrow lines into long texts, which
    the few tasks of a small scan would hold alone."""
    cores = lines.sparkSession.sparkContext.defaultParallelism
    if lines.rdd.getNumPartitions() >= cores:
        return lines
    return lines.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
                        "l_linestatus").repartition(3 * cores, "l_orderkey")


def view(spark: SparkSession, sf_dir: str, name: str, _cache: dict | None = None) -> DataFrame:
    """Build fixture view ``name`` (or read a raw table) as a lazy Spark plan."""
    memo = {} if _cache is None else _cache
    if name in memo:
        return memo[name]
    if name in RAW_TABLES:
        df = raw_table(spark, sf_dir, name)
    else:
        args = {dep: view(spark, sf_dir, dep, memo) for dep in VIEW_DEPS[name]}
        if name == "reviews":
            args["lineitem"] = _dealt(args["lineitem"])
        df = spark.sql(VIEWS[name].format(**_SPARK_TOKENS, **{d: "{%s}" % d for d in args}),
                       **args)
    memo[name] = df
    return df


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    memo: dict = {}
    return [view(spark, sf_dir, n, memo) for n in names]


def duck_view(name: str) -> str:
    return VIEWS[name].format(**_DUCK_TOKENS, **{d: d for d in VIEW_DEPS[name]}).strip()


def duck_with(names: list[str] | tuple[str, ...], body: str) -> str:
    """``WITH`` prefix defining the named fixture views (and their dependencies)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in RAW_TABLES or n in order:
            return
        for d in VIEW_DEPS[n]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    # DuckDB 2.0.0 stops with an internal error ("dict-surviving cache") on joined dictionary
    # columns that are read further on; a table of its own ends the dictionaries
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' if n == 'reviews' else ''}({duck_view(n)})"
                      for n in order)
    return f"WITH {ctes}\n{body.strip()}"
