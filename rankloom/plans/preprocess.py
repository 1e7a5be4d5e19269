"""Stage 1: raw reviews → clean reviews, id indexes, ratings, item text."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rankloom.operators.clean import clean_reviews
from rankloom.operators.docs import item_documents, item_text_parts, item_text_stats
from rankloom.operators.index import build_index, extend_index
from rankloom.operators.ratings import build_ratings
from rankloom.sources.tables import kept, write_table


def preprocess(raw: DataFrame, previous_users: DataFrame | None = None,
               previous_items: DataFrame | None = None,
               keep_keys: bool = False) -> dict[str, DataFrame]:
    """Lazy tables of stage 1.  The indexes are checkpointed once (ids must not
    change between the tables that use them).  With ``previous_*`` indexes, known
    keys keep their ids and new keys are numbered after the current maximum, so
    models trained on earlier ids stay valid.

    ``item_parts`` (one row per review text) is what the embedding stage reads; ``item_stats`` carries the per-item numbers served to
    users.  ``item_docs`` (one concatenated string per item) is available for
    consumers that need the joined text; a very popular item makes it one huge row,
    so the plan writes it only when asked.  ``keep_keys`` writes the columns that indexes and
    ratings read to the checkpoint folder first: for a ``raw`` that is costly to make.
    """
    clean = clean_reviews(raw)
    keys = (kept(clean.select("reviewerID", "asin", "overall", "unixReviewTime"), "review-keys")
            if keep_keys else clean)
    users = (build_index(keys, "reviewerID", "userIndex") if previous_users is None
             else extend_index(previous_users, keys, "reviewerID", "userIndex"))
    items = (build_index(keys, "asin", "itemIndex") if previous_items is None
             else extend_index(previous_items, keys, "asin", "itemIndex"))
    return {
        "clean": clean,
        "user_index": users,
        "item_index": items,
        "ratings": build_ratings(keys, users, items),
        "item_parts": item_text_parts(clean),
        "item_stats": item_text_stats(clean),
        "item_docs": item_documents(clean),
    }


TABLES = ("ratings", "item_parts", "item_stats", "user_index", "item_index")


def write_preprocessed(tables: dict[str, DataFrame], out_dir: str,
                       files: dict[str, int] | None = None, joined_docs: bool = False) -> None:
    """Write the stage-1 tables as parquet folders under ``out_dir``, in as many parts as
    the plans have (AQE sizes them); ``files`` asks for part counts by table."""
    for name in (*TABLES, "item_docs") if joined_docs else TABLES:
        write_table(tables[name], f"{out_dir}/{name}", files=(files or {}).get(name))


def run_preprocess(raw: DataFrame, out_dir: str, files: dict[str, int] | None = None,
                   joined_docs: bool = False, previous_dir: str | None = None) -> dict[str, DataFrame]:
    """Stage 1 as a job: the clean reviews are written once to ``out_dir/clean``
    and every other table is derived from that parquet copy, so the raw scan and
    cleaning run once, and each derived table reads only the columns it needs."""
    write_table(clean_reviews(raw), f"{out_dir}/clean")
    spark = raw.sparkSession
    clean = spark.read.parquet(f"{out_dir}/clean")
    prev_u = prev_i = None
    if previous_dir:
        # materialised before out_dir is overwritten (the folders may be the same)
        prev_u = spark.read.parquet(f"{previous_dir}/user_index").checkpoint(eager=True)
        prev_i = spark.read.parquet(f"{previous_dir}/item_index").checkpoint(eager=True)
    tables = preprocess(clean, prev_u, prev_i)
    write_preprocessed(tables, out_dir, files, joined_docs)
    return tables
