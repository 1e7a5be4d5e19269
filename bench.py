"""Headline timings: prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

Two groups are timed:
* relational queries from the registry, each planned from the parquet tables and
  run to completion with the ``noop`` sink (full execution, no driver collect);
* the pipeline stages as the reference runs them: stage 1 preprocess (tables
  written as parquet), stage 2 ALS (fit, held-out RMSE, top-k written), stage 3 word vectors
  (by co-occurrence, window 2, and the item vectors written), stage 4 GBT ranker (candidates,
  labels, balanced set, 50 trees, evaluation) and stage 5 recommendations (three paths
  written).  Spark ML's Word2Vec is not timed; stages 4-5 use the driver's embedding table
  as item vectors.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from rankloom.operators import als as A  # noqa: E402
from rankloom.operators import cooccur as C  # noqa: E402
from rankloom.operators import docs as D  # noqa: E402
from rankloom.operators import embed as EM  # noqa: E402
from rankloom.plans import preprocess as PP  # noqa: E402
from rankloom.plans import recommend as RG  # noqa: E402
from rankloom.plans import train as TR  # noqa: E402
from rankloom.plans.fixture import Fixture  # noqa: E402
from rankloom.plans.registry import QUERIES  # noqa: E402
from rankloom.session import local_session, scratch_path  # noqa: E402
from rankloom.sources import write_table  # noqa: E402
from rankloom.sources.tables import kept  # noqa: E402

HEADLINE = [
    "clean_reviews", "user_index", "ratings", "item_documents", "item_tokens_nostop",
    "active_ratings", "user_profiles", "recommend_cold", "recommend_fallback",
    "candidate_features", "balanced_training_set", "combine_paths", "coverage_report",
    "dataset_stats", "enrich_recs", "lookup_recs",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(times: dict, name: str, fn) -> object:
    t0 = time.perf_counter()
    out = fn()
    times[name] = round(time.perf_counter() - t0, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus * 2)
    _run(QUERIES["user_activity"](spark, sf_dir))          # JVM warm-up, not timed
    times: dict[str, float] = {}
    for name in HEADLINE:
        _timed(times, name, lambda: _run(QUERIES[name](spark, sf_dir)))

    out = scratch_path(spark, f"bench-{uuid.uuid4().hex}")
    fx = Fixture(spark, sf_dir)

    def stage1():
        PP.run_preprocess(fx.reviews, f"{out}/data")

    def stage2():
        st = TR.als_stage(fx.ratings)
        write_table(st.predictions, f"{out}/als_predictions")
        write_table(A.user_topk(st.model), f"{out}/als_user_topk")
        return st

    def stage3():
        toks = kept(EM.part_tokens(D.item_text_parts(fx.clean)), "bench-tokens")
        items = EM.embeddable_items(EM.item_token_stats(toks))
        parts = EM.embeddable_parts(toks, items)
        vectors = C.train_word_vectors(parts, window=2, min_pairs=5)
        write_table(C.item_vectors(vectors, parts), f"{out}/item_vectors")

    _timed(times, "stage1_preprocess", stage1)
    als = _timed(times, "stage2_als", stage2)
    _timed(times, "stage3_embed", stage3)
    rk = _timed(times, "stage4_ranker", lambda: TR.ranker_stage(als.model, fx.ratings, fx.items))

    def stage5():
        gen = RG.generate(fx.ratings, fx.items, als.model, rk.model)
        write_table(gen["recs"], f"{out}/recommendations", sort_by=["userId", "rank"])
        RG.release(gen)

    _timed(times, "stage5_recommend", stage5)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else None, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
