"""Run the stages as separate jobs that hand off parquet tables and saved models.

    python -m rankloom.plans.cli preprocess --reviews PATH --data DIR [--partitions N]
    python -m rankloom.plans.cli als        --data DIR --models DIR
    python -m rankloom.plans.cli embed      --data DIR --models DIR [--mode reuse|retrain]
    python -m rankloom.plans.cli ranker     --data DIR --models DIR
    python -m rankloom.plans.cli recommend  --data DIR --models DIR --out DIR [--sample N]
    python -m rankloom.plans.cli serve      --data DIR --out DIR [--requests PATH]

The session comes from ``spark-submit`` (master, memory, ``spark.checkpoint.dir``).
Each stage prints one JSON line of counts and metrics computed by the cluster.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.operators import als as A
from rankloom.operators import ranker as RK
from rankloom.operators import report as RP
from rankloom.operators.ratings import item_popularity, user_activity
from rankloom.operators.report import rmse_report
from rankloom.plans import preprocess as PP
from rankloom.plans import recommend as RG
from rankloom.plans import train as TR
from rankloom.session import ensure_checkpoint_dir
from rankloom.sources import optional_table, read_reviews, read_table, save_model, write_table


def _emit(d: dict) -> None:
    print(json.dumps(d, default=float))


def run_preprocess(spark, a) -> dict:
    PP.run_preprocess(read_reviews(spark, a.reviews, a.partitions), a.data,
                      joined_docs=a.joined_docs, previous_dir=a.previous)
    r = read_table(spark, f"{a.data}/ratings").agg(
        F.count(F.lit(1)).alias("ratings"), F.countDistinct("userId").alias("users"),
        F.countDistinct("itemId").alias("items")).first()
    return {"stage": "preprocess", **r.asDict()}


def run_als(spark, a) -> dict:
    ratings = read_table(spark, f"{a.data}/ratings")
    st = TR.als_stage(ratings, seed=a.seed)
    save_model(st.model, f"{a.models}/als")
    write_table(st.predictions, f"{a.data}/als_predictions")
    write_table(A.user_topk(st.model), f"{a.data}/als_user_topk")
    rep = rmse_report(read_table(spark, f"{a.data}/als_predictions")).first()
    return {"stage": "als", **rep.asDict()}


def run_embed(spark, a) -> dict:
    parts = read_table(spark, f"{a.data}/item_parts")
    index = read_table(spark, f"{a.data}/item_index")
    _, items = TR.embedding_stage(parts, index, model_path=f"{a.models}/word2vec", mode=a.mode)
    write_table(items, f"{a.data}/item_vectors")
    return {"stage": "embed", "items": read_table(spark, f"{a.data}/item_vectors").count()}


#: the layout of item_vectors; a missing table reads as an empty one (defaults apply)
ITEM_VECTORS = T.StructType([
    T.StructField("itemId", T.IntegerType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("itemAvgRating", T.DoubleType()), T.StructField("itemReviewCount", T.LongType())])


def run_ranker(spark, a) -> dict:
    ratings = read_table(spark, f"{a.data}/ratings")
    items = optional_table(spark, f"{a.data}/item_vectors", ITEM_VECTORS)
    st = TR.ranker_stage(ALSModel.load(f"{a.models}/als"), ratings, items, seed=a.seed)
    save_model(st.model, f"{a.models}/ranker")
    rep = st.report.first().asDict()
    imp = {r.feature: r.importance for r in RK.importances(st.model).collect()}
    return {"stage": "ranker", **rep, "importances": imp}


def run_recommend(spark, a) -> dict:
    ratings = read_table(spark, f"{a.data}/ratings")
    items = optional_table(spark, f"{a.data}/item_vectors", ITEM_VECTORS)
    out = RG.generate(ratings, items, ALSModel.load(f"{a.models}/als"),
                      GBTClassificationModel.load(f"{a.models}/ranker"), seed=a.seed,
                      sample_size=a.sample, route_uncovered=a.route_uncovered,
                      exclude_seen=a.exclude_seen, ties=a.ties)
    write_table(out["recs"], f"{a.out}/recommendations", sort_by=["userId", "rank"])
    RG.release(out)
    recs = read_table(spark, f"{a.out}/recommendations")
    seg = read_table(spark, f"{a.data}/ratings").select("userId").distinct() if a.sample is None \
        else out["segments"].select("userId")
    from rankloom.operators.report import coverage_report, personalization, source_breakdown
    cov = coverage_report(recs, seg, ratings).first().asDict()
    per = personalization(recs).first().asDict()
    src = [r.asDict() for r in source_breakdown(recs).collect()]   # one row per source
    return {"stage": "recommend", **cov, **per, "sources": src}


def run_serve(spark, a) -> dict:
    """Tables the lookups read: enriched recommendations, dataset figures, segment shares,
    and (with --requests, a parquet table of userId[, n]) the answers."""
    ratings = read_table(spark, f"{a.data}/ratings")
    activity, popularity = user_activity(ratings), item_popularity(ratings)
    recs = read_table(spark, f"{a.out}/recommendations")
    index, stats = (read_table(spark, f"{a.data}/{t}") for t in ("item_index", "item_stats"))
    write_table(RP.enrich_recs(recs, index, stats), f"{a.out}/enriched", sort_by=["userId", "rank"])
    write_table(RP.dataset_stats(activity, popularity, recs), f"{a.out}/dataset_stats")
    write_table(RP.segment_share(activity), f"{a.out}/segment_share")
    out = {"stage": "serve", "enriched": read_table(spark, f"{a.out}/enriched").count()}
    if a.requests:
        answers = RP.lookup_recs(read_table(spark, a.requests), recs, activity, index, stats)
        write_table(answers, f"{a.out}/answers")
        out["answers"] = read_table(spark, f"{a.out}/answers").count()
    return out


STAGES = {"preprocess": run_preprocess, "als": run_als, "embed": run_embed,
          "ranker": run_ranker, "recommend": run_recommend, "serve": run_serve}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rankloom")
    p.add_argument("stage", choices=sorted(STAGES))
    p.add_argument("--reviews", help="raw review JSON lines (plain or .gz)")
    p.add_argument("--data", help="folder of stage tables")
    p.add_argument("--models", help="folder of saved models")
    p.add_argument("--out", help="folder for recommendations")
    p.add_argument("--requests", help="parquet table of lookups (userId[, n]) for serve")
    p.add_argument("--partitions", type=int, default=None)
    p.add_argument("--sample", type=int, default=None,
                   help="recommend for this many users only (default: every user)")
    p.add_argument("--exclude-seen", action="store_true",
                   help="drop items a warm user rated already")
    p.add_argument("--ties", action="store_true", help="plain rank(): ties may exceed k")
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--mode", choices=["reuse", "retrain"], default="retrain")
    p.add_argument("--joined-docs", action="store_true")
    p.add_argument("--previous", help="earlier --data folder whose id indexes are extended")
    p.add_argument("--no-route-uncovered", dest="route_uncovered", action="store_false",
                   help="leave warm users unknown to ALS without recommendations")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"rankloom-{a.stage}").getOrCreate()
    ensure_checkpoint_dir(spark)
    result = STAGES[a.stage](spark, a)
    _emit(result)
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
