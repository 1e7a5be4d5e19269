"""The five stages as separate runs handing off parquet and saved models."""

import uuid

from rankloom.plans.cli import main
from rankloom.session import scratch_path
from rankloom.sources import testdata as td
from tests.conftest import SMALL


def test_stages_end_to_end(spark):
    base = scratch_path(spark, f"cli-{uuid.uuid4().hex}")
    td.view(spark, SMALL, "reviews").write.json(f"{base}/raw")
    pre = main(["preprocess", "--reviews", f"{base}/raw", "--data", f"{base}/data"], spark)
    clean = spark.read.json(f"{base}/raw").filter(
        "reviewerID IS NOT NULL AND asin IS NOT NULL AND overall BETWEEN 1 AND 5")
    users = clean.select("reviewerID").distinct().count()
    assert pre["ratings"] == clean.count() and pre["users"] == users
    als = main(["als", "--data", f"{base}/data", "--models", f"{base}/models"], spark)
    assert als["n"] > 0 and als["rmse"] > 0
    emb = main(["embed", "--data", f"{base}/data", "--models", f"{base}/models"], spark)
    assert emb["items"] > 0
    rk = main(["ranker", "--data", f"{base}/data", "--models", f"{base}/models"], spark)
    assert 0.0 <= rk["aucROC"] <= 1.0 and len(rk["importances"]) == 5
    rec = main(["recommend", "--data", f"{base}/data", "--models", f"{base}/models",
                "--out", f"{base}/out"], spark)
    assert rec["usersWithRecs"] == users and rec["coverageAllPct"] == 100.0
    assert {s["source"] for s in rec["sources"]} <= {"als_gbt", "w2v_personalized", "popularity_fallback"}
    req = spark.createDataFrame([(0, 3), (-1, 5)], "userId int, n int")
    req.write.parquet(f"{base}/requests")
    served = main(["serve", "--data", f"{base}/data", "--out", f"{base}/out",
                   "--requests", f"{base}/requests"], spark)
    assert served["answers"] == 4 and served["enriched"] >= 10 * users * .5
