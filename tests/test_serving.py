"""Recommendations in buckets: pruned files, same answers, streamed too."""

import uuid

from rankloom.operators.report import lookup_recs
from rankloom.operators.ratings import user_activity
from rankloom.session import scratch_path
from rankloom.sources import read_serving, write_serving
from rankloom.sources import testdata as td
from rankloom.streaming import run_lookup_stream
from tests.conftest import SMALL
from pyspark.sql import functions as F


def test_small_batches_read_few_files(spark):
    path = scratch_path(spark, f"serving-{uuid.uuid4().hex}")
    recs = td.view(spark, SMALL, "recs")
    write_serving(recs, path, buckets=64)
    users = [r.userId for r in recs.select("userId").distinct().orderBy("userId").limit(3).collect()]
    req = spark.createDataFrame([(u,) for u in users] + [(None,), (-1,)], "userId int")
    got = read_serving(spark, path, req, buckets=64)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "In(userId" in plan
    files = got.select(F.input_file_name().alias("f")).distinct().count()
    everything = spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 4 < everything
    assert sorted(map(str, got.select(*recs.columns).collect())) == sorted(
        map(str, recs.filter(F.col("userId").isin(users)).collect()))
    assert read_serving(spark, path).count() == recs.count()
    assert read_serving(spark, path, req.limit(0), buckets=64).count() == 0


def test_stream_from_stored_recommendations(spark):
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    recs = td.view(spark, SMALL, "recs")
    act = user_activity(td.view(spark, SMALL, "ratings"))
    write_serving(recs, f"{base}/recs")
    req = spark.createDataFrame([(u, u % 12) for u in range(0, 200, 3)], "userId int, n int")
    req.write.parquet(f"{base}/req")
    got = run_lookup_stream(spark, f"{base}/req", f"{base}/out", f"{base}/ckpt", f"{base}/recs", act)
    want = lookup_recs(req, recs, act)
    cols = ["userId", "topN", "found", "rank", "itemId", "source"]
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == \
        sorted(map(tuple, want.select(*cols).collect()), key=str)
