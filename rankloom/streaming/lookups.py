"""Lookup requests as a stream answered from static recommendation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rankloom.operators.report import lookup_recs
from rankloom.sources.serving import read_serving

REQUEST_SCHEMA = T.StructType([T.StructField("userId", T.IntegerType()),
                               T.StructField("n", T.IntegerType())])


def lookup_stream(requests: DataFrame, out_dir: str, checkpoint: str, recs: DataFrame | str,
                  activity: DataFrame, item_index: DataFrame | None = None,
                  item_meta: DataFrame | None = None):
    """Start answering streaming ``requests`` (userId, n): every micro-batch is one batch of
    lookups (see ``report.lookup_recs``), written by the executors to
    ``out_dir/batch=<id>``.  A repeated batch overwrites its own folder, so answers are
    exactly once.  ``recs`` is a table, or the path of one written by ``write_serving``, of which a
    micro-batch then reads only the files of its users.  Returns the running query."""
    if not requests.isStreaming:
        raise ValueError("requests must be a streaming DataFrame")

    def answer(batch: DataFrame, batch_id: int) -> None:
        served = read_serving(batch.sparkSession, recs, batch) if isinstance(recs, str) else recs
        (lookup_recs(batch, served, activity, item_index, item_meta)
         .write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}"))

    return (requests.writeStream.foreachBatch(answer)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_lookup_stream(spark, request_dir: str, out_dir: str, checkpoint: str, recs: DataFrame | str,
                      activity: DataFrame, item_index: DataFrame | None = None,
                      item_meta: DataFrame | None = None) -> DataFrame:
    """Answer every request file present in ``request_dir`` (parquet) and return the answers
    as a batch table.  The folders must be on shared storage."""
    stream = spark.readStream.schema(REQUEST_SCHEMA).parquet(request_dir)
    q = lookup_stream(stream, out_dir, checkpoint, recs, activity, item_index, item_meta)
    q.awaitTermination()
    return spark.read.parquet(out_dir).drop("batch")
