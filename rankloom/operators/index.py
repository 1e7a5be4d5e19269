"""Dense 0-based integer ids for string keys, numbered in key order.

id = global rank of the key, so a rerun (or a recomputed partition) always gives
the same numbering.  No single-partition window and no driver-side label list:

1. distinct keys, range-partitioned and sorted inside each partition;
2. ``monotonically_increasing_id`` = (partition << 33) + position, frozen by a
   reliable checkpoint so ids and partition sizes come from one evaluation;
3. per-partition sizes (one row per partition) → prefix offsets;
4. id = offset(partition) + position, through a broadcast of the offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.session import ensure_checkpoint_dir

_POS_BITS = 33


def build_index(df: DataFrame, key: str, out: str, partitions: int | None = None) -> DataFrame:
    """(key, out long) for every distinct non-null ``key`` of ``df``."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    ranged = (keys.repartitionByRange(n, key).sortWithinPartitions(key)
              .withColumn("_m", F.monotonically_increasing_id()))
    frozen = ranged.checkpoint(eager=True)
    pos_mask = (1 << _POS_BITS) - 1
    located = frozen.select(key, F.shiftright("_m", _POS_BITS).alias("_p"),
                            F.col("_m").bitwiseAND(F.lit(pos_mask)).alias("_i"))
    sizes = located.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_p", (F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_o"))
    offsets = offsets.select("_p", F.coalesce("_o", F.lit(0)).alias("_o"))
    return (located.join(F.broadcast(offsets), "_p")
            .select(key, (F.col("_o") + F.col("_i")).cast("long").alias(out)))


def extend_index(index: DataFrame, df: DataFrame, key: str, out: str) -> DataFrame:
    """Keep existing ids and number unseen keys after the current maximum, in key order."""
    new_keys = df.select(key).filter(F.col(key).isNotNull()).distinct().join(index, key, "left_anti")
    top = index.agg(F.max(out)).first()[0]
    base = 0 if top is None else int(top) + 1
    fresh = build_index(new_keys, key, "_r")
    return index.select(key, out).unionByName(
        fresh.select(key, (F.lit(base) + F.col("_r")).cast("long").alias(out)))
