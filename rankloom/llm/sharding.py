"""Hierarchical weighted hash tree: documents to shards by weighted draws per level.

A tree is a nested tuple of nodes ``(name, children)``; a leaf is ``(shard, weight)``.
At every level each child draws ``ln(u) / weight`` with ``u`` hashed from the document's
id and the child's path; the largest draw wins.  A child's draw depends on nothing but
its own path and weight, so a changed weight moves rows only into or out of the subtrees
on the path of that change.  A new shard put in as a subtree of its own at the top
therefore takes rows only into itself, and no other row moves.

Everything is native column expressions; the rows of a shard are never gathered in one
task: slots come from counts per (shard, bucket) and a running number inside a bucket.

Defined results: a null ``doc_id`` hashes as null (all such rows in one shard); a null text
has size 8 and CRC 0; equal rows get slots of their own, next to each other; an empty table
gives no rows; further columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_BYTES = 8           # size of a row besides its text, by contract
BASE_LAYOUT = (2, 3, 4)  # regions, racks in a region, shards in a rack: 24 shards


def base_tree(layout: tuple[int, int, int] = BASE_LAYOUT, extra: int = 0) -> tuple:
    """Regions of racks of equal shards, then ``extra`` grown shards, each a region of its
    own so that nothing but the new shard receives rows."""
    regions, racks, shards = layout
    tree = tuple(
        (f"region{g}", tuple(
            (f"rack{r}", tuple(((g * racks + r) * shards + s, 1.0) for s in range(shards)))
            for r in range(racks)))
        for g in range(regions))
    n = regions * racks * shards
    return tree + tuple((f"grown{i}", (("rack0", ((n + i, 1.0),)),)) for i in range(extra))


def _is_leaf(node: tuple) -> bool:
    return not isinstance(node[1], tuple)


def weight(node: tuple) -> float:
    return float(node[1]) if _is_leaf(node) else sum(weight(c) for c in node[1])


def _draw(key: Column, path: str, w: float) -> Column:
    """ln(u) / w with u in (0, 1) from 53 bits of the hash of the key and the path."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11)
    return F.log((bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(w)


def shard_of(key: Column, tree: tuple, path: str = "") -> Column:
    """The shard a key falls to: the winner of each level's draw, from the top down."""
    nodes = [n for n in tree if weight(n) > 0]
    paths = [f"{path}/{n[0]}" for n in nodes]
    below = [F.lit(int(n[0])) if _is_leaf(n) else shard_of(key, n[1], p)
             for n, p in zip(nodes, paths)]
    if len(nodes) == 1:
        return below[0]
    draws = [_draw(key, p, weight(n)) for n, p in zip(nodes, paths)]
    best = F.greatest(*draws)
    out = F.when(draws[0] == best, below[0])
    for d, b in zip(draws[1:-1], below[1:-1]):
        out = out.when(d == best, b)
    return out.otherwise(below[-1])


def assign_shards(docs: DataFrame, tree: tuple, grown: tuple, id_col: str = "doc_id",
                  text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per document.

    ``buckets`` spreads each shard's numbering over that many groups; by default as many
    as the session has shuffle partitions.
    """
    b = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.col(text_col)
    rows = (docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(ROW_BYTES)).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
        # equal rows are counted before they are shuffled, so a repeated key costs one row
        .groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("shard", shard_of(F.col("doc_id"), tree).cast("int"))
        .withColumn("grown_shard", shard_of(F.col("doc_id"), grown).cast("int"))
        .withColumn("bucket", F.coalesce(  # never null, so no filter parts the two readers
            F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit("slot")), F.lit(b)).cast("int"),
            F.lit(0))))
    in_bucket = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn(
        "last", F.sum("copies").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)))
    # at most shards x buckets rows: where each bucket's slots begin
    before = Window.partitionBy("shard").orderBy("bucket")
    starts = (rows.groupBy("shard", "bucket").agg(F.sum("copies").alias("n"))
              .withColumn("start", F.sum("n").over(
                  before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
              .drop("n"))
    out = numbered.join(starts, ["shard", "bucket"]).withColumn(
        "slot", F.explode(F.sequence(F.col("start") + F.col("last") - F.col("copies"),
                                     F.col("start") + F.col("last") - 1)))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                      "grown_shard")
