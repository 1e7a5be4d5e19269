"""Op 7: the law of movement, slots, and sizes."""

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from rankloom.llm.sharding import assign_shards, base_tree, shard_of


def test_growth_moves_rows_only_into_the_new_shard(spark):
    df = spark.range(20_000).select(
        shard_of(F.col("id"), base_tree()).alias("a"),
        shard_of(F.col("id"), base_tree(extra=1)).alias("b"),
        shard_of(F.col("id"), base_tree(extra=2)).alias("c")).collect()
    assert {r["a"] for r in df} == set(range(24))
    moved = [r for r in df if r["a"] != r["b"]]
    assert {r["b"] for r in moved} == {24} and 500 < len(moved) < 1100
    assert {r["c"] for r in df if r["b"] != r["c"]} == {25}
    sizes = Counter(r["a"] for r in df)
    assert max(sizes.values()) < 1.25 * min(sizes.values())


def test_changed_weight_confines_movement(spark):
    def tree(w):
        return (("r0", (("k0", ((0, 1.0), (1, w))), ("k1", ((2, 1.0),)))), ("r1", (("k0", ((3, 2.0),)),)))

    rows = spark.range(20_000).select(shard_of(F.col("id"), tree(1.0)).alias("a"),
                                      shard_of(F.col("id"), tree(2.0)).alias("b")).collect()
    n = Counter(r["a"] for r in rows)
    assert abs(n[3] / 20_000 - .4) < .02 and abs(n[0] / 20_000 - .2) < .02
    # nothing leaves the subtrees that got heavier but into them
    assert not [r for r in rows if r["a"] in (0, 1) and r["b"] in (2, 3)]
    assert not [r for r in rows if r["a"] == 2 and r["b"] == 3]


def test_tables(awkward, empty):
    rows = assign_shards(awkward, base_tree(), base_tree(extra=1), buckets=3).collect()
    src = awkward.select("doc_id", "text").collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode()))
        for r in src)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert assign_shards(empty, base_tree(), base_tree(extra=1)).count() == 0
