"""N-gram Jaccard join by grouped prefixes, and its components.

A document is the set of its distinct word n-grams.  In a common order of all n-grams,
rarest first, two sets whose Jaccard similarity reaches the threshold share an n-gram
among their first ``n - ceil(t n) + 1`` (the prefix).

1. Document frequencies without moving n-gram rows: documents lie in blocks by hash of their
   key; a block sends its distinct n-gram hashes, packed, to the buckets of the hash range,
   and each bucket answers with one frequency class per hash.  N-grams in one document alone
   (class 0) come first in the order and can be shared with nobody, so they are not joined.
2. Documents with equal sets are one class from here on (its smallest key stands for it).
3. Documents with identical prefixes and size collapse into one group; groups meet in the
   prefix n-grams they share.  Every group is first verified against one pivot per n-gram,
   the group with the fewest class-0 n-grams there, and every member against its own group.
   Links are united.
4. N-grams whose documents then still lie in different components are expanded: all pairs of
   their members that lie apart, as far as sizes and positions allow the threshold, are
   verified, and the links united again.  A link left out in step 3 and 4 joins documents
   that are in one component already.

Pairs inside a hot group are therefore linear in its members (step 3), except those that are
truly apart yet could be similar.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  Defined results: a text with fewer
words than n is one n-gram of all its words; null, empty and wordless texts have the empty
set and link with nothing; equal rows are linked with each other; a null key is not allowed
to stand for others (its rows are judged on their own); an empty table gives no rows;
further columns of the input are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import slices, stash
from rankloom.llm.graph import components
from rankloom.llm.packing import pack, unpack, unzipped, zipped
from rankloom.llm.words import BASE, find_words, mix, shingles

N, PERCENT = 4, 85
BLOCK_BYTES = 16 << 20     # text in one block
SLICE_BYTES = 4 << 20      # text turned into n-grams at once
SPARE_BITS = 12            # hash bits for frequencies beyond those that count the corpus


def shingle_sets(texts: list[bytes], n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct n-grams of each text, sorted by both."""
    docs, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for a, b in slices([len(t) for t in texts], SLICE_BYTES):
        w = find_words(texts[a:b])
        count = np.bincount(w.doc, minlength=b - a)
        h = shingles(w.hash, n)
        whole = w.doc[:len(h)] == w.doc[n - 1:] if len(h) else np.zeros(0, bool)
        docs.append(w.doc[:len(h)][whole] + a)
        hashes.append(h[whole])
        begin = np.cumsum(count) - count
        for k in np.flatnonzero((count > 0) & (count < n)).tolist():
            docs.append(np.array([k + a]))
            words = w.hash[begin[k]:begin[k] + count[k]]
            hashes.append(mix(shingles(words, len(words)) + np.uint64(len(words))))
    doc, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])] if len(h) else np.zeros(0, bool)
    return doc[new], h[new]


def prefix_size(n, percent: int):
    """n-grams of a set of size n among which a similar set shares one."""
    return n - -(-percent * n // 100) + 1


def _digests(docs: DataFrame, key: str, text: str, n: int, percent: int) -> DataFrame:
    """One row per document: key, size, class-0 n-grams, set signature, group key, prefix
    n-grams of class 1 and up with their places, and (only if there are any) the text."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 math.ceil(total / BLOCK_BYTES))
    bits = min(64, SPARE_BITS + max(1, int(total)).bit_length())
    shift = np.uint64(64 - bits)
    kind = docs.schema[key].dataType.simpleString()

    def pack_texts(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(
                    [zipped((t or "").encode()) for t in batch.column(2).to_pylist()],
                    pa.binary())], ["block", "k", "z"])

    packed = docs.select(
        F.coalesce(F.pmod(F.xxhash64(F.col(key), F.crc32(F.col(text).cast("binary"))),
                          F.lit(blocks)).cast("int"), F.lit(0)).alias("block"),
        F.col(key).alias("k"), F.col(text)).mapInArrow(pack_texts, f"block int, k {kind}, z binary")

    def sets(table: pa.Table):
        return shingle_sets([unzipped(z) for z in table.column("z").to_pylist()], n)

    def cut(x: np.ndarray) -> np.ndarray:    # where each bucket begins in sorted hashes
        edges = [(b << bits) // blocks for b in range(blocks)]
        return np.r_[np.searchsorted(x, np.array(edges, np.uint64)), len(x)]

    def ask(table: pa.Table) -> pa.Table:
        _, h = sets(table)
        x, counts = np.unique(h >> shift, return_counts=True)
        at = cut(x)
        some = [b for b in range(blocks) if at[b] < at[b + 1]]
        block = table.column("block")[0].as_py()
        return pa.table({
            "bucket": pa.array(some, pa.int32()),
            "block": pa.array([block] * len(some), pa.int32()),
            "gaps": pa.array([pack(np.diff(x[at[b]:at[b + 1]], prepend=np.uint64(0)))
                              for b in some], pa.binary()),
            "counts": pa.array([pack(counts[at[b]:at[b + 1]].astype(np.uint32))
                                for b in some], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        parts = [np.cumsum(unpack(g, np.uint64)[0]) for g in table.column("gaps").to_pylist()]
        counts = np.concatenate([unpack(c, np.uint32)[0]
                                 for c in table.column("counts").to_pylist()])
        _, place = np.unique(np.concatenate(parts), return_inverse=True)
        df = np.bincount(place, counts)
        level = np.where(df > 1, np.minimum(255, np.floor(8 * np.log2(df)) - 7), 0)
        level = level.astype(np.uint8)[place]
        ends = np.cumsum([len(p) for p in parts])
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "levels": pa.array([pack(x) for x in np.split(level, ends[:-1])],
                                            pa.binary())})

    def order(table: pa.Table, answers: pa.Table) -> pa.Table:
        keys, packed_texts = table.column("k").combine_chunks(), table.column("z").to_pylist()
        doc, h = sets(table)
        bucket = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
        levels = answers.column("levels").to_pylist()
        level = np.concatenate([np.zeros(0, np.uint8),
                                *(unpack(levels[i], np.uint8)[0] for i in bucket)])
        _, place = np.unique(h >> shift, return_inverse=True)
        level = level[place]
        by = np.lexsort((h, level, doc))
        h, level = h[by], level[by]
        size = np.bincount(doc, minlength=len(keys))
        begin = np.cumsum(size) - size
        nth = np.arange(len(h)) - np.repeat(begin, size)
        first = np.repeat(prefix_size(size, percent), size) > nth
        filled = np.flatnonzero(size)

        def folded(x: np.ndarray) -> np.ndarray:
            out = np.zeros(len(keys), np.uint64)
            if len(filled):
                out[filled] = np.add.reduceat(x, begin[filled])
            return mix(out + size.astype(np.uint64)).view(np.int64)

        shown = first & (level > 0)
        n_shown = np.bincount(doc[shown], minlength=len(keys))
        alone = np.bincount(doc[level == 0], minlength=len(keys))
        ends = np.r_[0, np.cumsum(n_shown)].astype(np.int32)
        zero = np.uint64(0)
        return pa.table({
            "k": keys, "n": pa.array(size, pa.int64()), "alone": pa.array(alone, pa.int64()),
            "sig_a": pa.array(folded(mix(h))), "sig_b": pa.array(folded(mix(h * BASE))),
            "prefix": pa.array(folded(np.where(first, mix(h + BASE), zero))),
            "grams": pa.ListArray.from_arrays(ends, pa.array(h[shown].view(np.int64))),
            "places": pa.ListArray.from_arrays(ends, pa.array(nth[shown].astype(np.int32))),
            "z": pa.array([z if m else None for z, m in zip(packed_texts, n_shown.tolist())],
                          pa.binary())})

    asked = packed.groupBy("block").applyInArrow(
        ask, "bucket int, block int, gaps binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(
        answer, "block int, bucket int, levels binary")
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        order, f"k {kind}, n long, alone long, sig_a long, sig_b long, prefix long, "
               "grams array<long>, places array<int>, z binary")


def _verified(pairs: DataFrame, digests: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold, by their whole sets."""
    texts = digests.filter(F.col("z").isNotNull()).select("k", "z")
    rows = (pairs.join(texts.select(F.col("k").alias("a"), F.col("z").alias("za")), "a")
            .join(texts.select(F.col("k").alias("b"), F.col("z").alias("zb")), "b"))
    kind = digests.schema["k"].dataType.simpleString()

    def check(batches):
        last, known = None, None
        for batch in batches:
            keep = []
            for za, zb in zip(batch.column("za").to_pylist(), batch.column("zb").to_pylist()):
                if zb != last:
                    last, known = zb, shingle_sets([unzipped(zb)], n)[1]
                mine = shingle_sets([unzipped(za)], n)[1]
                both = len(np.intersect1d(mine, known, assume_unique=True))
                keep.append(100 * both >= percent * (len(mine) + len(known) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.select("a", "b", "za", "zb").mapInArrow(check, f"a {kind}, b {kind}")


def _may_reach(percent: int):
    """Sizes and places (of the first shared n-gram) with which a pair can still reach the
    threshold; columns n, m, i, j."""
    shared = 1 + F.least(F.col("n") - F.col("i") - 1, F.col("m") - F.col("j") - 1)
    return ((100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
            & ((100 + percent) * shared >= percent * (F.col("n") + F.col("m"))))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N,
                       percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) for every row: the size of its set, and the smallest
    key that links lead to."""
    rows = stash(_digests(docs, key, text, n, percent), "jaccard-digests")
    # one class per set; the smallest key stands for it
    same = ["n", "sig_a", "sig_b"]
    classes = stash(rows.filter("n > 0").groupBy(*same).agg(F.min("k").alias("rep")),
                    "jaccard-classes")
    reps = stash(rows.filter(F.size("grams") > 0).drop("z")
                 .join(classes.select(F.col("rep").alias("k")), "k", "left_semi")
                 .dropDuplicates(["k"]), "jaccard-reps")
    # groups: identical prefix and size
    groups = stash(reps.groupBy("prefix", "n").agg(F.min("k").alias("group"),
                                                   F.count(F.lit(1)).alias("members")),
                   "jaccard-groups")
    inside = (reps.select("k", "prefix", "n")
              .join(groups.filter("members > 1"), ["prefix", "n"])
              .filter(F.col("k") != F.col("group"))
              .select(F.col("k").alias("a"), F.col("group").alias("b")))
    at_gram = F.explode(F.arrays_zip("grams", "places")).alias("x")

    def grams_of(df: DataFrame, *cols) -> DataFrame:
        return df.select(*cols, at_gram).select(
            *cols, F.col("x.grams").alias("gram"), F.col("x.places").alias("i"))

    entries = stash(grams_of(
        reps.join(groups.select(F.col("group").alias("k")), "k", "left_semi"),
        "k", "n", "alone"), "jaccard-entries")
    # of the pairs (alone, key) the smallest by gram: the pivot
    least = entries.groupBy("gram").agg(F.min("alone").alias("alone"),
                                        F.count(F.lit(1)).alias("many"))
    least = stash(least.filter("many > 1"), "jaccard-least")
    pivots = stash(entries.join(least, ["gram", "alone"]).groupBy("gram").agg(
        F.min("k").alias("b")), "jaccard-pivots")
    sizes = entries.select(F.col("gram"), F.col("k").alias("b"), F.col("n").alias("m"),
                           F.col("i").alias("j"))
    pivots = stash(pivots.join(sizes, ["gram", "b"]), "jaccard-pivot-places")
    across = (entries.join(pivots, "gram").filter(F.col("k") != F.col("b"))
              .filter(_may_reach(percent))
              .select(F.col("k").alias("a"), "b"))
    links = stash(_verified(inside.unionByName(across).distinct(), rows, n, percent),
                  "jaccard-links")
    found = components(links)
    # n-grams whose documents still lie apart
    members = grams_of(reps, "k", "n")
    placed = stash(members.join(found.withColumnRenamed("node", "k"), "k", "left")
                   .select("gram", "k", "n", "i",
                           F.coalesce("component", "k").alias("c")), "jaccard-placed")
    apart = stash(placed.groupBy("gram").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                  .filter("lo < hi").select("gram"), "jaccard-apart")
    open_ = stash(placed.join(apart, "gram"), "jaccard-open")
    other = open_.select("gram", F.col("k").alias("b"), F.col("n").alias("m"),
                         F.col("i").alias("j"), F.col("c").alias("d"))
    more = (open_.join(other, "gram").filter((F.col("c") != F.col("d")) & (F.col("k") < F.col("b")))
            .filter(_may_reach(percent))
            .select(F.col("k").alias("a"), "b").distinct())
    late = stash(_verified(more, rows, n, percent), "jaccard-late-links")
    if late.limit(1).count():
        found = components(links.unionByName(late))
    out = (rows.select("k", *same).join(classes, same, "left")
           .join(found.withColumnRenamed("node", "rep"), "rep", "left"))
    return out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"),
                      F.coalesce("component", "rep", "k").alias("component_id"))
