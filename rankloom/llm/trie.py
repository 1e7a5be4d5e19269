"""Conversation prefix trie: balanced parentheses per shard, shards merged along their spines.

1. *Rebuild.*  Turns get places within their conversation and prefixes get ids: 128-bit hashes
   added up place by place.  Both are running sums over (conversation, chunk of places), with
   the sums of the chunks before added, so a conversation of any length is spread over tasks.
   Texts are hashed where they are scanned and never shuffled.
2. *Nodes.*  One row per distinct prefix with its members' number and smallest id (its owner),
   by partial sums.  Children are summed up by parent.
3. *Shared chains.*  A node with one member heads a private tail, whose figures are known.  Of
   the others only the last node of each run with the same members is kept: along a path
   the number of members falls at every kept node, so a path of k of them needs k
   conversations of up to k turns, and a row that holds a path stays below the root of twice
   the number of all turns.  (owner, members) names such a chain.
4. *Shards.*  The paths of the owners are sorted by range, which is a depth-first order of the
   trie.  Blocks of consecutive paths are encoded as balanced parentheses: an open one per
   node and a pair for its leaves.  Excess minima by 64 parentheses and a tree over them give
   findclose; ranks of leaf pairs at both ends of a subtree select from the running sum of leaf
   numbers, and ranks of open ones from the running sum of savings.
5. *Spines.*  Nodes on the first or last path of a block may go on in the next one: their
   partial figures are added up.  What a block counts again of the path before it is left
   out, across partitions by comparing their first and last paths (one row a partition).
6. *Ends.*  Ids that end in the same node are packed in sorted runs by range, and one hash
   reads the runs of a node as a stream.

Defined results: null role or text is empty; turns with equal numbers go by the hash of (role,
text); rows with a null conversation id belong to none and are left out; repeated rows are
turns of their own; a conversation of which nothing is left ends in the root; an empty table has no
nodes.  Very long texts are hashed and their words counted whole.  Further columns of the
input are not read.  Turns of one conversation whose numbers share all but the last
``BITS`` bits are ordered by one task, in Spark's sort that spills.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.common import SPACE, stash
from rankloom.llm.packing import unzipped, zipped

GROUP, HEADS = 20, 4       # by contract: conversation c takes h < HEADS turns of c - c % GROUP
BITS = 12                  # 1 << BITS places are summed in one window
BLOCK = 200_000            # path elements encoded at once
RUN = 50_000               # ids in one packed run
SPAN = 64                  # parentheses in a block of excess minima
KEY = ["k1", "k2"]


# ---- 1. rebuilt conversations ------------------------------------------------------------

def _heads(c: Column) -> Column:
    return (F.crc32(c.cast("string").cast("binary")) % HEADS).cast("int")


def _running(rows: DataFrame, key: str, chunk: str, order: list, sums: dict[str, Column]
             ) -> DataFrame:
    """``rows`` with running sums per ``key`` in the order of (chunk, order), this row included.
    One window never holds more than a (key, chunk)."""
    inside = (Window.partitionBy(key, chunk).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    before = (Window.partitionBy(key).orderBy(chunk)
              .rowsBetween(Window.unboundedPreceding, -1))
    totals = rows.groupBy(key, chunk).agg(*[F.sum(v).alias(f"{n}_all") for n, v in sums.items()])
    offsets = totals.select(
        F.col(key).alias("_k"), F.col(chunk).alias("_c"),
        *[F.coalesce(F.sum(f"{n}_all").over(before), F.lit(0)).alias(f"{n}_before")
          for n in sums])
    out = rows.select(*rows.columns, *[F.sum(v).over(inside).alias(n) for n, v in sums.items()])
    out = out.join(offsets, (F.col(key) == F.col("_k")) & (F.col(chunk) == F.col("_c")))
    return out.select(*rows.columns, *[(F.col(n) + F.col(f"{n}_before")).alias(n) for n in sums])


def turns(conversations: DataFrame) -> DataFrame:
    """(c, place, a, b, words): hashes of (role, text) and the words of every turn; places
    count from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").alias("c"), "turn", F.coalesce(      # null comes before any number
            F.shiftright(F.col("turn").cast("long"), BITS), F.lit(-1 << 62)).alias("chunk"),
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("a"),
        F.conv(F.substring(digest, 16, 15), 16, 10).cast("long").alias("b"),
        F.regexp_count(text, F.lit(f"[^{SPACE}]+")).cast("long").alias("words"))
    order = [F.col("turn").asc_nulls_first(), "a", "b", "words"]
    return (_running(rows, "c", "chunk", order, {"n": F.lit(1).cast("long")})
            .select("c", (F.col("n") - 1).alias("place"), "a", "b", "words"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, turns) of all conversations, and the turns of all rebuilt ones: (c, place, a, b,
    words)."""
    own = stash(turns(conversations), "trie-turns")
    convs = stash(own.groupBy("c").agg(F.count(F.lit(1)).alias("turns")), "trie-conversations")
    base = own.filter(F.col("place") < HEADS - 1).filter(F.col("c") % GROUP == 0)
    taken = convs.withColumn("base", F.col("c") - F.col("c") % GROUP)
    head = (taken.select("c", "base").join(base.withColumnRenamed("c", "base"), "base")
            .filter(F.col("place") < _heads(F.col("c"))))
    size = convs.select(F.col("c").alias("base"), F.col("turns").alias("base_turns"))
    shift = (taken.join(size, "base", "left").select(  # what the heads leave out
        "c", (_heads(F.col("c")) - F.least(_heads(F.col("c")),
                                           F.coalesce("base_turns", F.lit(0)))).alias("less")))
    tail = (own.filter(F.col("place") >= _heads(F.col("c"))).join(stash(shift, "trie-shift"), "c")
            .withColumn("place", F.col("place") - F.col("less")))
    cols = ["c", "place", "a", "b", "words"]
    return convs, head.select(*cols).unionByName(tail.select(*cols))


def prefixes(rows: DataFrame) -> DataFrame:
    """(c, d, k1, k2, p1, p2, words, total): for every turn the id of the prefix that it ends
    and of the one before, and the words of the whole prefix."""
    at = F.col("place")
    slices = {}
    for i, h in enumerate((F.xxhash64("place", "a", "b"),
                           F.xxhash64("b", "place", "a", F.lit("second")))):
        slices[f"s{2 * i}"] = F.shiftrightunsigned(h, 32)
        slices[f"s{2 * i + 1}"] = h.bitwiseAND(F.lit(0xFFFFFFFF))
    rows = rows.select("c", "place", "words", F.shiftright(at, BITS).alias("chunk"),
                       *[v.alias(f"o{n}") for n, v in slices.items()])
    sums = {n: F.col(f"o{n}") for n in slices} | {"total": F.col("words")}
    rows = _running(rows, "c", "chunk", ["place"], sums)

    def key(d: Column, names: tuple, own: bool) -> Column:
        parts = [F.col(n) if own else F.col(n) - F.col(f"o{n}") for n in names]
        return F.when(d > 0, F.xxhash64(d, *parts)).otherwise(F.lit(0).cast("long"))

    return rows.select("c", (at + 1).alias("d"),
                       key(at + 1, ("s0", "s2"), True).alias("k1"),
                       key(at + 1, ("s1", "s3"), True).alias("k2"),
                       key(at, ("s0", "s2"), False).alias("p1"),
                       key(at, ("s1", "s3"), False).alias("p2"), "words", "total")


# ---- 2. nodes ------------------------------------------------------------------------------

def nodes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per distinct prefix: d, k1, k2, p1, p2, n, owner, words, total, n_children,
    private (children with one member), ends (members that end here), last (no child has all
    its members)."""
    found = rows.groupBy(*KEY).agg(
        F.max("d").alias("d"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        F.count(F.lit(1)).alias("n"), F.min("c").alias("owner"),
        F.max("words").alias("words"), F.max("total").alias("total"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("owner")).filter("n > 0")
    root = root.select(zero.alias("k1"), zero.alias("k2"), zero.alias("d"),
                       F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"),
                       "n", "owner", zero.alias("words"), zero.alias("total"))
    found = stash(found.select(*root.columns).unionByName(root), "trie-prefixes")
    below = found.filter(F.col("p1").isNotNull()).groupBy("p1", "p2").agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n") == 1).alias("private"),
        F.max("n").alias("most"), F.sum("n").alias("go_on"))
    below = below.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "n_children",
                         "private", "most", "go_on")
    out = found.join(below, KEY, "left")
    return out.select(
        *found.columns, F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("private", zero).alias("private"),
        (F.col("n") - F.coalesce("go_on", zero)).alias("ends"),
        (F.coalesce("most", zero) < F.col("n")).alias("last"))


# ---- 3. paths of shared chains -------------------------------------------------------------

def paths(convs: DataFrame, rows: DataFrame, tree: DataFrame) -> DataFrame:
    """(path): for every conversation that owns a shared chain, its shared chains from the root
    down, each as (k1, k2, owner, n, weight, leaves, foot).  ``weight`` is the savings of the
    chain's own turns, ``leaves`` the leaves that hang off its last node, ``foot`` the words of
    the whole prefix there."""
    chains = stash(tree.filter((F.col("n") > 1) & F.col("last")).select(
        *KEY, "d", "owner", "n", "total",
        (F.col("private") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves")),
        "trie-chains")
    owners = stash(chains.select(F.col("owner").alias("c")).distinct(), "trie-owners")
    own = rows.select("c", *KEY).unionByName(
        convs.select("c", F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2")))
    steps = (own.join(owners, "c", "left_semi").join(chains, KEY)
             .groupBy("c").agg(F.array_sort(F.collect_list(
                 F.struct("d", *KEY, "owner", "n", "total", "leaves"))).alias("steps")))

    def step(x: Column, i: Column) -> Column:
        before = F.coalesce(F.get(F.col("steps"), i - 1)["total"], F.lit(0))
        return F.struct(x["k1"].alias("k1"), x["k2"].alias("k2"), x["owner"].alias("owner"),
                        x["n"].alias("n"), ((x["n"] - 1) * (x["total"] - before)).alias("weight"),
                        x["leaves"].alias("leaves"), x["total"].alias("foot"))

    return steps.select(F.transform("steps", step).alias("path"))


# ---- 4. balanced parentheses of a block ----------------------------------------------------

class Parentheses:
    """A balanced sequence of open (1) and close (0) marks with a tree of excess minima."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(np.where(bits, 1, -1))
        spans = max(1, -(-len(bits) // SPAN))
        self.width = 1 << (spans - 1).bit_length()
        high = np.iinfo(np.int64).max
        padded = np.full(self.width * SPAN, high)
        padded[:len(bits)] = self.excess
        self.by_span = padded.reshape(self.width, SPAN)
        self.low = np.full(2 * self.width, high)
        self.low[self.width:] = self.by_span.min(1)
        for at in range(self.width.bit_length() - 2, -1, -1):
            one = slice(1 << at, 2 << at)
            self.low[one] = self.low[2 << at:4 << at].reshape(-1, 2).min(1)
        self.opened = np.cumsum(bits)
        # a leaf is an open mark with its close mark next to it
        pair = np.zeros(len(bits), bool)
        pair[1:] = bits[:-1] & ~bits[1:]
        self.pairs = np.cumsum(pair)

    def rank_open(self, at: np.ndarray) -> np.ndarray:
        """Open marks before each place."""
        return self.opened[at] - self.bits[at]

    def rank_leaf(self, at: np.ndarray) -> np.ndarray:
        """Leaf pairs that are over at or before each place."""
        return self.pairs[at]

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The mark that closes the open one at each place: the next with smaller excess."""
        want = self.excess[at] - 1
        out = np.full(len(at), -1)
        rest = np.arange(len(at))
        for part in np.array_split(rest, max(1, len(at) // 65_536)):   # the span it stands in
            span = self.by_span[at[part] // SPAN]
            hit = (span <= want[part, None]) & (np.arange(SPAN) > (at[part] % SPAN)[:, None])
            found = hit.any(1)
            out[part[found]] = at[part[found]] // SPAN * SPAN + hit[found].argmax(1)
        rest = np.flatnonzero(out < 0)
        node = at[rest] // SPAN + self.width
        up = np.ones(len(rest), bool)
        while up.any():                    # up to the first later subtree that falls so low
            i = np.flatnonzero(up)
            right = node[i] % 2 == 0
            beside = self.low[node[i] + 1] <= want[rest[i]]
            go = right & beside
            node[i] = np.where(go, node[i] + 1, node[i] // 2)
            up[i[go]] = False
        while len(node) and (node < self.width).any():      # and down to its first such span
            i = np.flatnonzero(node < self.width)
            left = 2 * node[i]
            node[i] = np.where(self.low[left] <= want[rest[i]], left, left + 1)
        for part in np.array_split(np.arange(len(rest)), max(1, len(rest) // 65_536)):
            span = self.by_span[node[part] - self.width]
            out[rest[part]] = ((node[part] - self.width) * SPAN
                               + (span <= want[rest[part], None]).argmax(1))
        return out


def encode(lens: np.ndarray, common: np.ndarray, leaves: np.ndarray):
    """Paths in depth-first order to parentheses.  ``lens``: elements of each path; ``common``:
    elements that it shares with the one before (0 for the first); ``leaves``: leaves hanging
    off each new element, in order.  Returns (bits, place of each new element's open mark)."""
    new = lens - common
    after = np.append(common[1:], 0)
    marks = 1 + 2 * (leaves > 0)                   # an open mark, and a pair for leaves
    ends = np.cumsum(new)                          # new elements up to each path's end
    closes = lens - after
    per_path = np.add.reduceat(np.append(marks, 0), np.minimum(ends - new, len(marks))) * (new > 0)
    begin = np.cumsum(per_path + closes) - (per_path + closes)
    path = np.repeat(np.arange(len(lens)), new)
    inner = np.cumsum(marks) - marks
    start = begin[path] + inner - (inner[(ends - new)[path]] if len(marks) else 0)
    bits = np.zeros(int((per_path + closes).sum()), bool)
    bits[start] = True
    bits[start[leaves > 0] + 1] = True
    return bits, start


def subtree_sums(bits: np.ndarray, start: np.ndarray, leaves: np.ndarray, weight: np.ndarray):
    """(leaves, savings) of the subtree of each element."""
    marks = Parentheses(bits)
    close = marks.find_close(start)
    # pairs in order: those of elements with leaves; an element without any leaf or child is a
    # pair of its own and adds none
    pairs = np.zeros(marks.pairs[-1] if len(bits) else 0, np.int64)
    has = start[leaves > 0] + 2
    pairs[marks.rank_leaf(has) - 1] = leaves[leaves > 0]
    by_pair = np.concatenate([[0], np.cumsum(pairs)])
    by_open = np.zeros(int(bits.sum()), np.int64)
    by_open[marks.rank_open(start)] = weight
    by_open = np.concatenate([[0], np.cumsum(by_open)])
    return (by_pair[marks.rank_leaf(close)] - by_pair[marks.rank_leaf(start)],
            by_open[marks.rank_open(close)] - by_open[marks.rank_open(start)])


# ---- 5. shards and spines ------------------------------------------------------------------

STEP = ("k1", "k2", "owner", "n", "weight", "leaves", "foot")
FIGURES = ("owner", "n", "leaves", "below", "weight", "foot")
SHARD = ("kind string, part int, " + "".join(f"{x} long, " for x in FIGURES)
         + f"path array<struct<{','.join(f'{x}:long' for x in STEP)}>>")


def _blocks(batches, most: int):
    """Lists of consecutive paths with about ``most`` elements together."""
    held, size = [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            held.append(path)
            size += len(path)
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def _shared(one: list, two: list) -> int:
    n = 0
    for x, y in zip(one, two):
        if x["k1"] != y["k1"] or x["k2"] != y["k2"]:
            break
        n += 1
    return n


def _shard(batches, most: int):
    """Rows of SHARD for one partition of sorted paths: ``node`` is done, ``spine`` is partial,
    ``first`` and ``last`` are the partition's outer paths."""
    kind = pa.schema([("kind", pa.string()), ("part", pa.int32()),
                      *[(x, pa.int64()) for x in FIGURES],
                      ("path", pa.list_(pa.struct([(x, pa.int64()) for x in STEP])))])

    def edge(name: str, part: int, path: list):
        return pa.RecordBatch.from_pylist([{"kind": name, "part": part, "path": path}], kind)

    from pyspark import TaskContext
    part, last = TaskContext.get().partitionId(), None
    for block in _blocks(batches, most):
        if last is None:
            yield edge("first", part, block[0])
        lens = np.array([len(p) for p in block])
        common = np.array([0] + [_shared(x, y) for x, y in zip(block, block[1:])])
        new = [x for p, k in zip(block, common) for x in p[k:]]
        col = {x: np.array([e[x] for e in new], np.int64)
               for x in STEP[2:]}
        spine = np.zeros(len(new), bool)
        spine[:lens[0]] = True
        known = _shared(last, block[0]) if last else 0     # counted by an earlier block
        weight, leaves = col["weight"].copy(), col["leaves"].copy()
        weight[:known] = leaves[:known] = 0
        bits, start = encode(lens, common, leaves)
        n_leaves, total = subtree_sums(bits, start, leaves, weight)
        # the last path: its elements are the open ones when the last path begins
        place = {(e["k1"], e["k2"]): i for i, e in enumerate(new)} if lens[-1] else {}
        for e in block[-1]:
            spine[place[e["k1"], e["k2"]]] = True
        last = block[-1]
        size = len(new)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(spine, "spine", "node").tolist(), pa.string()),
             pa.array(np.full(size, part, np.int32)), pa.array(col["owner"]), pa.array(col["n"]),
             pa.array(n_leaves), pa.array(total), pa.array(col["weight"]), pa.array(col["foot"]),
             pa.nulls(size, kind.field("path").type)], schema=kind)
    if last is not None:
        yield edge("last", part, last)


def chain_figures(shared: DataFrame, block: int = BLOCK) -> DataFrame:
    """(owner, n, leaves, below, foot): of every shared chain the leaves and the savings under
    its last node, and the words up to that node."""
    ordered = shared.withColumn("ids", F.transform("path", lambda x: F.struct(x["k1"], x["k2"])))
    parts = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered.repartitionByRange(parts, "ids").sortWithinPartitions("ids").select("path")
    found = stash(ordered.mapInArrow(lambda it: _shard(it, block), SHARD), "trie-shards")
    # one row per partition that has paths: what its first path shares with the last before
    outer = (found.filter(F.col("kind").isin("first", "last")).groupBy("part")
             .agg(F.max(F.when(F.col("kind") == "first", F.col("path"))).alias("first"),
                  F.max(F.when(F.col("kind") == "last", F.col("path"))).alias("last"))
             .withColumn("before", F.lag("last").over(Window.orderBy("part"))))
    both = F.zip_with("first", "before", lambda x, y: x["k1"].eqNullSafe(y["k1"])
                      & x["k2"].eqNullSafe(y["k2"]) & x["k1"].isNotNull())
    again = (outer.filter(F.col("before").isNotNull())
             .withColumn("k", F.size(F.filter(both, lambda same: same)))
             .withColumn("again", F.slice("first", F.lit(1), F.col("k"))))

    def rest(i: Column, what: str) -> Column:     # of an element and those under it
        return F.aggregate(F.slice("again", i + 1, F.col("k")), F.lit(0).cast("long"),
                           lambda s, x: s + x[what])

    less = again.select(F.posexplode("again").alias("i", "x"), "again", "k").select(
        F.col("x.owner").alias("owner"), F.col("x.n").alias("n"),
        (-rest(F.col("i"), "leaves")).alias("leaves"),
        (-rest(F.col("i"), "weight")).alias("below"), F.col("x.weight").alias("weight"),
        F.col("x.foot").alias("foot"))
    cols = list(FIGURES)
    spine = (found.filter(F.col("kind") == "spine").select(*cols).unionByName(less)
             .groupBy("owner", "n").agg(F.sum("leaves").alias("leaves"),
                                        F.sum("below").alias("below"),
                                        F.max("weight").alias("weight"),
                                        F.max("foot").alias("foot")))
    done = found.filter(F.col("kind") == "node").select(*cols).unionByName(spine.select(*cols))
    return done.select("owner", "n", "leaves", (F.col("below") - F.col("weight")).alias("below"),
                       "foot")


# ---- 6. members that end in a node ---------------------------------------------------------

def _runs(batches, most: int):
    """Sorted (k1, k2, c) to runs (k1, k2, first, ids) of joined decimal ids."""
    held: tuple | None = None
    ids: list[int] = []

    def run():
        return pa.RecordBatch.from_arrays(
            [*(pa.array([x], pa.int64()) for x in (*held, ids[0])),
             pa.array([zipped(",".join(map(str, ids)).encode())], pa.binary())],
            ["k1", "k2", "first", "ids"])

    for batch in batches:
        for k1, k2, c in zip(*(x.to_pylist() for x in batch.columns)):
            if held != (k1, k2) or len(ids) >= most:
                if ids:
                    yield run()
                held, ids = (k1, k2), []
            ids.append(c)
    if ids:
        yield run()


def _digests(batches):
    """Runs in order to one digest a node, read as a stream."""
    held, sha = None, None

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([held[0]], pa.int64()), pa.array([held[1]], pa.int64()),
             pa.array([sha.hexdigest()])], ["k1", "k2", "ends_sha256"])

    for batch in batches:
        for k1, k2, data in zip(*(batch.column(x).to_pylist() for x in ("k1", "k2", "ids"))):
            if held != (k1, k2):
                if held is not None:
                    yield out()
                held, sha = (k1, k2), hashlib.sha256(unzipped(data))
            else:
                sha.update(b"," + unzipped(data))
    if held is not None:
        yield out()


def end_digests(convs: DataFrame, rows: DataFrame, tree: DataFrame, run: int = RUN) -> DataFrame:
    """(k1, k2, ends_sha256) of the nodes with several members in which any ends."""
    zero = F.lit(0).cast("long")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = stash(tree.filter((F.col("n") > 1) & (F.col("ends") > 0)).select(*KEY), "trie-met")
    sizes = stash(rows.groupBy("c").agg(F.max("d").alias("d")), "trie-sizes")
    empty = convs.join(sizes, "c", "left_anti").select("c", zero.alias("k1"), zero.alias("k2"))
    last = rows.join(sizes, ["c", "d"], "left_semi").select("c", *KEY)
    ends = last.unionByName(empty).join(met, KEY, "left_semi")
    runs = (ends.select(*KEY, "c").repartitionByRange(parts, *KEY, "c")
            .sortWithinPartitions(*KEY, "c")
            .mapInArrow(lambda it: _runs(it, run), "k1 long, k2 long, first long, ids binary"))
    return (runs.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first")
            .mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, block: int = BLOCK, run: int = RUN) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    convs, rows = rebuilt(conversations)
    rows = stash(prefixes(rows), "trie-rows")
    tree = stash(nodes(convs, rows), "trie-nodes")
    figures = stash(chain_figures(paths(convs, rows, tree), block), "trie-figures")
    digests = stash(end_digests(convs, rows, tree, run), "trie-ends")
    parents = stash(tree.filter(F.col("n_children") > 0).select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("owner").alias("parent")),
        "trie-parents")
    out = (tree.join(parents, ["p1", "p2"], "left").join(figures, ["owner", "n"], "left")
           .join(digests, KEY, "left"))
    zero = F.lit(0).cast("long")
    alone = F.when((F.col("n") == 1) & (F.col("ends") == 1), F.col("owner").cast("string"))
    digest = F.sha2(F.coalesce(alone, F.lit("")).cast("binary"), 256)
    return out.select(
        F.col("owner").alias("conv_id"), F.col("d").alias("depth"),
        F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.when(F.col("n") == 1, zero).otherwise(
            F.col("below") + (F.col("n") - 1) * (F.col("foot") - F.col("total") + F.col("words")))
        .alias("saved_tokens"),
        F.coalesce("ends_sha256", digest).alias("ends_sha256"))
