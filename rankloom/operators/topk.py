"""Exact top-k of many queries against many targets by blocked matrix products.

A task takes its queries in batches, one matrix each, and multiplies it with blocks of the
target matrix.  The score of target t for query q is ``weight * <q, t> + bias(t)``.  Targets are
ordered by the largest score they can reach; by Cauchy-Schwarz no target from block b on
scores more than ``weight * |q| * (largest norm from b on) + (largest bias from b on)``, so a
query leaves the batch as soon as that is below its k-th score.  Nothing is approximated:
equal scores are kept until the target's id decides (or all of them, with ``ties``).

No row is ever made of a query and a target but for the k results.  ``targets_of`` holds a
table of checked size (a candidate pool, made by an ordered limit); ``topk_by_norm`` takes
targets of any number in buckets of falling norm, each of a checked size, one a round, and
carries on only the queries that the next bucket can still change.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions.vectors import l2_norm
from rankloom.sources.tables import kept

BLOCK = 256                    # targets scored at once
WARM, WIDE = 8, 8              # after the first blocks, when few targets enter, they are wider
BATCH = 2048                   # queries of a matrix
MAX_TARGET_BYTES = 64 << 20    # targets that are shipped to the tasks at once
SLACK = 1e-9                   # relative allowance for rounding in a bound
ROWS = 256                     # queries whose single-precision scores of a block fit a core's cache
SINGLE = 1e15                  # norms up to which these scores neither overflow nor vanish unseen


@dataclass
class Targets:
    """Targets in the order of the largest score a query of norm 1 can give them."""

    ids: np.ndarray            # int64
    vectors: np.ndarray        # n x d
    bias: np.ndarray
    extra: dict[str, np.ndarray]

    def __post_init__(self):
        norm = np.sqrt((self.vectors ** 2).sum(1)) if len(self.ids) else np.zeros(0)
        order = np.lexsort((self.ids, -(norm + self.bias)))
        self.ids, self.vectors, self.bias = self.ids[order], self.vectors[order], self.bias[order]
        self.extra = {k: v[order] for k, v in self.extra.items()}
        self.norm = norm[order]
        # the largest norm and bias from each place on
        self.top_norm = np.maximum.accumulate(self.norm[::-1])[::-1]
        self.top_bias = np.maximum.accumulate(self.bias[::-1])[::-1]
        self.by_id = np.argsort(self.ids, kind="stable")

    def places(self, ids: np.ndarray) -> np.ndarray:
        """The place of each id, -1 for others."""
        if not len(self.ids):
            return np.full(len(ids), -1)
        at = np.minimum(np.searchsorted(self.ids, ids, sorter=self.by_id), len(self.ids) - 1)
        found = self.by_id[at]
        return np.where(self.ids[found] == ids, found, -1)


def targets_of(df: DataFrame, vector: str, bias: str | None = None, extra: tuple = (),
               key: str = "itemId", max_rows: int | None = None, what: str = "target table"
               ) -> Targets:
    """A bounded table (checked: ``max_rows`` if given, ``MAX_TARGET_BYTES``) as matrices."""
    limited = df if max_rows is None else df.limit(max_rows + 1)
    cols = [key, vector, *([bias] if bias else []), *extra]
    rows, size = [], 0
    for r in limited.select(*cols).toLocalIterator():
        rows.append(r)
        size += 8 * (len(r[vector]) + len(cols))
        if size > MAX_TARGET_BYTES or (max_rows is not None and len(rows) > max_rows):
            raise ValueError(f"{what} has more than {max_rows or MAX_TARGET_BYTES} "
                             f"{'rows' if max_rows else 'bytes'}; refusing to attach it")

    def column(name, kind=np.float64):
        return np.array([r[name] for r in rows], kind)

    out = Targets(column(key, np.int64),
                  column(vector) if rows else np.zeros((0, 0)),
                  column(bias) if bias else np.zeros(len(rows)), {x: column(x) for x in extra})
    if not all(np.isfinite(x).all() for x in (out.vectors, out.bias, *out.extra.values())):
        raise ValueError(f"non-finite value in the {what}")
    return out


def _bucket(rows: DataFrame, width: int) -> Targets:
    """A bucket of (id, vector) rows, whose size is checked, as matrices: fetched as Arrow."""
    n = rows.count()
    if 8 * n * (width + 2) > MAX_TARGET_BYTES:
        raise ValueError(f"bucket has more than {MAX_TARGET_BYTES} bytes; refusing to attach it")
    found = rows.toArrow().combine_chunks()
    vectors = _matrix(found.column("vector"), width)
    if not np.isfinite(vectors).all():
        raise ValueError("non-finite value in the bucket")
    return Targets(found.column("id").to_numpy().astype(np.int64), vectors, np.zeros(len(vectors)), {})


class Best:
    """The best targets so far of a batch: (row, score, id, place), sorted by row, falling score
    and id."""

    def __init__(self, rows: int, k: int, ties: bool):
        self.n, self.k, self.ties = rows, k, ties
        self.row, self.id, self.place = (np.zeros(0, np.int64) for _ in range(3))
        self.score = np.zeros(0)
        self.kth = np.full(rows, -np.inf)

    def add(self, row, score, id_, place) -> None:
        """Only rows that get something new are sorted again."""
        touched = np.zeros(self.n, bool)
        touched[row] = True
        old = touched[self.row]
        rest = ~old
        row, score = np.concatenate([self.row[old], row]), np.concatenate([self.score[old], score])
        id_, place = np.concatenate([self.id[old], id_]), np.concatenate([self.place[old], place])
        order = np.lexsort((id_, -score, row))
        row, score = row[order], score[order]
        start = np.searchsorted(row, np.arange(self.n))
        count = np.diff(np.append(start, len(row)))
        full = count >= self.k
        self.kth[full] = score[start[full] + self.k - 1]
        keep = (score >= self.kth[row] if self.ties
                else np.arange(len(row)) - start[row] < self.k)
        row = np.concatenate([self.row[rest], row[keep]])
        by_row = np.argsort(row, kind="stable")
        self.row = row[by_row]
        self.score = np.concatenate([self.score[rest], score[keep]])[by_row]
        self.id = np.concatenate([self.id[rest], id_[order][keep]])[by_row]
        self.place = np.concatenate([self.place[rest], place[order][keep]])[by_row]

    def ranks(self) -> np.ndarray:
        """1 + the number of better ones of the row (with ties), else 1, 2, ..."""
        at = np.arange(len(self.row))
        new = np.append(True, self.row[1:] != self.row[:-1])[:len(self.row)]
        first = np.maximum.accumulate(np.where(new, at, 0)) if len(at) else at
        if not self.ties:
            return at - first + 1
        higher = new | np.append(True, self.score[1:] != self.score[:-1])[:len(self.row)]
        return (np.maximum.accumulate(np.where(higher, at, 0)) if len(at) else at) - first + 1


def best_of(queries: np.ndarray, targets: Targets, k: int, weight: float = 1.0,
            ties: bool = False, digits: int | None = None,
            without: tuple[np.ndarray, np.ndarray] | None = None,
            best: Best | None = None) -> tuple[Best, np.ndarray]:
    """The best ``k`` targets of every row of ``queries`` and how many targets each was
    multiplied with.  ``without``: (row, id) pairs that are left out.  ``best``: results against
    other targets, carried on.  ``weight`` must not be negative."""
    best = best or Best(len(queries), k, ties)
    scored = np.zeros(len(queries), np.int64)
    norm = np.sqrt((queries ** 2).sum(1))
    if (weight == 1.0 and digits is None and without is None and len(targets.ids) and not targets.bias.any()
            and max(norm.max(initial=0), targets.top_norm[0]) < SINGLE):
        _best_products(queries, norm, targets, k, best, scored)
        return best, scored
    out_row, out_place = without if without is not None else (np.zeros(0, np.int64),) * 2
    out_place = targets.places(out_place)
    order = np.argsort(out_place, kind="stable")
    out_row, out_place = out_row[order], out_place[order]
    half = 0.0 if digits is None else 10.0 ** -digits
    active = np.arange(len(queries))
    lo = hi = 0
    while hi < len(targets.ids):
        lo = hi
        reach = weight * norm[active] * targets.top_norm[lo]
        bound = reach + targets.top_bias[lo]
        bound += SLACK * (np.abs(reach) + abs(targets.top_bias[lo])) + half
        active = active[bound >= best.kth[active]]
        if not len(active):
            break
        hi = min(lo + (BLOCK if lo < WARM * BLOCK else WIDE * BLOCK), len(targets.ids))
        score = queries[active] @ targets.vectors[lo:hi].T
        if weight != 1.0:
            score *= weight
        score += targets.bias[lo:hi]
        if digits is not None:
            score = np.round(score, digits)
        scored[active] += hi - lo
        a, b = np.searchsorted(out_place, [lo, hi])
        if b > a:
            line = np.full(len(queries), -1)
            line[active] = np.arange(len(active))
            here = line[out_row[a:b]]
            score[here[here >= 0], out_place[a:b][here >= 0] - lo] = -np.inf
        # most rows get nothing from a later block: their best score there is below the k-th
        open_ = np.flatnonzero(score.max(axis=1) >= best.kth[active])
        if not len(open_):
            continue
        score, least = score[open_], best.kth[active[open_]]
        if hi - lo > k:
            least = np.maximum(least, np.partition(score, hi - lo - k, axis=1)[:, hi - lo - k])
        r, c = np.nonzero((score >= least[:, None]) & (score > -np.inf))
        best.add(active[open_[r]], score[r, c], targets.ids[lo:hi][c], c + lo)
    return best, scored


def _best_products(queries: np.ndarray, norm: np.ndarray, targets: Targets, k: int, best: Best,
                   scored: np.ndarray) -> None:
    """``best_of`` for plain inner products: a block is multiplied in single precision, and only pairs
    that its error leaves a chance are scored in double, all in the same way."""
    single, vectors = queries.astype(np.float32), targets.vectors.astype(np.float32)
    # inputs and sums are rounded to 2 ** -24 of their size; what vanishes is below the last term
    error = (queries.shape[1] + 8) * 2.0 ** -23 * norm
    active = np.arange(len(queries))
    lo = hi = 0

    def below(x):
        return np.nextafter(x.astype(np.float32), np.float32(-np.inf))

    while hi < len(targets.ids):
        lo = hi
        bound = norm[active] * targets.top_norm[lo] * (1 + SLACK)
        active = active[bound >= best.kth[active]]
        if not len(active):
            break
        hi = min(lo + (BLOCK if lo < WARM * BLOCK else WIDE * BLOCK), len(targets.ids))
        scored[active] += hi - lo
        block, found = vectors[lo:hi].T, []
        for a in range(0, len(active), ROWS):
            rows = active[a:a + ROWS]
            score = single[rows] @ block
            off = error[rows] * targets.top_norm[lo] + 1e-30
            least = best.kth[rows] - off
            open_ = np.flatnonzero(score.max(axis=1) >= least)
            if not len(open_):
                continue
            rows, off = rows[open_], off[open_]
            score = score[open_] if len(open_) < len(score) else score
            least = below(least[open_])
            ok = score >= least[:, None]
            if hi - lo > k and np.count_nonzero(ok) > 8 * k * len(rows):
                kth = np.partition(score, hi - lo - k, axis=1)[:, hi - lo - k]
                ok = score >= np.maximum(least, below(kth - 2 * off))[:, None]
            r, c = np.nonzero(ok)
            r, c = rows[r], c + lo
            exact = np.einsum("ij,ij->i", queries[r], targets.vectors[c])
            ok = exact >= best.kth[r]
            found.append((r[ok], exact[ok], targets.ids[c[ok]], c[ok]))
        if sum(len(f[0]) for f in found):
            best.add(*map(np.concatenate, zip(*found)))


def _matrix(col, width: int) -> np.ndarray:
    """A column of equally long arrays as rows of a matrix."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False),
                      np.float64).reshape(len(col), width) if len(col) else np.zeros((0, width))


def _pairs(col) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of a column of arrays; null arrays are empty."""
    sizes = np.array([len(x) if x is not None else 0 for x in col.to_pylist()], np.int64)
    return (np.repeat(np.arange(len(col)), sizes),
            np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.int64))


def topk_bounded(queries: DataFrame, targets: Targets, k: int, key: str, vector: str,
                 weight: float = 1.0, unit: bool = False, ties: bool = False,
                 digits: int | None = None, without: str | None = None,
                 target: str = "itemId") -> DataFrame:
    """(key, target, score, rank, extra...) of the best ``k`` targets per query, in one pass
    over the queries and without a shuffle.  ``unit`` scales query vectors to length 1 (a zero
    vector stays).  ``without`` names an array column of target ids to leave out."""
    shipped = queries.sparkSession.sparkContext.broadcast(targets)
    width = targets.vectors.shape[1]
    cols = [key, vector, *([without] if without else [])]

    def run(batches):
        t = shipped.value
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                q = _matrix(part.column(vector), width)
                if unit:
                    norm = np.sqrt((q ** 2).sum(1))
                    q = q / np.where(norm == 0, 1.0, norm)[:, None]
                best, _ = best_of(q, t, k, weight, ties, digits,
                                  _pairs(part.column(without)) if without else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(key).take(pa.array(best.row)), pa.array(best.id),
                     pa.array(best.score), pa.array(best.ranks().astype(np.int32)),
                     *(pa.array(v[best.place]) for v in t.extra.values())],
                    [key, "_target", "score", "rank", *t.extra])

    kind = queries.schema[key].dataType.simpleString()
    out = queries.select(*cols).mapInArrow(
        run, f"`{key}` {kind}, _target long, score double, rank int"
             + "".join(f", `{x}` double" for x in targets.extra))
    return out.withColumnRenamed("_target", target)


# ---- targets of any number -------------------------------------------------------------------

_STATE = "vector array<double>, norm double, best array<struct<id:long,score:double>>, " \
         "kth double, scored long"


def norm_buckets(targets: DataFrame, rows: int, n: int) -> tuple[DataFrame, list[tuple[int, float]]]:
    """``targets`` (id, vector, norm; n of them) with a column ``bucket`` of about ``rows`` rows
    each, and (bucket, largest norm) from the largest norms down."""
    parts = -(-n // rows)
    if parts <= 1:
        return targets.withColumn("bucket", F.lit(0)), [(0, float("inf"))]
    cuts = targets.agg(F.percentile_approx(
        "norm", [i / parts for i in range(1, parts)], 100 * parts).alias("c")).first()["c"]
    level = sum((F.col("norm") < c).cast("int") for c in sorted(set(cuts)))
    # equal norms can't be told apart by cuts: a full level is dealt out by id
    sizes = targets.groupBy(level.alias("level")).count()
    shares = {r["level"]: -(-r["count"] // rows) for r in sizes.collect()}       # parts rows
    start = {v: sum(shares[x] for x in shares if x < v) for v in shares}
    bucket = F.lit(None).cast("int")
    for v, share in shares.items():
        bucket = F.when(level == v, F.lit(start[v]) + F.pmod(
            F.xxhash64("id"), F.lit(share)).cast("int")).otherwise(bucket)
    out = kept(targets.withColumn("bucket", bucket), "topk-buckets")
    found = out.groupBy("bucket").agg(F.max("norm").alias("top")).orderBy(F.desc("top"), "bucket")
    return out, [(r["bucket"], r["top"]) for r in found.collect()]              # one row a bucket


def topk_by_norm(queries: DataFrame, targets: DataFrame, k: int, query: str = "userId",
                 target: str = "itemId", max_bytes: int = MAX_TARGET_BYTES) -> DataFrame:
    """(query, target, score, rank, scored): the ``k`` targets of largest inner product for
    every query.  Both inputs have (id, vector), vectors of one length; ``scored`` is the number
    of targets the query was multiplied with.

    Rounds go through buckets of falling norm.  Between rounds the queries that the next
    bucket can't change any more are set aside; the others are written once a round.
    """
    spark = queries.sparkSession
    vec = F.col("vector").cast("array<double>").alias("vector")
    t = targets.select(F.col("id").cast("long").alias("id"), vec).withColumn("norm", l2_norm("vector"))
    q = queries.select("id", vec).withColumn("norm", l2_norm("vector"))
    size = t.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    kind = queries.schema["id"].dataType.simpleString()
    if not size["n"]:
        return spark.createDataFrame(
            [], f"`{query}` {kind}, `{target}` long, score double, rank int, scored long")
    width = size["width"]
    buckets, order = norm_buckets(t, max(1, max_bytes // (16 * (width + 2))), size["n"])

    def against(chunk):
        def run(batches):
            c = chunk.value
            for batch in batches:
                for lo in range(0, batch.num_rows, BATCH):
                    part = batch.slice(lo, BATCH)
                    best = Best(part.num_rows, k, False)
                    held = part.column("best")
                    sizes = np.array([len(x) for x in held.to_pylist()], np.int64)
                    flat = held.flatten()
                    if len(flat):
                        row = np.repeat(np.arange(len(held)), sizes)
                        best.add(row, flat.field(1).to_numpy(zero_copy_only=False),
                                 flat.field(0).to_numpy(zero_copy_only=False), np.zeros_like(row))
                    best, scored = best_of(_matrix(part.column("vector"), width), c, k, best=best)
                    at = np.searchsorted(best.row, np.arange(part.num_rows + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id"), part.column("vector"), part.column("norm"),
                         pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays(
                             [pa.array(best.id), pa.array(best.score)], ["id", "score"])),
                         pa.array(best.kth),
                         pa.array(part.column("scored").to_numpy() + scored)],
                        ["id", "vector", "norm", "best", "kth", "scored"])
        return run

    # the work is in the products, not in the bytes: as many tasks as partitions, by id
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    state = q.select("id", "vector", "norm").repartition(parts, "id").select(
                     "id", "vector", "norm", F.array().cast("array<struct<id:long,score:double>>").alias("best"),
                     F.lit(float("-inf")).alias("kth"), F.lit(0).cast("long").alias("scored"))
    done = []
    for i, (bucket, top) in enumerate(order):
        if i:
            open_ = F.col("norm") * (top * (1 + SLACK)) >= F.col("kth")
            done.append(state.filter(~open_))
            state = state.filter(open_)
            if state.isEmpty():
                break
        rows = buckets.filter(F.col("bucket") == bucket).select("id", "vector")
        chunk = spark.sparkContext.broadcast(_bucket(rows, width))
        state = state.mapInArrow(against(chunk), f"id {kind}, {_STATE}")
        if len(order) > 1:
            state = kept(state, f"topk-round-{i}")
    done.append(state)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(F.col("id").alias(query), "scored", F.posexplode("best").alias("p", "b")).select(
        query, F.col("b.id").alias(target), F.col("b.score").alias("score"),
        (F.col("p") + 1).cast("int").alias("rank"), "scored")


# ---- many targets, few queries -----------------------------------------------------------------

def _number(key: Column, kind: T.DataType) -> Column:
    """A key as a number that orders equal scores: itself if it is one, else its hash."""
    return (key if isinstance(kind, T.IntegralType) else F.xxhash64(key)).cast("long")


def nearest(table: DataFrame, queries: DataFrame, k: int, key: str, vector: str,
            digits: int | None = None, query: str = "query", score: str = "similarity",
            max_bytes: int = MAX_TARGET_BYTES) -> DataFrame:
    """(query, key, score, rank): the ``k`` rows of ``table`` with the largest cosine to each row
    of ``queries``, the row of its own key left out.  Both have (key, vector).

    Every task goes over its rows of ``table`` once and holds the best ``k`` of each query, so
    tasks * queries * k rows are shuffled.  Queries are shipped in parts of at most about
    ``max_bytes``, one pass over the table each.  Equal scores go by the key (its hash, if it
    isn't a number); a null, zero or differently long vector has cosine 0 with all.
    """
    kind = table.schema[key].dataType

    def rows(df):
        v = F.col(vector).cast("array<double>")
        return df.select(F.col(key).alias("key"), _number(F.col(key), kind).alias("id"),
                         v.alias("vector"))

    asked, found = rows(queries), rows(table)
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d")).first()
    width = max(size["d"] or 0, 0)
    parts = max(1, -(-size["n"] * 16 * (width + 4) // max_bytes))
    out = None
    for i in range(parts):
        share = asked.filter(F.pmod(F.xxhash64("key"), F.lit(parts)) == i) if parts > 1 else asked
        local = share.collect()                     # about max_bytes
        ids = np.array([r["id"] for r in local], np.int64)
        q = _unit(_padded([r["vector"] for r in local], width))
        shipped = table.sparkSession.sparkContext.broadcast((ids, q, [r["key"] for r in local]))
        best = found.mapInArrow(_scan(shipped, width, k, digits),
                                f"query {kind.simpleString()}, key {kind.simpleString()}, id long, "
                                "score double")
        out = best if out is None else out.unionByName(best)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return (out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(F.col("query").alias(query), F.col("key").alias(key),
                    F.col("score").alias(score), "rank"))


def _padded(vectors: list, width: int) -> np.ndarray:
    """A matrix; a vector that is null, of another length or not finite is zero."""
    zero = [0.0] * width
    out = np.array([v if v is not None and len(v) == width and None not in v else zero
                    for v in vectors], np.float64).reshape(len(vectors), width)
    out[~np.isfinite(out).all(1)] = 0.0
    return out


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m ** 2).sum(1))
    return m / np.where(norm == 0, 1.0, norm)[:, None]


def _scan(shipped, width: int, k: int, digits: int | None):
    def run(batches):
        ids, q, keys = shipped.value
        runs = [(lo, min(lo + BATCH, len(ids))) for lo in range(0, len(ids), BATCH)]
        best = [Best(hi - lo, k, False) for lo, hi in runs]
        names: dict = {}
        kind = None
        for batch in batches:
            kind = batch.schema.field("key").type
            here = batch.column("key").to_pylist()
            numbers = batch.column("id").to_numpy()
            t = Targets(numbers, _unit(_padded(batch.column("vector").to_pylist(), width)),
                        np.zeros(len(numbers)), {})
            for i, (lo, hi) in enumerate(runs):
                best[i], _ = best_of(q[lo:hi], t, k, digits=digits,
                                     without=(np.arange(hi - lo), ids[lo:hi]), best=best[i])
            held = np.unique(np.concatenate([b.id for b in best])) if best else ids[:0]
            new = np.isin(numbers, held)
            names |= {int(n): here[j] for j, n in zip(np.flatnonzero(new), numbers[new])}
            if len(names) > 4 * len(held) + 1000:
                names = {n: names[n] for n in held.tolist()}
        for (lo, _), b in zip(runs, best):
            if len(b.row):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[lo + r] for r in b.row.tolist()], kind),
                     pa.array([names[n] for n in b.id.tolist()], kind), pa.array(b.id),
                     pa.array(b.score)], ["query", "key", "id", "score"])
    return run
