"""Repeatable sampling and splitting by seeded hash keys.

``orderBy(rand(seed))`` and ``randomSplit`` depend on how rows are laid out in
partitions, so a retried task or a different file split changes the result.  Here
every decision is a function of the row's key and the seed only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.keys import hash_bucket, seeded_key
from rankloom.session import ensure_checkpoint_dir


def sample_keys(df: DataFrame, key: str, n: int | None, seed: int = 42,
                slack: float = 0.05) -> DataFrame:
    """The ``n`` distinct keys with the smallest seeded hash (all keys if ``n`` is None).

    A plain ``orderBy(h).limit(n)`` makes every partition send its own top ``n``
    to one task.  Instead a hash threshold keeping ~``n·(1+slack)`` keys is chosen
    from the key count (hashes are uniform), checked with one count, widened if it
    kept too few, and only the survivors go through the exact ordered limit.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = df.select(key).distinct().withColumn("_h", seeded_key(key, seed))
    if n is None:
        return keys.select(key)
    keys = keys.persist()           # counted, filtered and limited below: scan once
    try:
        total = keys.count()
        if total <= n:
            return keys.select(key).checkpoint(eager=True)
        frac = min(1.0, n * (1.0 + slack) / total + 64.0 / total)
        while True:
            # first 8 hex digits as a number in [0, 2^32)
            limit_hex = int(frac * 0xFFFFFFFF)
            kept = keys.filter(F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") <= limit_hex)
            if frac >= 1.0 or kept.count() >= n:
                break
            frac = min(1.0, frac * 2)
        # the sample (n keys) is frozen in the shared checkpoint folder: later joins
        # read it directly and a lost executor cannot change it
        return kept.orderBy("_h", key).limit(n).select(key).checkpoint(eager=True)
    finally:
        keys.unpersist()


def split_by_hash(df: DataFrame, key: str, fractions=(0.8, 0.2), seed: int = 42):
    """Split rows by a hash bucket of ``key`` (user key → split by user)."""
    if abs(sum(fractions) - 1.0) > 1e-9:
        raise ValueError("fractions must sum to 1")
    b = hash_bucket(key, seed, 10000)
    out, lo = [], 0
    for i, f in enumerate(fractions):
        hi = 10000 if i == len(fractions) - 1 else lo + int(round(f * 10000))
        out.append(df.filter((b >= lo) & (b < hi)))
        lo = hi
    return out


def downsample(df: DataFrame, key_cols: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """Keep a row when the hash bucket of its key is below ``fraction`` (Bernoulli-like)."""
    if fraction >= 1.0:
        return df
    if fraction <= 0.0:
        return df.limit(0)
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    return df.filter(hash_bucket(key, seed, 1_000_000) < int(round(fraction * 1_000_000)))


def sample_per_group(df: DataFrame, group_col: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Up to ``k`` rows per group, the ones with the smallest seeded hash of ``key``.

    The window keeps only ``k`` rows per task and group before its shuffle
    (WindowGroupLimit), so a huge group does not travel whole.
    """
    w = Window.partitionBy(group_col).orderBy(seeded_key(key, seed), F.col(key))
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
            .drop("_rn"))
