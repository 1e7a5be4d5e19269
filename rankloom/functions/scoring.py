"""Scalar scoring expressions shared by the ranker, the three paths and reports."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# Fixed values that must equal the reference for identical results.
TASTE_WEIGHTS = (0.60, 0.25, 0.15)        # similarity, avgRating/5, logPop/10
POPULARITY_WEIGHTS = (0.5, 0.3, 0.2)      # logPop, avgRating, embedding norm
FLAT_SCORE = 0.5                          # min-max score when all scores are equal
COLD_MAX, POWER_MIN = 5, 20               # cold <= 5 < regular <= 20 < power
RMSE_BANDS = ((0.8, "Excellent"), (1.2, "Good"))
RMSE_ELSE = "Acceptable - consider tuning"
SEGMENT_NAMES = ("cold-start", "regular user", "power user")
PRODUCT_URL_PREFIX = "https://www.amazon.com/dp/"
UNKNOWN_PREFIX = "UNKNOWN_"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_count(c) -> Column:
    """Natural log of (count + 1) as double."""
    return F.log(_col(c).cast("double") + F.lit(1.0))


def minmax_over(score, partition_by, flat: float = FLAT_SCORE) -> Column:
    """Min-max scaling of ``score`` within each partition; ``flat`` when max == min."""
    w = Window.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    s = _col(score)
    lo, hi = F.min(s).over(w), F.max(s).over(w)
    return F.when(hi == lo, F.lit(flat)).otherwise((s - lo) / (hi - lo))


def taste_blend(similarity, avg_rating, log_pop) -> Column:
    ws, wa, wp = TASTE_WEIGHTS
    return (_col(similarity) * ws + (_col(avg_rating) / F.lit(5.0)) * wa
            + (_col(log_pop) / F.lit(10.0)) * wp)


def popularity_blend(log_pop, avg_rating, emb_norm) -> Column:
    wp, wa, wn = POPULARITY_WEIGHTS
    return _col(log_pop) * wp + _col(avg_rating) * wa + _col(emb_norm) * wn


def segment_label(rating_count, cold_max: int = COLD_MAX, power_min: int = POWER_MIN) -> Column:
    n = _col(rating_count)
    cold, regular, power = SEGMENT_NAMES
    return (F.when(n > power_min, F.lit(power))
            .when(n > cold_max, F.lit(regular))
            .otherwise(F.lit(cold)))


def product_url(key) -> Column:
    return F.concat(F.lit(PRODUCT_URL_PREFIX), _col(key))


def unknown_label(item_id) -> Column:
    return F.concat(F.lit(UNKNOWN_PREFIX), _col(item_id).cast("string"))


def rmse_quality(rmse) -> Column:
    (t1, l1), (t2, l2) = RMSE_BANDS
    r = _col(rmse)
    return F.when(r < t1, F.lit(l1)).when(r < t2, F.lit(l2)).otherwise(F.lit(RMSE_ELSE))


def clamp(c, lo: int, hi: int) -> Column:
    return F.least(F.greatest(_col(c), F.lit(lo)), F.lit(hi))
