"""Column expressions: native Spark functions only (JVM-side, no Python UDFs)."""

from rankloom.functions.vectors import cosine, dot, l2_norm, as_array, as_vector  # noqa: F401
from rankloom.functions.scoring import (  # noqa: F401
    log_count, minmax_over, taste_blend, popularity_blend, segment_label,
    product_url, unknown_label, rmse_quality, clamp,
)
from rankloom.functions.keys import seeded_key, hash_bucket  # noqa: F401
