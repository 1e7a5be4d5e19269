"""Sources and sinks: review JSON, parquet tables, fitted models, fixture views."""

from rankloom.sources.reviews import REVIEW_SCHEMA, read_reviews  # noqa: F401
from rankloom.sources.tables import read_table, write_table, optional_table  # noqa: F401
from rankloom.sources.models import save_model, load_model, fit_or_load  # noqa: F401
from rankloom.sources.serving import read_serving, write_serving  # noqa: F401
from rankloom.sources.bucketed import register_bucketed, write_bucketed  # noqa: F401
