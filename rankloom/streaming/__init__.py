"""Structured Streaming entry points.

The reference has no stream operators; its one on-line piece is the lookup API
that answers user-id requests against precomputed recommendations.  Here that
becomes batches of lookups: requests arrive as a stream, recommendations and
activity are static tables, each micro-batch's answers are written as files.
"""

from rankloom.streaming.lookups import lookup_stream, run_lookup_stream  # noqa: F401
