"""rankloom: recommendation analytics written as plain Spark DataFrame jobs.

Every operator is a function from DataFrames to a DataFrame (model fits return a
fitted model).  Nothing here creates a session, prints, or reads fixed paths:
callers pass tables in and get lazy plans back, so Catalyst sees whole pipelines.
"""

__version__ = "0.1.0"
