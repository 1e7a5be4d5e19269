"""End-to-end plans: the reference's stages as compositions of operators, and the
registry of named checks run against the DuckDB oracle."""
