"""Checked queries: every operator over the given tables, with an equivalent SQL text for DuckDB."""
