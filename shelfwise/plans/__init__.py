"""Compositions of operators, the query registry and the DuckDB oracles."""
