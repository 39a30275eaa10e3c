"""Driver-table queries, one per operator, each with a DuckDB oracle."""
