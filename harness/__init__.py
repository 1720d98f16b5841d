"""Driver-facing side: input views over the given tables, registered queries and their DuckDB twins."""
