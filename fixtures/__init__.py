"""The queries on the fixture tables, and their DuckDB oracles."""
