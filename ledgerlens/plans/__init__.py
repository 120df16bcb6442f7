"""End-to-end jobs, the registered query plans and their DuckDB oracle."""
