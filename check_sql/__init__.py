"""DuckDB counterparts of the reports, written independently over the raw tables."""
