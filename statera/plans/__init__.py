"""Report jobs (``reports``), the query catalog and its DuckDB oracle."""
