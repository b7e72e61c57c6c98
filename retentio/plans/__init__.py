"""Query catalogue on the test tables and its DuckDB twins."""
