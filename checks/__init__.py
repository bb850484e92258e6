"""Oracle SQL (DuckDB dialect) used to check the Spark queries, and a local comparator."""
