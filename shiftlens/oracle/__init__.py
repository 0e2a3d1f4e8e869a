"""Independent ANSI-SQL statements used to check the Spark results in DuckDB."""
