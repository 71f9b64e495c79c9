"""Sources and sinks: parquet tables, CSV feeds, JDBC, catalog."""
