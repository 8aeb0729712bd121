"""Sources (Parquet tables, catalog tables) and sinks (catalog tables)."""
