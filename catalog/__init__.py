"""Named queries over the driver's tables (Spark) and their DuckDB oracles."""
