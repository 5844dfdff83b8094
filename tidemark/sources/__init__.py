"""Sources: validated CSV ingest, Parquet tables and fixture adapters."""
