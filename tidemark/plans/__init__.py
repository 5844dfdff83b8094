"""Plans: wire operators into marts; sinks and incremental refresh runs."""
