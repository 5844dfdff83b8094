"""Structured Streaming ingest: new event files drive incremental refreshes."""
from .ingest import event_file_stream, start_event_ingest, stage_files

__all__ = ["event_file_stream", "start_event_ingest", "stage_files"]
