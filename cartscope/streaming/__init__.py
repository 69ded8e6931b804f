"""Incremental ingest of landed payload files (Structured Streaming)."""

from cartscope.streaming.ingest import start_ingest, start_merge_ingest

__all__ = ["start_ingest", "start_merge_ingest"]
