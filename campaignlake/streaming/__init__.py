"""Structured Streaming form of the incremental ingest."""

from .ingest_stream import record_stream, start_ingest_stream

__all__ = ["record_stream", "start_ingest_stream"]
