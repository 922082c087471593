"""Incremental (Structured Streaming) form of the bronze load."""

from strata.streaming.ingest import ingest_available, start_bronze_stream

__all__ = ["ingest_available", "start_bronze_stream"]
