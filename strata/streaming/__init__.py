"""Incremental (streamed) ingestion into versioned tables."""

from strata.streaming.incremental import ingest_bronze_stream

__all__ = ["ingest_bronze_stream"]
