"""Streamed file ingest (the streamed form of S6)."""

from tessera.streaming.ingest import ingest_ndjson_stream, run_ingest

__all__ = ["ingest_ndjson_stream", "run_ingest"]
