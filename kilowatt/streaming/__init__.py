"""Structured Streaming jobs: incremental file ingest, windowed rollups and
production-drift alerts."""
