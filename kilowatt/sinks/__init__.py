"""Sinks: layer writes, versioned tables, compaction/z-order layouts."""
