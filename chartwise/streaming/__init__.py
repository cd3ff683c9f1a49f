"""Incremental processing of newly landed raw files with Structured Streaming."""
