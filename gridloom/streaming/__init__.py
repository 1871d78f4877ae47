"""Incremental forms of the store operators for Structured Streaming."""
