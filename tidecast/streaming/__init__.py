"""Incremental versions of the daily arrival, on Structured Streaming."""
