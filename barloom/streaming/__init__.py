"""Incremental features with Structured Streaming."""
