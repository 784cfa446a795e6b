"""Structured Streaming: incremental keyed merges (F1, F2)."""
