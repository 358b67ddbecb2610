"""Structured Streaming operators: study progress and incremental hourly stats."""
