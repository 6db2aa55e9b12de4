"""Structured Streaming forms of the log aggregates."""
