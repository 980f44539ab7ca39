"""Structured Streaming queries over the same column expressions."""
