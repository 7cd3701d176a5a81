"""Structured Streaming versions of the key indicators."""
