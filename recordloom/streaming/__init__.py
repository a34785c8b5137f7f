"""Structured Streaming over a static pool."""
