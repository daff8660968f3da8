"""Structured Streaming forms of the continuous operators."""
