"""Structured Streaming queries over message topics."""
