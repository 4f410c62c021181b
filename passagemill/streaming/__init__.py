"""Structured Streaming refresh."""
