"""Structured Streaming entry points (stateless admission scoring)."""
