"""Structured Streaming jobs over JSON lines and the tables they keep."""
