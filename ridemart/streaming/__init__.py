"""Structured Streaming jobs that end by themselves (``availableNow``)."""
