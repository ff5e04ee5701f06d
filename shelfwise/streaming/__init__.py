"""Incremental (Structured Streaming) form of the snapshot CSV load."""
