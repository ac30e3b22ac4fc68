"""Structured Streaming jobs around the batch transforms."""
