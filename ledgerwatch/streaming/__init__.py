"""Structured Streaming jobs around the batch plans."""
