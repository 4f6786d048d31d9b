"""Structured Streaming twins of the batch pipelines."""
