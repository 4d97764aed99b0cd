"""Structured Streaming landing jobs."""
