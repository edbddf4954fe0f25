"""Structured Streaming entry points (live utilization, clean lake, older sliding path)."""
