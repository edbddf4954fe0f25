"""Readers: telemetry JSON, expense CSV feeds, the clean lake, fixtures."""
