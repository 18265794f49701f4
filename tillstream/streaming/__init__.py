"""Structured Streaming jobs: sources, keyed scoring, daily windows and sinks."""
