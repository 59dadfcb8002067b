"""Structured Streaming jobs and their sinks."""
