"""Structured Streaming jobs: load, message handling, de-duplication, windowed counts."""
