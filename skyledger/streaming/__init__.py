"""Structured Streaming jobs from raw events to joined flight state."""
