"""Structured Streaming: sinks per stream, and keyed state."""
