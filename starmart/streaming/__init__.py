"""Structured Streaming: the encounter feed and its monthly summary."""
