"""Structured Streaming: incremental latest-wins over a landing folder."""
