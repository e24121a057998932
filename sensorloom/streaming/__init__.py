"""Structured Streaming: stateful operators and running a stream to its end."""
