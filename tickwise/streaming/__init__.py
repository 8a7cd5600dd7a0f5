"""Structured Streaming: sources, sinks, publishers and the minute merge."""
