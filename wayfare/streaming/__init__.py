"""Structured Streaming: refresh when new files arrive."""
