"""Structured Streaming forms of the log fold and of index maintenance."""
