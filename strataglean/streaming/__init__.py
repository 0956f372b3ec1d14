"""Structured Streaming forms of the sketches."""
