"""Readers, writers and the role views over the given tables."""
