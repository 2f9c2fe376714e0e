"""Structured Streaming entry into the same load."""
