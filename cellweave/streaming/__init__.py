"""Streaming forms of the temporal aggregates."""
