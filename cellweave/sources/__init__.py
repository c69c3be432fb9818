"""Readers, Python data sources and sinks."""
