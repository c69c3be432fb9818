"""Operators of a training-data pipeline: search, packing, fingerprints, archives, privacy, duplicates, language, links, mixing, quality."""
