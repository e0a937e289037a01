"""Operators for training-data pipelines: deduplication, scans, archives, packing, search, filters."""
