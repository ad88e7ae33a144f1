"""Operators of a training-data pipeline: deduplication, scoring, search, mixing, sharding, packing, quality."""
