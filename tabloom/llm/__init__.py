"""Operators of a training-data pipeline: deduplication, packing, archives, fingerprints, classifiers."""
